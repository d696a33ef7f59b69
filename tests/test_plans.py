"""Physical-plan properties that matter at scale: shuffle count, pushdown, pruning."""

from __future__ import annotations

import datetime as dt

from cohortlab.operators import cohort, vitals
from cohortlab.session import scratch_dir
from cohortlab.sources.tables import Clinical

from cohort_test_tables import SF_SMALL


import pytest


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    """Plans as they are on large tables: nothing is small enough to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffles(plan: str) -> int:
    return plan.count("Exchange hashpartitioning")


def _stored(spark, df):
    """A frame read from Parquet, so that the plan holds the operator alone."""
    path = scratch_dir(spark, "plan")
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_sepsis_date_is_two_shuffles_without_joins_of_codes(spark):
    c = Clinical(spark, SF_SMALL)
    plan = _plan(cohort.sepsis_date(*[_stored(spark, t) for t in (c.diagnoses_icd, c.procedures_icd, c.icustays)]))
    # one exchange for the per-admission aggregate, one for the per-patient aggregate
    assert _shuffles(plan) == 2, plan
    assert "SortMergeJoin" not in plan


def test_last_record_date_is_one_shuffle(spark):
    c = Clinical(spark, SF_SMALL)
    plan = _plan(cohort.last_record_date([(c.labevents, "charttime"), (c.chartevents, "charttime"),
                                          (c.noteevents, "chartdate")]))
    assert _shuffles(plan) == 1, plan


def test_vitals_filter_and_columns_reach_the_scan(spark):
    path = scratch_dir(spark, "chart-parquet")
    spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1, 8), 211, 80.0, "x" * 10), (2, dt.datetime(2024, 1, 2, 8), 5, 1.0, "y")],
        "subject_id long, charttime timestamp_ntz, itemid int, valuenum double, note string").write.parquet(path)
    chart = spark.read.parquet(path)
    df = vitals.vitals_filter(chart).select("subject_id", "valuenum")
    plan = _plan(df)
    assert "PushedFilters: [In(itemid" in plan or "PushedFilters: [IsNotNull(itemid), In(itemid" in plan, plan
    assert "note" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_phenotype_one_pass_has_single_patient_shuffle(spark):
    from cohortlab.operators import phenotype as ph
    c = Clinical(spark, SF_SMALL)
    dx = c.dm_diagnoses.withColumnRenamed("dx_date", "date")
    plan = _plan(ph.phenotype(*[_stored(spark, t) for t in (c.medications, c.labevents, dx)]))
    assert _shuffles(plan) == 1, plan


def test_vitals_features_shuffles(spark):
    # parquet inputs, so the planner sees real sizes (a Python-list frame has no size estimate)
    cpath, ppath = scratch_dir(spark, "chart"), scratch_dir(spark, "anchor")
    spark.createDataFrame([(1, dt.datetime(2024, 1, 10, 8), 211, 80.0)],
                          "subject_id long, charttime timestamp_ntz, itemid int, valuenum double").write.parquet(cpath)
    spark.createDataFrame([(1, dt.date(2024, 1, 10), 0)], "subject_id long, max_date date, angus int").write.parquet(ppath)
    chart, anchor = spark.read.parquet(cpath), spark.read.parquet(ppath)
    whole = vitals.vitals_features(chart, anchor)._jdf.queryExecution().toString()
    assert "percentile" not in whole and "collect_list" not in whole
    # the ranked rows come from a table that is cut by (group, value): no map and no window holds a whole group
    counted = vitals.value_counts(vitals.label_vitals(chart), ["subject_id", "label"])
    plan = _plan(vitals.stats_of_counts(counted, ["subject_id", "label"]))
    assert "percentile" not in plan and "_range" in plan
    for line in plan.splitlines():
        if "Window [" in line and "upto" in line:
            assert "_range" in line or "_by_" in line, line


def test_patient_terms_prune_before_they_tokenize(spark):
    from cohortlab.operators import notes
    c = Clinical(spark, SF_SMALL)
    plan = _plan(notes.patient_terms(_stored(spark, c.patient_anchor), _stored(spark, c.noteevents)))
    # the tree prints parents first: the tokens are made above the join, and counted map-side before the last exchange
    assert plan.index("Generate explode") < plan.index("SortMergeJoin"), plan
    assert "partial_count" in plan[:plan.index("SortMergeJoin")]
