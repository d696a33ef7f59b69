"""Invariants for rows-only keys and equivalence of the scalable forms with their plain forms."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortlab.operators import metrics, notes
from cohortlab.operators import phenotype as ph
from cohortlab.sources.tables import Clinical

from cohort_test_tables import SF_SMALL


def test_topic_distributions_sum_to_one(spark, catalog):
    rows = catalog.QUERIES["topic_columns"](spark, SF_SMALL).collect()
    assert rows
    for r in rows:
        s = sum(r[f"topic_{i}"] for i in range(1, 21))
        assert math.isclose(s, 1.0, abs_tol=1e-6) or s == 0.0


def test_topic_terms_ranked(spark, catalog):
    t = catalog.QUERIES["topic_terms"](spark, SF_SMALL)
    assert t.select("topic").distinct().count() == 20
    assert t.groupBy("topic").agg(F.max("rank").alias("m")).where("m > 100").count() == 0


def test_split_is_disjoint_and_complete(spark, catalog):
    s = catalog.QUERIES["train_test_split"](spark, SF_SMALL)
    assert s.count() == s.select("subject_id").distinct().count() == 15
    assert set(r[0] for r in s.select("split").distinct().collect()) <= {"train", "test"}


def test_model_reload_gives_equal_scores(spark, catalog):
    rows = catalog.QUERIES["model_roundtrip"](spark, SF_SMALL).collect()
    assert rows and all(r["equal"] for r in rows)


def test_ranged_roc_equals_global_window(spark):
    p = Clinical(spark, SF_SMALL).predictions
    assert metrics.unscored(p).collect()[0][0] == p.count() - metrics.scored(p).count() > 0
    p = metrics.scored(p)
    ours = {r["threshold"]: (r["tp"], r["fp"]) for r in metrics.roc_curve(p).collect()}
    g = p.groupBy(F.col("p").alias("threshold")).agg(F.sum((F.col("y") == 1).cast("long")).alias("pos"),
                                                      F.sum((F.col("y") != 1).cast("long")).alias("neg"))
    w = Window.orderBy(F.col("threshold").desc())
    plain = {r["threshold"]: (r["tp"], r["fp"]) for r in
             g.select("threshold", F.sum("pos").over(w).alias("tp"), F.sum("neg").over(w).alias("fp")).collect()}
    assert ours == plain


def test_auc_hard_is_mean_of_tpr_and_tnr(spark):
    p = Clinical(spark, SF_SMALL).predictions
    a = metrics.auc(p, score="h").collect()[0][0]
    c = {(r["y"], r["h"]): r["n"] for r in metrics.confusion_matrix(p.where("h IS NOT NULL")).collect()}
    tpr = c[(1, 1)] / (c[(1, 1)] + c[(1, 0)])
    tnr = c[(0, 0)] / (c[(0, 0)] + c[(0, 1)])
    assert math.isclose(a, (tpr + tnr) / 2, rel_tol=1e-12)


def test_salted_topk_equals_plain_window(spark):
    docs = Clinical(spark, SF_SMALL).raw("documents").select("lang", "text")
    counts = notes.note_terms(docs, key="lang")
    order = [F.col("n").desc(), F.col("term").asc()]
    salted = {tuple(r) for r in notes.topk_per_group(counts, "lang", order, 25, "term", salt_buckets=7)
              .select("lang", "term", "rank").collect()}
    w = Window.partitionBy("lang").orderBy(*order)
    plain = {tuple(r) for r in counts.withColumn("rank", F.row_number().over(w)).where("rank <= 25")
             .select("lang", "term", "rank").collect()}
    assert salted == plain


def test_exclusive_phenotype_has_one_label_per_patient(spark):
    c = Clinical(spark, SF_SMALL)
    dx = c.dm_diagnoses.withColumnRenamed("dx_date", "date")
    out = ph.phenotype(c.medications, c.labevents, dx, exclusive=True)
    assert out.count() == out.select("subject_id").distinct().count()


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["subject_id", "sepsis_date"] and df.count() == 150
    assert set(e.oracle_sql()) <= set(e.queries())



def test_confusion_matrix_per_model_full_grid(spark):
    preds = spark.createDataFrame([("a", 1, 1), ("a", 1, 0), ("a", 0, 0), ("b", 1, 1), ("b", 0, 2)],
                                  "model string, y int, h int")
    got = {(r["model"], r["y"], r["h"]): (r["n"], r["share"]) for r in metrics.confusion_matrix(preds, by=["model"]).collect()}
    assert got[("a", 1, 1)] == (1, 0.5) and got[("a", 0, 1)] == (0, 0.0) and got[("b", 1, 0)] == (0, 0.0)
    assert got[("b", 0, 2)] == (1, 1.0)  # a class outside the listed grid is kept
    assert len([k for k in got if k[0] == "a"]) == 4 and len([k for k in got if k[0] == "b"]) == 5


def test_missing_scores_and_predictions(spark):
    rows = [(1, 1, 0.9), (1, None, float("nan")), (0, None, None), (0, 1, 0.4), (1, 0, 0.4)]
    p = spark.createDataFrame([("m", *r) for r in rows], "model string, y int, h int, p double")
    roc = {r["threshold"]: (r["tp"], r["fp"]) for r in metrics.roc_curve(p).collect()}
    assert roc == {0.9: (1, 0), 0.4: (2, 1)}
    assert metrics.unscored(p).collect()[0]["n_unscored"] == 2
    assert metrics.auc(p).collect()[0][0] == 0.75
    assert metrics.accuracy(p).collect()[0]["accuracy"] == 0.2


def test_auc_of_counts_beyond_the_long_product(spark):
    n = 4_000_000_000
    pts = spark.createDataFrame([(0.9, n, 0, n, 0, n, n), (0.1, 0, n, n, n, n, n)],
                                "threshold double, pos long, neg long, tp long, fp long, P long, N long")
    assert metrics.auc_of_counts(pts).collect()[0][0] == 1.0


def test_bunched_scores_spread_over_ranges(spark):
    p = spark.range(20_000).select((F.col("id") % 2).cast("int").alias("y"), (F.col("id") / 2e7).alias("p"))
    points = metrics.score_counts(p).repartitionByRange(8, F.col("threshold").desc())
    sizes = [r[1] for r in points.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / len(sizes)
    assert abs(metrics.auc(p).collect()[0][0] - 0.5) < 1e-3


def test_topics_do_not_depend_on_shuffle_settings(spark):
    from cohortlab.plans import topics
    c = Clinical(spark, SF_SMALL)
    out = []
    for n in ("3", "11"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        bag = notes.patient_terms(c.patient_anchor, c.noteevents)
        model = topics.fit_topics_from_bag(bag, bag.select("subject_id").distinct(), k=4, vocab_size=500)
        plan = model.docs._jdf.queryExecution().toString()
        assert "BatchEvalPython" not in plan
        out.append({r[0]: r[1:] for r in model.topic_columns().collect()})
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert out[0].keys() == out[1].keys()
    assert all(abs(x - y) < 1e-9 for k in out[0] for x, y in zip(out[0][k], out[1][k], strict=True))


def test_model_loop_takes_any_estimator_and_given_tables(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler
    from cohortlab.plans import models
    rows = [(i, i % 2, float(i % 2) + 0.1 * (i % 5), float(i)) for i in range(60)]
    data = spark.createDataFrame(rows, "subject_id long, angus int, a double, b double")
    train, test = data.where("subject_id < 40"), data.where("subject_id >= 40")
    tree = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"),
                            DecisionTreeClassifier(featuresCol="features", labelCol="angus")])
    table, fitted = models.fit_estimators(train, test, [("tree", tree), ("logistic", models.logistic_estimator(["a"], "angus", 40))])
    got = {r["model"]: r["accuracy"] for r in models.comparison(table).collect()}
    assert set(fitted) == {"tree", "logistic"} and got["tree"] == 1.0 and table.count() == 40


def test_stays_with_a_time_of_day_give_days(spark):
    import datetime as dt
    from cohortlab.operators import cohort
    stays = spark.createDataFrame([(1, 10, "2101-01-05 14:00:00"), (1, 10, "2101-01-06 01:00:00"), (1, 11, "no date")],
                                  "subject_id long, hadm_id long, intime string")
    codes = spark.createDataFrame([(1, 10, "99592"), (1, 11, "99592")], "subject_id long, hadm_id long, icd9_code string")
    none = codes.where("false")
    for one_pass in (True, False):
        out = cohort.sepsis_date(codes, none, stays, one_pass=one_pass)
        assert out.schema["sepsis_date"].dataType.simpleString() == "date"
        assert [r[1] for r in out.where("sepsis_date IS NOT NULL").collect()] == [dt.date(2101, 1, 5)]
    assert cohort.codes_icu_join(codes, stays).count() == 3
    bad = spark.createDataFrame([(1, "2101-03-01"), (1, "x")], "subject_id long, t string")
    assert cohort.last_date(bad, "t").collect()[0][1] == dt.date(2101, 3, 1)
