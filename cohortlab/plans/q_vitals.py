"""Registered queries: vitals extract, labels, anchors, period statistics, wide features."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlab.functions.codes import ITEM_ID_TO_LABEL, VITAL_ITEM_IDS, VITAL_LABELS
from cohortlab.operators import vitals
from cohortlab.plans import q_cohort
from cohortlab.plans.catalog import r6, register
from cohortlab.sources.tables import Clinical, with_views

_IDS = ",".join(str(i) for i in VITAL_ITEM_IDS)
_LABEL_SQL = "CASE itemid " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in ITEM_ID_TO_LABEL.items()) + " END"
_LAST_DAY_SQL = "CASE WHEN angus = 1 THEN max_date - 1 ELSE max_date END"

_PERIOD_SQL = {
    "lastDay": "chart_date = last_day",
    "week": "chart_date < last_day AND chart_date >= last_day - 8",
    "month": "chart_date < last_day - 8 AND chart_date >= last_day - 31",
    "history": "TRUE",
}

# labelled vital rows joined to the anchor (CTE body)
_ROWS_SQL = (f"SELECT c.subject_id, c.charttime, c.itemid, c.valuenum, {_LABEL_SQL} AS label, "
             f"cast(c.charttime AS date) AS chart_date, p.max_date, p.angus, p.first_admit_age, "
             f"CASE WHEN p.angus = 1 THEN p.max_date - 1 ELSE p.max_date END AS last_day "
             f"FROM chartevents c JOIN patient_anchor p ON c.subject_id = p.subject_id WHERE c.itemid IN ({_IDS})")

_STAT_SQL = ("round(max(valuenum), 6) AS valuenum_max, round(median(valuenum), 6) AS valuenum_median, "
             "round(avg(valuenum), 6) AS valuenum_mean, round(stddev_samp(valuenum), 6) AS valuenum_std, "
             "count(*) AS valuenum_len")


def _rounded(df):
    return df.select(*[r6(c).alias(c) if c in ("valuenum_max", "valuenum_median", "valuenum_mean", "valuenum_std")
                       else F.col(c) for c in df.columns])


@register("vitals_filter", with_views(f"SELECT * FROM chartevents WHERE itemid IN ({_IDS})", "chartevents"))
def vitals_filter(spark, d):
    return vitals.vitals_filter(Clinical(spark, d).chartevents)


@register("vitals_label", with_views(
    f"SELECT subject_id, charttime, itemid, valuenum, {_LABEL_SQL} AS label, cast(charttime AS date) AS chart_date "
    f"FROM chartevents", "chartevents"))
def vitals_label(spark, d):
    return vitals.label_vitals(Clinical(spark, d).chartevents)


@register("anchor_day", with_views(
    f"SELECT subject_id, max_date, angus, first_admit_age, {_LAST_DAY_SQL} AS last_day, "
    f"({_LAST_DAY_SQL}) - 8 AS week_start, ({_LAST_DAY_SQL}) - 31 AS month_start FROM patient_anchor",
    "patient_anchor"))
def anchor_day(spark, d):
    return vitals.with_last_day(Clinical(spark, d).patient_anchor)


@register("vitals_with_anchor", with_views(
    f"SELECT subject_id, charttime, itemid, valuenum, label, chart_date, max_date, angus, first_admit_age, last_day, "
    f"last_day - 8 AS week_start, last_day - 31 AS month_start FROM ({_ROWS_SQL}) r",
    "chartevents", "patient_anchor"))
def vitals_with_anchor(spark, d):
    c = Clinical(spark, d)
    return vitals.vitals_with_anchor(c.chartevents, c.patient_anchor)


@register("vitals_stats", with_views(
    f"SELECT subject_id, {_LABEL_SQL} AS label, {_STAT_SQL} FROM chartevents WHERE itemid IN ({_IDS}) "
    f"GROUP BY 1, 2", "chartevents"))
def vitals_stats(spark, d):
    rows = vitals.label_vitals(vitals.vitals_filter(Clinical(spark, d).chartevents))
    return _rounded(vitals.vital_stats(rows))


def _period_query(period: str):
    def q(spark, d):
        c = Clinical(spark, d)
        return _rounded(vitals.period_stats(c.chartevents, c.patient_anchor, period))
    sql = with_views(f"SELECT subject_id, label, {_STAT_SQL} FROM ({_ROWS_SQL}) r WHERE {_PERIOD_SQL[period]} "
                     f"GROUP BY subject_id, label", "chartevents", "patient_anchor")
    return q, sql


for _p, _key in [("lastDay", "features_last_day"), ("week", "features_week"), ("month", "features_month"),
                 ("history", "features_history")]:
    _q, _sql = _period_query(_p)
    register(_key, _sql)(_q)


def _wide_sql(periods: list[str], patient_cols: list[str] | None, strict_history: bool = False) -> str:
    """Long stats per (subject, period, label) then conditional aggregation to columns."""
    cond = dict(_PERIOD_SQL, history="chart_date <= last_day") if strict_history else _PERIOD_SQL
    longs = " UNION ALL ".join(
        f"SELECT subject_id, '{p}' AS period, label, median(valuenum) AS s_median, avg(valuenum) AS s_mean, "
        f"stddev_samp(valuenum) AS s_std, count(*) AS s_len FROM ({_ROWS_SQL}) r WHERE {cond[p]} "
        f"GROUP BY subject_id, label" for p in periods)
    feats = []
    for p in periods:
        for s in vitals.STATS:
            for lab in VITAL_LABELS:
                v = f"max(CASE WHEN period = '{p}' AND label = '{lab}' THEN s_{s} END)"
                e = f"coalesce({v}, 0)"
                feats.append(f"{e if s == 'len' else f'round({e}, 6)'} AS {p}_valuenum_{s}_{lab}")
    if patient_cols is None:
        return f"SELECT subject_id, {', '.join(feats)} FROM ({longs}) l GROUP BY subject_id"
    pc = ", ".join(f"a.{c}" for c in patient_cols)
    feats_outer = []
    for p in periods:
        for s in vitals.STATS:
            for lab in VITAL_LABELS:
                n = f"{p}_valuenum_{s}_{lab}"
                feats_outer.append(f"coalesce(w.{n}, 0) AS {n}")
    return (f"SELECT {pc}, {', '.join(feats_outer)} FROM patient_anchor a LEFT JOIN "
            f"(SELECT subject_id, {', '.join(feats)} FROM ({longs}) l GROUP BY subject_id) w ON a.subject_id = w.subject_id")


def _rounded_wide(df):
    return df.select(*[r6(c).alias(c) if ("_median_" in c or "_mean_" in c or "_std_" in c) else F.col(c)
                       for c in df.columns])


@register("vitals_pivot", with_views(_wide_sql(["lastDay"], None), "chartevents", "patient_anchor"))
def vitals_pivot(spark, d):
    c = Clinical(spark, d)
    return _rounded_wide(vitals.period_wide(c.chartevents, c.patient_anchor, "lastDay"))


@register("vitals_features", with_views(
    _wide_sql(vitals.PERIODS, ["subject_id", "max_date", "angus", "first_admit_age"]), "chartevents", "patient_anchor"))
def vitals_features(spark, d):
    c = Clinical(spark, d)
    return _rounded_wide(vitals.vitals_features(c.chartevents, c.patient_anchor))


@register("vitals_features_strict", with_views(
    _wide_sql(vitals.PERIODS, ["subject_id", "max_date", "angus", "first_admit_age"], strict_history=True),
    "chartevents", "patient_anchor"))
def vitals_features_strict(spark, d):
    """The wide table with the history period stopped at the last observation day (no later rows)."""
    c = Clinical(spark, d)
    return _rounded_wide(vitals.vitals_features(c.chartevents, c.patient_anchor, strict_history=True))


@register("vitals_features_from_details", q_cohort.with_details(_wide_sql(vitals.PERIODS, ["subject_id", "max_date", "angus"])))
def vitals_features_from_details(spark, d):
    """The chained job: dates, patient details, vital features."""
    return _rounded_wide(vitals.vitals_features(Clinical(spark, d).chartevents, q_cohort.patient_details(spark, d)))
