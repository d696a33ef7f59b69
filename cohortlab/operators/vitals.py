"""Blood-vital features: statistics per patient, vital and date period.

Periods are relative to each patient's last observation day ``last_day``
(the anchor date, one day earlier for sepsis patients):

* ``lastDay`` — chart day == last_day
* ``week``    — last_day - 8 <= chart day < last_day
* ``month``   — last_day - 31 <= chart day < last_day - 8 (disjoint from the week)
* ``history`` — every row (no upper bound, as in the original features;
  ``strict_history=True`` stops it at last_day)

Statistics: median, mean, sample std, and ``len`` = number of rows including
rows whose value is missing.  Missing values (NULL and NaN) are skipped by the
other statistics.  The wide table has one column per (period, statistic,
vital), named ``{period}_valuenum_{stat}_{label}``; empty cells and the std of
a single reading are 0.

Scale notes
-----------
The wide table is computed in one pass: readings are counted per (patient,
vital, day, value), joined to the anchor and tagged with the (at most two)
periods they belong to.  The median is selected by running counts over the
sorted (value, n) rows (``running.prefix_sums``): rows are range-partitioned by
(patient, period, vital, value), so a group of any size is spread over tasks and none
keeps more than running sums.  A pivot over the 20 explicit (period, vital)
values then builds the row of each patient from at most 20 small rows.
``approx_median=True`` takes the median from a mergeable sketch of (value, n)
rows with a rank error of at most 0.1 % and skips the range sort.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.codes import VITAL_ITEM_IDS, VITAL_LABELS
from cohortlab.functions.expressions import anchor_day, nan_to_null, vital_label
from cohortlab.operators.running import holds_rank, prefix_sums, weighted_quantiles

PERIODS = ["lastDay", "week", "month", "history"]
STATS = ["median", "mean", "std", "len"]
WEEK_DAYS = 8
MONTH_DAYS = 31


def feature_columns(periods=PERIODS, labels=VITAL_LABELS) -> list[str]:
    return [f"{p}_valuenum_{s}_{lab}" for p in periods for s in STATS for lab in labels]


def vitals_filter(chart: DataFrame) -> DataFrame:
    """Chart rows whose item id is one of the blood-vital ids (pushed to the scan as an IN filter)."""
    return chart.where(F.col("itemid").isin(VITAL_ITEM_IDS))


def label_vitals(chart: DataFrame) -> DataFrame:
    """Add ``label`` (NULL for non-vital ids) and ``chart_date``; NaN readings become NULL."""
    return (chart.withColumn("valuenum", nan_to_null("valuenum"))
            .withColumn("label", vital_label("itemid"))
            .withColumn("chart_date", F.try_to_date("charttime")))


def with_last_day(patients: DataFrame) -> DataFrame:
    """Patients with ``last_day`` and the period starts ``week_start`` / ``month_start``."""
    ld = anchor_day("max_date", "angus")
    return (patients.withColumn("last_day", ld)
            .withColumn("week_start", F.date_sub(ld, WEEK_DAYS))
            .withColumn("month_start", F.date_sub(ld, MONTH_DAYS)))


def vitals_with_anchor(chart: DataFrame, patients: DataFrame) -> DataFrame:
    """Labelled vital rows joined to their patient's anchor (inner, on ``subject_id``).

    The patient side is one row per patient; the planner broadcasts it when its
    estimated size is under the broadcast threshold and otherwise shuffles both
    sides on ``subject_id``.
    """
    return label_vitals(vitals_filter(chart)).join(with_last_day(patients), "subject_id")


def period_condition(period: str, strict_history: bool = False) -> Column:
    cd, ld = F.col("chart_date"), F.col("last_day")
    if period == "lastDay":
        return cd == ld
    if period == "week":
        return (cd < ld) & (cd >= F.date_sub(ld, WEEK_DAYS))
    if period == "month":
        return (cd < F.date_sub(ld, WEEK_DAYS)) & (cd >= F.date_sub(ld, MONTH_DAYS))
    if period == "history":
        return (cd <= ld) if strict_history else F.lit(True)
    raise ValueError(period)


def value_counts(rows: DataFrame, keys) -> DataFrame:
    """``…keys, valuenum, n``: rows per group and value (NULL values too), combined map-side."""
    return rows.groupBy(*keys, "valuenum").agg(F.count(F.lit(1)).alias("n"))


def stats_of_counts(counted: DataFrame, keys, approx_median: bool = False, with_max: bool = True) -> DataFrame:
    """Statistics per group from (value, n) rows; exact, or with the median from a sketch.

    Exact: running counts over the sorted values (``running.prefix_sums``) tell which rows hold the two middle
    ranks and supply the group's mean; then one aggregate.  A group of any size is spread over tasks,
    and none keeps more than a running sum.
    """
    x = F.col("valuenum")
    keys = list(keys)
    n = F.when(x.isNotNull(), F.col("n"))
    if approx_median:
        # the spread around any fixed value of the group gives its deviation; the greatest is at hand map-side
        aggs = [F.max("valuenum").alias("valuenum_max"), F.sum(x * n).alias("_s"), F.sum(n).alias("_n"), F.sum("n").alias("valuenum_len")]
        first = counted.groupBy(*keys).agg(*aggs).withColumn("valuenum_mean", F.col("_s") / F.col("_n"))
        mean = first.select(*[F.col(k).alias(f"_{k}") for k in keys], "valuenum_mean")
        same = reduce(lambda a, b: a & b, [counted[k].eqNullSafe(mean[f"_{k}"]) for k in keys])
        away = x - F.col("valuenum_mean")
        spread = counted.join(mean, same).groupBy(*keys).agg(F.sum(n * away * away).alias("_m2"))
        middle = weighted_quantiles(counted, keys, {"valuenum_median": 0.5})
        out = _joined(_joined(first, spread, keys), middle, keys)
        std = F.when(F.col("_n") > 1, F.sqrt(F.col("_m2") / (F.col("_n") - 1)))
        return out.select(*keys, *(["valuenum_max"] if with_max else []), F.col("valuenum_median").cast("double").alias("valuenum_median"),
                          "valuenum_mean", std.alias("valuenum_std"), "valuenum_len")
    zero = F.lit(0)
    ranked = prefix_sums(counted, [x], {"upto": F.coalesce(n, zero), "sum": F.coalesce(x * n, F.lit(0.0))}, keys, totals=True)
    total, away = F.col("upto_total"), x - F.col("sum_total") / F.col("upto_total")
    low = F.max(F.when(holds_rank(F.floor((total + 1) / 2)), x))
    high = F.max(F.when(holds_rank(F.floor(total / 2) + 1), x))
    aggs = [F.max("valuenum").alias("valuenum_max")] if with_max else []
    aggs += [(low + (high - low) / 2).cast("double").alias("valuenum_median"),
             F.first(F.when(total > 0, F.col("sum_total") / total)).alias("valuenum_mean"),
             F.when(F.sum(n) > 1, F.sqrt(F.sum(n * away * away) / (F.sum(n) - 1))).alias("valuenum_std"),
             F.sum("n").alias("valuenum_len")]
    return ranked.groupBy(*keys).agg(*aggs)


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on ``keys``, null equal to null."""
    right = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    return left.join(right, reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_{k}"]) for k in keys]), "left").drop(*[f"_{k}" for k in keys])


def vital_stats(rows: DataFrame, keys=("subject_id", "label"), approx_median: bool = False,
                with_max: bool = True) -> DataFrame:
    """Per-group ``valuenum`` statistics: max, median, mean, sample std, len.

    ``len`` counts rows (missing values included); std is NULL for one value.
    ``approx_median`` takes the median from a sketch whose rank is off by 0.1 % of the group at most.
    """
    return stats_of_counts(value_counts(rows, keys), keys, approx_median, with_max)


def period_stats(chart: DataFrame, patients: DataFrame, period: str, strict_history: bool = False,
                 approx_median: bool = False) -> DataFrame:
    """Long-form statistics of one period: ``subject_id, label, valuenum_max .. valuenum_len``."""
    rows = vitals_with_anchor(chart, patients).where(period_condition(period, strict_history))
    return vital_stats(rows, approx_median=approx_median)


def _pivot_wide(stats: DataFrame, keys: list[str], key_col: str, names: dict[str, tuple[str, str]]) -> DataFrame:
    """groupBy(subject).pivot(key_col, explicit keys) -> ``{period}_valuenum_{stat}_{label}`` columns."""
    wide = (stats.groupBy("subject_id").pivot(key_col, keys)
            .agg(*[F.first(f"valuenum_{s}").alias(s) for s in STATS]))
    out = [F.col("subject_id")]
    for k in keys:
        period, label = names[k]
        for s in STATS:
            out.append(F.coalesce(F.col(f"`{k}_{s}`"), F.lit(0)).alias(f"{period}_valuenum_{s}_{label}"))
    return wide.select(*out)


def period_wide(chart: DataFrame, patients: DataFrame, period: str, strict_history: bool = False,
                approx_median: bool = False) -> DataFrame:
    """One period pivoted wide: a row per patient with readings in the period, 20 feature columns."""
    stats = period_stats(chart, patients, period, strict_history, approx_median)
    names = {lab: (period, lab) for lab in VITAL_LABELS}
    return _pivot_wide(stats, list(VITAL_LABELS), "label", names)


def vitals_features(chart: DataFrame, patients: DataFrame, strict_history: bool = False,
                    approx_median: bool = False) -> DataFrame:
    """Patient columns + the 80 period/statistic/vital features (missing -> 0), one row per patient."""
    # readings are counted per day before the join, so a hot patient arrives pre-aggregated
    per_day = (label_vitals(vitals_filter(chart)).groupBy("subject_id", "label", "chart_date", "valuenum")
               .agg(F.count(F.lit(1)).alias("n")))
    rows = per_day.join(with_last_day(patients), "subject_id")
    tags = F.array_compact(F.array(*[F.when(period_condition(p, strict_history), F.lit(p)) for p in PERIODS]))
    tagged = rows.select("subject_id", "label", "valuenum", "n", F.explode(tags).alias("period"))
    tagged = tagged.withColumn("pk", F.concat_ws("__", "period", "label")).drop("period", "label")
    stats = stats_of_counts(tagged, ["subject_id", "pk"], approx_median, with_max=False)
    names = {f"{p}__{lab}": (p, lab) for p in PERIODS for lab in VITAL_LABELS}
    wide = _pivot_wide(stats, list(names), "pk", names)
    feats = feature_columns()
    joined = patients.join(wide, "subject_id", "left")
    return joined.select(*patients.columns, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in feats])
