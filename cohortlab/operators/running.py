"""Running sums and ranks over a total order, without a single-task window.

``prefix_sums`` is the common step: rows are range-partitioned by (group, order)
— Spark samples them, so a group with a third of all rows is spread over many
tasks and small groups share one — and written once to the shared scratch folder
with the number of their range.  One small row per (group, range) gives the sums
of the ranges before, a window inside the ranges adds the rest.  The write makes
the cut the same for both reads, also when an executor is lost between them.

On it rest the running meter, dense row numbers and exact order statistics.
``weighted_quantiles`` is the approximate form of the last: a mergeable sketch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.session import keep

_RANGE = "_range"


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Equal in all ``names``; null equals null."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"_by_{c}"]) for c in names], left[_RANGE] == right[f"_by_{_RANGE}"])


def prefix_sums(rows: DataFrame, order: list[Column], sums: dict[str, Column], by: list[str] | tuple = (),
                totals: bool = False) -> DataFrame:
    """``rows`` with the running sum of each of ``sums`` over the rows of the ``by`` group up to and with this one.

    ``order`` must tell rows apart for a repeatable result; rows that it leaves equal stay in one range, in any order.
    ``totals`` adds ``<name>_total``, the sum over the whole group.
    """
    by = list(by)
    valued = rows.select("*", *[c.alias(f"_add_{n}") for n, c in sums.items()])
    ranged = keep(valued.repartitionByRange(*by, *order).withColumn(_RANGE, F.spark_partition_id()), "prefix-sums")
    part = (ranged.groupBy(*[F.col(c).alias(f"_by_{c}") for c in [*by, _RANGE]])
            .agg(*[F.sum(f"_add_{n}").alias(f"_part_{n}") for n in sums]))
    group = Window.partitionBy(*[f"_by_{c}" for c in by])
    before = group.orderBy(f"_by_{_RANGE}").rowsBetween(Window.unboundedPreceding, -1)
    part = part.select(*[f"_by_{c}" for c in [*by, _RANGE]],
                       *[F.coalesce(F.sum(f"_part_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in sums],
                       *[F.sum(f"_part_{n}").over(group).alias(f"{n}_total") for n in sums if totals])
    inside = Window.partitionBy(*by, _RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = ranged.join(part, _same(ranged, part, by))
    return out.select(*rows.columns, *[(F.col(f"_before_{n}") + F.coalesce(F.sum(f"_add_{n}").over(inside), F.lit(0))).alias(n) for n in sums],
                      *[f"{n}_total" for n in sums if totals])


def running_meter(updates: DataFrame, order: list[Column], value: str = "val", weight: str = "n", by: list[str] | tuple = ()) -> DataFrame:
    """The meter after each update: ``…columns, sum, count, avg`` over the updates so far, in ``order``.

    ``sum`` adds value * weight, ``count`` the weights; ``avg`` is NULL while the count is 0.
    """
    out = prefix_sums(updates, order, {"sum": F.col(value) * F.col(weight), "count": F.col(weight)}, by)
    return out.withColumn("avg", F.when(F.col("count") != 0, F.col("sum") / F.col("count")))


def dense_numbers(rows: DataFrame, order: list[Column], out: str = "idx") -> DataFrame:
    """``rows`` numbered 0, 1, 2 ... in ``order``, by any number of tasks."""
    return prefix_sums(rows, order, {out: F.lit(1).cast("long")}).withColumn(out, F.col(out) - 1)


def with_order_ranks(counted: DataFrame, by: list[str], value: str = "valuenum", weight: str = "n") -> DataFrame:
    """``counted`` with, per group, ``upto`` (weight of values up to this one) and ``upto_total``; missing values weigh nothing."""
    n = F.when(F.col(value).isNotNull(), F.col(weight)).otherwise(F.lit(0))
    return prefix_sums(counted, [F.col(value)], {"upto": n}, by, totals=True)


def holds_rank(rank: Column, value: str = "valuenum", weight: str = "n") -> Column:
    """Is the value of ``rank`` (from 1) this row's?  On rows of ``with_order_ranks``."""
    return F.col(value).isNotNull() & (F.col("upto") >= rank) & (F.col("upto") - F.col(weight) < rank)


def weighted_quantiles(counted: DataFrame, by: list[str], probs: dict[str, float], value: str = "valuenum", weight: str = "n",
                       points: int = 1000, slices: int = 32) -> DataFrame:
    """``…by, <name> per entry of probs``: values whose rank is off by at most ``1 / points`` of the group's weight.

    A sketch that takes (value, weight) rows and merges: each group's rows are dealt by the hash of the value into ``slices``,
    a slice is cut into at most ``points`` stretches of equal weight, each kept as its greatest value and its weight.  A slice
    of weight w misplaces less than w / points, and these errors add up to less than 1 / points of the whole.  A group's state is at most
    points * slices rows, a value that is heavier than a stretch stays exact, and the result does not depend on partitions.
    """
    n = F.col(weight).cast("double")
    valued = counted.where(F.col(value).isNotNull() & (F.col(weight) > 0))
    same = valued.groupBy(*by, value).agg(F.sum(weight).alias(weight)).withColumn("_slice", F.pmod(F.xxhash64(value), F.lit(slices)))
    own = Window.partitionBy(*by, "_slice")
    upto = F.sum(n).over(own.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cut = same.withColumn("_stretch", F.floor((upto - n) * points / F.sum(n).over(own)))
    sketch = cut.groupBy(*by, "_slice", "_stretch").agg(F.max(value).alias(value), F.sum(weight).alias(weight))
    group = Window.partitionBy(*by)
    ranked = sketch.select(*by, F.col(value).alias("_value"), F.sum(n).over(group.orderBy(value).rangeBetween(Window.unboundedPreceding, 0)).alias("_upto"),
                           F.sum(n).over(group).alias("_all"))
    return ranked.groupBy(*by).agg(*[F.min(F.when(F.col("_upto") >= F.col("_all") * p, F.col("_value"))).alias(name) for name, p in probs.items()])
