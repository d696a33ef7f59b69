"""Mixing sources to target weights by weighted fair queueing (operator 5).

Sources in code-point order (null last) get the repeating ``weights``; their
targets share the budget (all words) by weight, none above ``max_repeats``
times its source's size, the excess reshared by weight.  Within its source a
document's place is the order of a hash of its id; a document that starts its
e-th pass after e passes of the whole source has the virtual finish time

    (e * source size + running size in the shuffled source) / target,

and the mix is the global order of finish times, truncated where the running
size passes the budget.  Documents are taken whole, at most ``max_repeats``
times.

Running sums never pass through one task: a source is cut into hash buckets
and virtual time into equal slices; sums per bucket and slice give each its
start, and only rows of one bucket, or of the slice where the budget ends,
meet in a window.

Defined cases: null text has size 0; a document of size 0 takes 0 words; a
null source is a source of its own; rows sharing a ``doc_id`` are ordered by
size and text; an empty table gives no rows; further columns are ignored by
``mix`` and kept by ``apply_mix``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlab.llm.common import WORD, keep

#: Hex digits of the hash that name a bucket, and slices of one unit of virtual time.
BUCKET_DIGITS, SLICES = 3, 4096


def source_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), max_repeats: int = 3) -> DataFrame:
    """(source, source_size) -> (source, source_size, target); one row per source.

    ``target = min(max_repeats * size, level * weight)`` with the level at which the targets add up to all sizes.
    """
    place = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    n = len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (((F.row_number().over(place) - 1) % n) + 1).cast("int"))
    ranked = sizes.withColumn("w", w).withColumn("cap", (F.col("source_size") * max_repeats).cast("long"))
    # sources in the order in which a rising level caps them
    up = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.encode("source", "utf-8"))
    everything = Window.partitionBy()
    r = (ranked.withColumn("total", F.sum("source_size").over(everything))
         .withColumn("capped", F.coalesce(F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("open_w", F.sum("w").over(up.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("level_here", (F.col("total") - F.col("capped")).cast("double") / F.col("open_w"))
         .withColumn("holds", F.col("level_here") * F.col("w") <= F.col("cap")))
    level = F.min(F.when(F.col("holds"), F.struct(F.col("cap") / F.col("w"), "level_here"))).over(everything)["level_here"]
    return (r.withColumn("level", level)
            .withColumn("target", F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("w"), F.col("cap").cast("double"))))
            .select("source", "source_size", "target"))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_repeats: int = 3) -> DataFrame:
    """doc_id, tie, size, source_size, target, taken per row of ``docs`` (doc_id, text, source).

    ``tie`` is the md5 of the text.  The texts are read once; what is kept of them is one narrow row each.
    """
    rows = keep(docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("tie"),
        F.md5(F.concat(F.lit("mix-"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")).alias("h"))
        .withColumn("bucket", F.substring("h", 1, BUCKET_DIGITS)), "mix-sizes")
    buckets = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    sources = keep(source_targets(buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, max_repeats), "mix-sources")
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (buckets.withColumn("bucket_start", F.coalesce(F.sum("bucket_size").over(before), F.lit(0))).alias("b")
              .join(sources.alias("s"), F.col("b.source").eqNullSafe(F.col("s.source")))
              .select(F.col("b.source").alias("source"), "bucket", "bucket_start", "source_size", "target"))
    running = F.sum("size").over(Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size", "tie")
                                 .rowsBetween(Window.unboundedPreceding, 0))
    placed = keep(rows.withColumn("running", running).alias("r")
                  .join(starts.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source")) & (F.col("r.bucket") == F.col("t.bucket")))
                  .select("doc_id", "tie", "size", "source_size", "target", (F.col("bucket_start") + F.col("running")).alias("upto")), "mix-places")

    def finish(e):
        return F.try_divide((e * F.col("source_size") + F.col("upto")).cast("double"), F.col("target"))

    passes = placed.where("size > 0 and target > 0").select("size", F.explode(F.array(*[finish(F.lit(e)) for e in range(max_repeats)])).alias("finish"))
    last = F.lit(_last_finish(passes, sources.agg(F.sum("source_size")).first()[0] or 0))
    n = sum((F.coalesce(finish(F.lit(e)) <= last, F.lit(False)).cast("long") for e in range(max_repeats)), F.lit(0))
    return placed.select("doc_id", "tie", "size", "source_size", "target", (F.col("size") * n).alias("taken"))


def _last_finish(passes: DataFrame, budget: int) -> float:
    """The last finish time before the running size, in the order of finish times, passes the budget.

    Virtual time is cut into slices and the slice where the budget ends into finer ones, so only one row per
    slice and the passes of one fine slice are ever put in order; a few numbers reach the driver.
    """
    last, start, width = -1.0, 0, 1.0
    while True:
        width /= SLICES
        fine = width < 1.0 / SLICES ** 2  # finish times themselves
        place = F.col("finish") if fine else F.floor(F.col("finish") / F.lit(width))
        parts = passes.groupBy(place.alias("part")).agg(F.sum("size").alias("n"), F.max("finish").alias("last"))
        ends = parts.withColumn("upto", F.lit(start) + F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)))
        fits = ends.where(F.col("upto") <= budget).agg(F.max("last")).first()[0]
        last = last if fits is None else fits
        over = ends.where(F.col("upto") > budget).agg(F.min(F.struct("part", (F.col("upto") - F.col("n")).alias("start")))).first()[0]
        if fine or over is None:
            return last
        passes, start = passes.where(place == over.part), over.start


def apply_mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_repeats: int = 3) -> DataFrame:
    """``docs`` as the mix has them: every column, each row as often as the mix takes it."""
    taken = (mix(docs, weights, max_repeats).where("taken > 0")
             .select(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"), F.expr("cast(taken div size as int)").alias("_n"))
             .groupBy("_id", "_tie").agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_rows")))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.md5(F.coalesce("text", F.lit("")).cast("binary")) == F.col("_tie"))
    place = F.row_number().over(Window.partitionBy("_id", "_tie").orderBy(F.col("source")))
    repeated = docs.join(taken, same)
    # rows that share id and text split their passes evenly, the first ones taking the rest
    share = F.when(F.col("_rows") == 1, F.col("_n")).otherwise(F.floor((F.col("_n") + F.col("_rows") - F.col("_place")) / F.col("_rows")))
    return (repeated.withColumn("_place", place).withColumn("_times", share.cast("int")).where("_times > 0")
            .withColumn("_pass", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*docs.columns))
