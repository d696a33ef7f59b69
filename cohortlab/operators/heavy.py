"""Exact top terms without shuffling every distinct term: certified heavy hitters.

Each task keeps a Misra-Gries summary of at most ``counters`` terms over Arrow
batches: when there are more, the count of the first one too many is taken from
all and those left without a count go.  A task's counts are then too low by at most
what it took off, and so are the merged counts by the sum E of that over the tasks;
a term in no summary has at most E.  If the k-th merged count is above E, all of the top k are
among the candidates whose merged count plus E reaches it, and one more pass
counts the candidates alone, exactly.  Otherwise the summaries are widened and taken
again; with E = 0 the merged counts are exact at once.  What is shuffled is at most
``counters`` terms a task, then the candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.session import keep

#: Terms per summary at first, the factor of a widening, and candidates that may be broadcast (the list is counted first).
COUNTERS, WIDER, BROADCAST_TERMS = 200_000, 8, 1_000_000


def summary(table: pa.Table, counters: int) -> tuple[pa.Table, int]:
    """``term, low, rows`` reduced to ``counters`` terms, and what was taken from each count."""
    if table.num_rows <= counters:
        return table, 0
    low = table["low"].to_numpy()
    cut = int(np.partition(low, len(low) - counters - 1)[len(low) - counters - 1])
    table = table.set_column(1, "low", pc.subtract(table["low"], cut))
    return table.filter(pc.greater(table["low"], 0)), cut


def _summaries(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pa.table({"term": pa.array([], pa.string()), "low": pa.array([], pa.int64()), "rows": pa.array([], pa.int64())})
        off = 0
        for batch in batches:
            new = pa.table({"term": batch.column("term").cast(pa.string()), "low": batch.column("n"), "rows": pa.repeat(pa.scalar(1, pa.int64()), batch.num_rows)})
            own = pa.concat_tables([own, new]).group_by("term").aggregate([("low", "sum"), ("rows", "sum")])
            own, cut = summary(own.select(["term", "low_sum", "rows_sum"]).rename_columns(["term", "low", "rows"]), counters)
            off += cut
        end = pa.table({"term": pa.array([None], pa.string()), "low": pa.array([off], pa.int64()), "rows": pa.array([0], pa.int64())})
        yield from pa.concat_tables([own, end]).combine_chunks().to_batches(max_chunksize=50_000)
    return run


def top_terms(bag: DataFrame, size: int, min_df: int = 1, counters: int = COUNTERS) -> DataFrame:
    """``term, term_count, doc_freq`` of the terms that may be among the ``size`` most frequent with ``doc_freq >= min_df``,
    all of those among them, with exact counts; ``bag``: one row ``term, n`` (n >= 1) per document and term."""
    rows = bag.select(F.col("term").cast("string").alias("term"), F.col("n").cast("long").alias("n")).where("term is not null")
    while True:
        found = keep(rows.mapInArrow(_summaries(counters), "term string, low long, rows long"), "heavy-terms")
        off = found.where("term is null").agg(F.coalesce(F.sum("low"), F.lit(0))).collect()[0][0]
        merged = found.where("term is not null").groupBy("term").agg(F.sum("low").alias("term_count"), F.sum("rows").alias("doc_freq"))
        if not off:
            return merged.where(F.col("doc_freq") >= min_df)
        least = _kth(merged, size)
        if min_df <= 1:
            if least > off:
                return _recounted(rows, keep(merged.where(F.col("term_count") + off >= least).select("term"), "heavy-candidates"))
        else:  # every counted term is a candidate, since frequent terms may fail ``min_df``
            exact = keep(_recounted(rows, keep(merged.select("term"), "heavy-candidates")).where(F.col("doc_freq") >= min_df), "heavy-counts")
            if _kth(exact, size) > off:
                return exact
        counters *= WIDER


def _kth(counts: DataFrame, size: int) -> int:
    """The ``size``-th greatest count, 0 if there are fewer terms."""
    top = counts.select("term_count").orderBy(F.col("term_count").desc()).limit(size).agg(F.min("term_count"), F.count(F.lit(1))).collect()[0]
    return top[0] if top[1] == size else 0


def _recounted(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    few = candidates.count() <= BROADCAST_TERMS
    own = rows.join(F.broadcast(candidates) if few else candidates, "term", "left_semi")
    return own.groupBy("term").agg(F.sum("n").alias("term_count"), F.count(F.lit(1)).alias("doc_freq"))
