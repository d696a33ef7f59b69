"""Pairs inside groups of any size: groups are dealt into blocks, and two blocks at a time meet in a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Least labels after joining all pairs (i, j), in place."""
    while True:
        low = np.minimum(label[i], label[j])
        if (low == label[i]).all() and (low == label[j]).all():
            return
        # the labels' own entries move too, so whole classes follow
        for k in (i, j):
            np.minimum.at(label, label[k], low)
            np.minimum.at(label, k, low)
        label[:] = label[label]


def pairs_of_blocks(rows: DataFrame, member: Column) -> DataFrame:
    """Rows, repeated for each pair of the ``blocks`` of their group (bi <= bj) that their own block is in; ``side`` 0 is block bi."""
    dealt = (rows.withColumn("own", F.pmod(F.xxhash64(member), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    return (dealt.withColumn("bi", F.least("own", "other")).withColumn("bj", F.greatest("own", "other"))
            .withColumn("side", (F.col("own") > F.col("other")).cast("int")).drop("blocks", "own", "other"))


def blocked(rows: DataFrame, group: list[str], member: Column, sizes: DataFrame, block: int) -> DataFrame:
    """``pairs_of_blocks`` of the groups with >= 2 members."""
    blocks = F.ceil(F.col("size") / F.lit(block)).cast("int")
    return pairs_of_blocks(rows.join(sizes.where("size > 1"), group).withColumn("blocks", blocks).drop("size"), member)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str], columns: list[str]):
    """(key values, one list per column) of each row group; the partition is sorted by ``keys``."""
    now, rows = None, []
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in [*keys, *columns]]
        for row in zip(*cols, strict=True):
            if row[:len(keys)] != now:
                if rows:
                    yield now, [list(c) for c in zip(*rows, strict=True)]
                now, rows = row[:len(keys)], []
            rows.append(row[len(keys):])
    if rows:
        yield now, [list(c) for c in zip(*rows, strict=True)]
