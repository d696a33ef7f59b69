"""Approximate nearest neighbours with a hash-prefix forest (operator 9).

A vector's hash string in a tree is the signs of ``BITS`` random projections,
and a tree is the sorted array of all hash strings.  Trees are global: an array
is stored in cells, the rows under one prefix, cut into blocks where a prefix
holds many rows, so a query meets only the cells under its own prefixes.

1. Descent: in ``PROBES`` trees a query goes to the cell of its own string and
   climbs there from its longest matching prefix until ``WANT`` rows share it.
   Their inner products bound the angle of the k-th neighbour from above.
2. Ascent: a vector at angle a has the sign of the query's projection z with
   probability Phi(|z| cot a), so the bound gives the chance that all trees miss
   the k-th neighbour at their present lengths.  All trees climb together, a bit of one tree at a time, until
   that chance is at most ``MISS``; nearer neighbours are missed less often.
   Where the prefixes would hold as many rows as a whole tree (vectors with
   next to no structure), the climb ends in the root of one tree, which misses nothing.
3. The rows under the final prefixes, and no others, are compared in double
   precision; the best of all trees are merged by query.

The rule is the same at every size: how many rows are compared follows from
the angles alone (``n_scored`` reports it per query).

Inner product becomes an angle by one more coordinate, sqrt(M^2 - |x|^2) with
the greatest norm M, which is 0 for queries.  Equal vectors are one
representative that carries its smallest ids, so a vector that fills a third of
the table takes one place in the index.

Defined cases: null or zero vectors and ones with a null or non-finite
component take no part, nor does a null ``vec_id``; vectors of another length
than the query are no candidates; of rows that share a ``vec_id`` and vector
one is a candidate, and a query id never finds its own id; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlab.llm.common import keep
from cohortlab.llm.vectors import usable

#: Bits of a hash string, trees, and the chance that the k-th neighbour may be missed.
BITS, TREES, MISS = 62, 16, 0.1
#: Trees of the descent and rows that end it in each.
PROBES, WANT = 4, 1024
#: Rows of a cell or block, about; vectors hashed at once.
CELL, BATCH = 4096, 1024


#: The normal distribution function at steps of 1/512 from -8 to 8.
_AT = np.linspace(-8, 8, 8193)
_NORMAL = np.array([0.5 * (1 + math.erf(z / math.sqrt(2))) for z in _AT])


def projections(x: np.ndarray, rest: np.ndarray | float, trees: int = TREES) -> np.ndarray:
    """[row, tree, bit] random projections of vectors with one more coordinate."""
    rng = np.random.default_rng([17, x.shape[1]])
    own = np.column_stack([x, np.broadcast_to(rest, len(x))])
    return np.stack([own @ rng.standard_normal((own.shape[1], BITS)) for _ in range(trees)], axis=1)


def hashes(projected: np.ndarray) -> np.ndarray:
    """[row, tree] hash strings as numbers, first projection first."""
    return (projected > 0) @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def final_levels(cos: np.ndarray, projected: np.ndarray, miss: float = MISS) -> np.ndarray:
    """[query, tree] prefix lengths at which all trees miss a vector of cosine ``cos`` with a chance of ``miss`` at most; -1: tree not used.

    ``projected`` are the projections of the queries at length 1.  A vector at angle a, in a random direction from the query, keeps
    the sign of a projection z with probability Phi(|z| cot a).
    """
    trees = projected.shape[1]
    cos = np.clip(cos, -1, 1)
    cot = cos / np.sqrt(np.maximum(1 - cos * cos, 1e-30))
    kept = np.cumprod(np.interp(np.abs(projected) * cot[:, None, None], _AT, _NORMAL), axis=2)
    # one tree's chance to miss, longest prefix first; the root misses nothing
    alone = np.log1p(-np.minimum(kept[:, :, ::-1], 1 - 1e-15))
    alone = np.concatenate([alone, np.full((len(cos), trees, 1), -1e9)], axis=2).transpose(0, 2, 1)
    # step s: the first s % trees trees are a bit shorter than the others
    ahead = np.arange(trees)
    shorter = np.cumsum(alone[:, 1:], axis=2) - alone[:, 1:]
    longer = np.cumsum(alone[:, :-1, ::-1], axis=2)[:, :, ::-1]
    enough = ((shorter + longer) <= math.log(max(miss, 1e-300))).reshape(len(cos), -1)
    step = np.where(enough.any(axis=1), enough.argmax(axis=1), enough.shape[1])
    out = BITS - step[:, None] // trees - (ahead[None, :] < step[:, None] % trees)
    root = np.where(ahead == 0, 0, -1)
    return np.where(((0.5 ** out).sum(axis=1) >= 1)[:, None] | (miss <= 0), root, out)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        own = np.flatnonzero(dims == dim)
        for a in range(0, len(own), BATCH):
            part = batch.take(pa.array(own[a:a + BATCH]))
            yield part, _matrix(part.column("embedding"))


def _nearest(vectors: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, inner product) of the ``k`` best rows; products are summed row by row, so equal pairs have equal scores in all trees."""
    score = vectors @ query
    if len(score) > k:
        last = np.partition(score, len(score) - k)[len(score) - k]
        row = np.flatnonzero(score >= last - 1e-9 * abs(last) - 1e-300)
    else:
        row = np.arange(len(score))
    exact = (vectors[row] * query).sum(axis=1)
    best = np.lexsort((row, -exact))[:k] if len(row) > 4 * k else slice(None)  # many ties: the ones of smallest place
    return row[best], exact[best]


def _meet(index: DataFrame, asking: DataFrame, k: int) -> DataFrame:
    """query, found, score, scored: the best ``k`` of each query in each block that it visits.

    ``level`` >= 0: rows under the query's prefix of that length; -1: climb from the longest prefix until ``WANT`` rows share it.
    """
    place = ["dim", "tree", "cell", "block"]
    rows = index.withColumns({"kind": F.lit(0), "level": F.lit(0)}).unionByName(asking.withColumn("kind", F.lit(1)))

    def span(strings: np.ndarray, own: int, level: int) -> tuple[int, int]:
        def under(bits: int) -> tuple[int, int]:
            low = own >> (BITS - bits) << (BITS - bits)
            first, last = np.searchsorted(strings, (low, low + (1 << (BITS - bits))))
            return int(first), int(last)

        if level >= 0:
            return under(level)
        low, high = 0, BITS  # the longest prefix that enough rows share
        while low < high:
            middle = (low + high + 1) // 2
            a, b = under(middle)
            low, high = (middle, high) if b - a >= WANT else (low, middle - 1)
        return under(low)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, strings, ids, vectors = None, [], None, None, None

        for batch in batches:
            keys = np.column_stack([batch.column(c).to_numpy() for c in [*place, "kind"]])
            cuts = np.append(np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))), len(keys)).tolist() if len(keys) else []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                part, where, kind = batch.slice(a, b - a), tuple(keys[a, :4].tolist()), keys[a, 4]
                if where != now:
                    now, parts, vectors = where, [], None
                if kind == 0:
                    parts.append((part.column("hash").to_numpy(), part.column("rep").to_numpy(), _matrix(part.column("embedding"))))
                    continue
                if not parts and vectors is None:
                    continue
                if vectors is None:
                    strings, ids, vectors = (np.concatenate(x) for x in zip(*parts, strict=True))
                    parts = []
                out = []
                own = (part.column("rep").to_pylist(), part.column("hash").to_pylist(), part.column("level").to_pylist())
                for q, h, level, x in zip(*own, _matrix(part.column("embedding")), strict=True):
                    first, last = span(strings, h, level)
                    if last > first:
                        row, score = _nearest(vectors[first:last], x, k)
                        count = np.zeros(len(row), np.int64)
                        count[0] = last - first
                        out.append((np.full(len(row), q), ids[first:last][row], score, count))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["query", "found", "score", "scored"])

    return (rows.repartition(*place).sortWithinPartitions(*place, "kind", "hash", "rep").select(*place, "kind", "hash", "rep", "level", "embedding")
            .mapInArrow(run, "query long, found long, score double, scored long"))


def _best(found: DataFrame, k: int) -> DataFrame:
    """query, found, score, place, n_scored: the ``k`` best distinct ones of each query."""
    own = Window.partitionBy("query")
    once = found.groupBy("query", "found").agg(F.max("score").alias("score"), F.sum("scored").alias("scored"))
    return (once.withColumns({"place": F.row_number().over(own.orderBy(F.desc("score"), "found")), "n_scored": F.sum("scored").over(own)})
            .where(F.col("place") <= k).drop("scored"))


def search(rows: DataFrame, is_query: Column, k: int = 20, miss: float = MISS) -> DataFrame:
    """query_id, rank, vec_id, score, n_scored: the ``k`` nearest found of each query row among all other ids of ``rows``.

    ``miss`` bounds the chance that a neighbour is not found; 0 compares every row.
    """
    good = rows.where(usable() & F.col("vec_id").isNotNull())
    stored = "array<float>" if rows.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"  # a float is half a double to move
    good = good.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(stored).alias("embedding"), is_query.alias("asks"))
    norm = good.agg(F.max(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("norm")).first().norm
    norm = float(norm or 0.0) ** 0.5
    place = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    # of equal vectors only the k + 1 smallest ids can be among a query's nearest k
    first = good.select("vec_id", "embedding").distinct().withColumn("place", place).where(F.col("place") <= k + 1)
    merged = (first.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.array_sort(F.collect_list("vec_id")).alias("ids"))
              .select("rep", "ids", F.size("embedding").alias("dim"), "embedding"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in _by_dim(batch):
                rest = np.sqrt(np.maximum(norm * norm - (x * x).sum(axis=1), 0))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(list(hashes(projections(x, rest))), pa.list_(pa.int64()))], names=[*part.schema.names, "hashes"])

    reps = keep(merged.mapInArrow(hashed, f"rep long, ids array<long>, dim int, embedding {stored}, hashes array<long>"), "vectors")
    n = reps.count()
    bits = max(0, math.ceil(math.log2(max(n, 1) / CELL)))

    def cell(hash_: Column) -> Column:
        return F.shiftright(hash_, BITS - bits)

    strings = reps.select("dim", "rep", F.posexplode("hashes").alias("tree", "hash"), "embedding").withColumn("cell", cell(F.col("hash")))
    sizes = keep(strings.groupBy("dim", "tree", "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(2 * CELL)).cast("int").alias("blocks")), "cells")
    cells = ["dim", "tree", "cell"]
    index = strings.join(sizes, cells).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).drop("blocks")

    asked = good.where("asks").select(F.col("vec_id").alias("query_id"), "embedding").distinct().join(reps.select("embedding", "rep"), "embedding").select("query_id", "rep")
    asked = keep(asked, "queries")
    queries = reps.join(asked.select("rep").distinct(), "rep", "left_semi").select("rep", "dim", "embedding")

    def strings_of(batches: Iterator[pa.RecordBatch], trees: int) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in _by_dim(batch):
                length = np.sqrt((x * x).sum(axis=1))
                projected = projections(x / length[:, None], 0.0)
                own = hashes(projected)
                if "bound" in part.schema.names:
                    bound = part.column("bound").to_numpy(zero_copy_only=False).astype(np.float64)
                    cos = bound / (length * norm)
                    levels = final_levels(np.where(np.isnan(cos), -1.0, cos), projected, miss)
                else:
                    levels = np.where(np.arange(TREES) < trees, -1, -2)[None, :].repeat(len(x), axis=0)
                for tree in range(trees):
                    use = np.flatnonzero(levels[:, tree] >= (0 if "bound" in part.schema.names else -1))
                    if len(use):
                        some = part.take(pa.array(use))
                        yield pa.RecordBatch.from_arrays(
                            [some.column("rep"), some.column("dim"), pa.array(np.full(len(use), tree, np.int32)), pa.array(own[use, tree]),
                             pa.array(levels[use, tree].astype(np.int32)), some.column("embedding")], names=["rep", "dim", "tree", "hash", "level", "embedding"])

    out = f"rep long, dim int, tree int, hash long, level int, embedding {stored}"
    # 1. descent: the cell of the query's own string, one block of it
    probes = queries.mapInArrow(lambda b: strings_of(b, PROBES), out).withColumn("cell", cell(F.col("hash"))).join(sizes, cells)
    probes = probes.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).drop("blocks")
    near = _best(_meet(index.where(F.col("tree") < PROBES), probes, k + 1), k + 1)
    bound = near.where(F.col("place") == k + 1).select(F.col("query").alias("rep"), F.col("score").alias("bound"))
    # 2. ascent: all cells and blocks under the final prefixes
    ready = queries.join(bound, "rep", "left").mapInArrow(lambda b: strings_of(b, TREES), out)
    short = F.least("level", F.lit(bits))
    low = F.call_function("shiftleft", F.call_function("shiftright", "hash", F.lit(BITS) - short), F.lit(bits) - short)
    width = F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(bits) - short)
    visits = ready.withColumn("cell", F.explode(F.sequence(low, low + width - 1))).join(sizes, cells)
    visits = visits.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    # 3. compare
    best = _best(_meet(index, visits, k + 1), k + 1).drop("place")
    ids = (asked.join(best.withColumnRenamed("query", "rep"), "rep").select("query_id", "found", "score", "n_scored")
           .join(reps.select(F.col("rep").alias("found"), "ids"), "found").select("query_id", F.explode("ids").alias("vec_id"), "score", "n_scored")
           .where(F.col("vec_id") != F.col("query_id")).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"), F.max("n_scored").alias("n_scored")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return ids.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "n_scored")
