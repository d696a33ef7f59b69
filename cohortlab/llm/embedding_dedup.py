"""Embedding near-dedup with a random-projection tree forest (operator 7).

Vectors of one label are split by random directions at the median, again and
again; a vector near a split goes to both sides (spill), and several trees
split differently.  Vectors that share a leaf are compared by cosine in double
precision, pairs at the threshold or above are united into components, and
inside a component all pairs are verified and counted once.

Equal vectors of a label are one representative with a weight.  Leaves and
components of more than ``BLOCK`` members are dealt into blocks that meet two
at a time.  The split points of a label come from about ``SAMPLE`` of its
representatives, chosen by hash and fitted in a task, never on the driver.
Where that sample is too thin for the leaves of a large label, those leaves are
split again from a sample of their own, round after round, so leaves stay as
small at any size.  Every vector is indexed and compared.

Defined cases: vectors with a null label, and null or zero ones or ones with a
null or non-finite component, link with nothing and are kept; vectors of
different lengths never link; repeated rows link with each other; a null
``vec_id`` links with nothing; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from cohortlab.llm.blocks import blocked, merge, pairs_of_blocks, sorted_groups
from cohortlab.llm.common import keep
from cohortlab.llm.components import components
from cohortlab.llm.vectors import typed, usable

THRESHOLD = 0.98
#: LEAST_SAMPLE: sampled vectors that a split needs.  ENOUGH: sampled vectors in a leaf on which it is final, however large it is.
TREES, LEAF, SAMPLE, LEAST_SAMPLE, ENOUGH = 4, 512, 2048, 16, 256
#: Half width of the strip around a split whose vectors go to both sides, times the root of the dimension, since
#: projections of unit vectors spread as one over that root.  Two of them at cosine 0.98 are 0.2 apart, 0.025 on a
#: random direction of 64 dimensions, and part only if 0.08 apart there.
SPILL = 0.32
#: LEAF is at most BLOCK, so a group without a forest is one block.  PART: vectors that meet one copy of their group's forest.
#: OUT_ROWS: rows that a task hands on at once.
BLOCK, PART, OUT_ROWS = 1024, 2048, 4096
#: Marks leaves to be split again, in place of a number of blocks, and groups whose trees are still to be chosen.
AGAIN, ALL_TREES = 0, -1
#: Nodes are numbered in 63 bits.
_DEEPEST = 1 << 61


def _direction(tree: int, node: int, dim: int) -> np.ndarray:
    v = np.random.default_rng((tree, node)).standard_normal(dim)
    return v / np.linalg.norm(v)


def half_width(dim: int, spill: float) -> float:
    return spill / max(dim, 1) ** 0.5


def fit_tree(sample: np.ndarray, members: int, tree: int, most: int = LEAF, spill: float = SPILL, root: int = 1) -> dict[int, float]:
    """Split points by node (children of n: 2n and 2n + 1), until a leaf would hold ``most`` of the ``members``."""
    out: dict[int, float] = {}
    width = half_width(sample.shape[1], spill)
    todo = [(root, sample)]
    while todo:
        node, own = todo.pop()
        if len(own) < LEAST_SAMPLE or len(own) / len(sample) * members <= most or node >= _DEEPEST:
            continue
        at = own @ _direction(tree, node, sample.shape[1])
        cut = float(np.median(at))
        low, high = own[at <= cut + width], own[at >= cut - width]
        if len(low) ** 2 + len(high) ** 2 >= len(own) ** 2:
            continue  # what goes to both sides, such as a dense group, outweighs the split: blocks will part them
        out[node] = cut
        todo += [(2 * node, low), (2 * node + 1, high)]
    return out


def leaves(vectors: np.ndarray, tree: int, cuts: dict[int, float], spill: float = SPILL, root: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(vector number, leaf) of all leaves that each vector is in."""
    who, leaf = [], []
    width = half_width(vectors.shape[1], spill)
    todo = [(root, np.arange(len(vectors)))]
    while todo:
        node, own = todo.pop()
        if node not in cuts:
            who.append(own)
            leaf.append(np.full(len(own), node))
        elif len(own):
            at = vectors[own] @ _direction(tree, node, vectors.shape[1])
            todo += [(2 * node, own[at <= cuts[node] + width]), (2 * node + 1, own[at >= cuts[node] - width])]
    return np.concatenate(who), np.concatenate(leaf)


def leaf_blocks(sample: np.ndarray, members: int, tree: int, cuts: dict[int, float], spill: float, block: int, root: int = 1) -> dict[int, int]:
    """Leaves that are expected to hold more than ``block`` of the ``members``, with the number of blocks to deal them into,
    or ``AGAIN`` where too little of the sample lies in the leaf to leave it unsplit."""
    found, n = np.unique(leaves(sample, tree, cuts, spill, root)[1], return_counts=True)
    blocks = np.ceil(n / len(sample) * members / block).astype(int)
    return {int(f): int(k) if f == root or m >= ENOUGH or f >= _DEEPEST else AGAIN
            for f, m, k in zip(found, n, blocks, strict=True) if k > 1}


def _unit(column) -> np.ndarray:
    x = np.array(column, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _vectors(packed: list[bytes], kind: str) -> np.ndarray:
    return _unit(np.frombuffer(b"".join(packed), kind).reshape(len(packed), -1))


def _linked(vectors: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    i, j = np.nonzero(vectors[left] @ vectors[right].T >= THRESHOLD)
    if same:
        i, j = i[i < j], j[i < j]
    return left[i], right[j]


GROUP = ["label", "dim", "tree", "leaf"]
_GROUP_TYPES = "label long, dim int, tree int, leaf long"


def _packed(rows: DataFrame, kind: str) -> DataFrame:
    """label, dim, rep, vector: the components as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            e = batch.column("embedding")
            at, flat = e.offsets.to_numpy(), e.values.to_numpy(zero_copy_only=False).astype(kind)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("label", "dim", "rep")), pa.array([flat[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())],
                                             names=["label", "dim", "rep", "vector"])

    return rows.select("label", "dim", "rep", "embedding").mapInArrow(run, "label long, dim int, rep long, vector binary")


def _forests(sized: DataFrame, kind: str) -> DataFrame:
    """(group, n, again, forest) of every group with more than ``LEAF`` members, fitted in tasks; ``forest``: per tree
    its number, the split points and the leaves to be dealt into blocks, pickled; ``again``: are there leaves to be split again?"""
    most, spill, block, trees = LEAF, SPILL, BLOCK, TREES
    # a uniform number per representative: about SAMPLE of each group, or all of a smaller one
    at = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), "rep", "vector"), 11) / F.lit(2.0 ** 53)
    sample = sized.where((F.col("n") > most) & (at * F.col("n") < SAMPLE)).select(*GROUP, "n", "rep", "vector")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (label, dim, tree, leaf, n), (_, vectors) in sorted_groups(batches, [*GROUP, "n"], ["rep", "vector"]):
            x, forest = _vectors(vectors, kind), []
            for t in range(trees) if tree == ALL_TREES else [tree]:
                cuts = fit_tree(x, n, t, most, spill, leaf)
                forest.append((t, cuts, leaf_blocks(x, n, t, cuts, spill, block, leaf)))
            again = any(AGAIN in blocks.values() for _, _, blocks in forest)
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in ((label, pa.int64()), (dim, pa.int32()), (tree, pa.int32()), (leaf, pa.int64()), (n, pa.int64()),
                                                                            (again, pa.bool_()), (pickle.dumps(forest), pa.binary()))],
                                             names=[*GROUP, "n", "again", "forest"])

    return (sample.repartition(*GROUP).sortWithinPartitions(*GROUP, "n", "rep")
            .mapInArrow(fit, f"{_GROUP_TYPES}, n long, again boolean, forest binary"))


def _split(sized: DataFrame, forests: DataFrame, kind: str) -> DataFrame:
    """(label, dim, tree, leaf, blocks, rep, vector): every vector in all leaves of its group's forest.

    Forests and vectors meet in tasks: the vectors of a group are dealt into parts of about ``PART``, and each part gets
    a copy of its group's forest.  Nothing grows on the driver with the number of labels.
    """
    spill = SPILL
    parts = F.ceil(F.col("n") / F.lit(PART)).cast("int")
    copies = forests.select(*GROUP, F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(0).alias("row"),
                            F.lit(None).cast("long").alias("rep"), F.lit(None).cast("binary").alias("vector"), "forest")
    vectors = sized.select(*GROUP, F.pmod(F.xxhash64("rep"), parts).cast("int").alias("part"), F.lit(1).alias("row"),
                           "rep", "vector", F.lit(None).cast("binary").alias("forest"))

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def placed(batch, trees, all_who, all_leaf, all_blocks):
            for k in range(0, len(all_who), OUT_ROWS):  # a dense group spills into many leaves
                who, leaf, blocks = (x[k:k + OUT_ROWS] for x in (all_who, all_leaf, all_blocks))
                rows = batch.take(pa.array(who))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("label"), rows.column("dim"), rows.column("tree") if trees is None else pa.array(np.full(len(who), trees, np.int32)),
                     pa.array(leaf.astype(np.int64)), pa.array(blocks.astype(np.int32)), rows.column("rep"), rows.column("vector")],
                    names=[*GROUP, "blocks", "rep", "vector"])

        of, forest = None, None  # the group whose forest came last; it lies before its vectors
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in (*GROUP, "part", "row")), strict=True))
            starts = [k for k in range(len(keys)) if k == 0 or keys[k] != keys[k - 1]]
            whole = []  # rows of groups that are one leaf
            for a, b in zip(starts, [*starts[1:], len(keys)], strict=True):
                if keys[a][-1] == 0:
                    of, forest = keys[a][:-1], pickle.loads(batch.column("forest")[a].as_py())
                    continue
                if keys[a][:-1] != of:
                    whole.append(np.arange(a, b))
                    continue
                x, root = _vectors(batch.column("vector").slice(a, b - a).to_pylist(), kind), keys[a][3]
                for t, cuts, blocks in forest:
                    who, leaf = leaves(x, t, cuts, spill, root)
                    yield from placed(batch, t, a + who, leaf, np.array([blocks.get(f, 1) for f in leaf.tolist()]))
            if whole:
                who = np.concatenate(whole)
                yield from placed(batch, None, who, batch.column("leaf").to_numpy()[who], np.ones(len(who)))

    met = vectors.unionByName(copies).repartition(*GROUP, "part").sortWithinPartitions(*GROUP, "part", "row")
    return met.mapInArrow(grow, f"{_GROUP_TYPES}, blocks int, rep long, vector binary")


def _in_leaves(groups: DataFrame, kind: str) -> DataFrame:
    """(label, dim, tree, leaf, blocks, rep, vector) for ``groups`` (label, dim, rep, vector): every vector in its leaves.

    Each round splits the groups that are left; the leaves of large groups on which a sample says too little are the
    groups of the next round.  A round takes a group of n to leaves of about n * ENOUGH / SAMPLE, so rounds are few.
    """
    groups = groups.withColumns({"tree": F.lit(ALL_TREES), "leaf": F.lit(1).cast("long")})
    done: list[DataFrame] = []
    while True:
        sizes = keep(groups.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "group-sizes")
        sized = groups.join(sizes, GROUP)
        forests = keep(_forests(sized, kind), "forests")
        rows = _split(sized, forests, kind)
        if forests.where("again").isEmpty():
            return reduce(DataFrame.unionByName, [*done, rows])
        rows = keep(rows, "leaves")
        done.append(rows.where(F.col("blocks") != AGAIN))
        groups = rows.where(F.col("blocks") == AGAIN).drop("blocks")


def _forest_edges(reps: DataFrame, kind: str) -> DataFrame:
    """Spanning edges (u, v) of the linked pairs inside leaves; ``kind``: the number type that holds a component exactly."""
    key = GROUP
    rows = _in_leaves(_packed(reps, kind), kind)
    dealt = pairs_of_blocks(rows, F.col("rep"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for now, (ids, vectors, sides) in sorted_groups(batches, [*key, "bi", "bj"], ["rep", "vector", "side"]):
            same = now[-1] == now[-2]
            x, side, ids = _vectors(vectors, kind), np.array(sides), np.array(ids, np.int64)
            left = np.flatnonzero(side == 0)
            i, j = _linked(x, left, left if same else np.flatnonzero(side == 1), same)
            label = np.arange(len(ids))
            merge(label, i, j)
            moved = np.flatnonzero(label != np.arange(len(ids)))
            if len(moved):
                yield pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[label[moved]])], names=["u", "v"])

    return (dealt.repartition(*key, "bi", "bj").sortWithinPartitions(*key, "bi", "bj", "side", "rep")
            .mapInArrow(compare, "u long, v long").distinct())


def _counts(reps: DataFrame, clusters: DataFrame) -> DataFrame:
    """(rep, others): rows linked with each clustered representative, besides its own copies."""
    members = keep(reps.join(clusters.select(F.col("node").alias("rep"), F.col("component").alias("cluster")), "rep"), "members")
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    dealt = blocked(members, ["cluster"], F.col("rep"), sizes, BLOCK)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for now, (ids, vectors, weights, sides) in sorted_groups(batches, ["cluster", "bi", "bj"], ["rep", "embedding", "weight", "side"]):
            same = now[-1] == now[-2]
            x, side, weight = _unit(vectors), np.array(sides), np.array(weights, np.int64)
            left = np.flatnonzero(side == 0)
            i, j = _linked(x, left, left if same else np.flatnonzero(side == 1), same)
            n = np.zeros(len(ids), np.int64)
            np.add.at(n, i, weight[j])
            np.add.at(n, j, weight[i])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n)], names=["rep", "n"])

    return (dealt.repartition("cluster", "bi", "bj").sortWithinPartitions("cluster", "bi", "bj", "side", "rep")
            .select("cluster", "bi", "bj", "rep", "embedding", "weight", "side").mapInArrow(count, "rep long, n long")
            .groupBy("rep").agg(F.sum("n").alias("others")))


def dedup(rows: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``rows`` (vec_id, embedding, label)."""
    all_rows = typed(rows, F.col("label").cast("long").alias("label"))
    good = all_rows.where(usable() & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    reps = keep(good.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"))
                .withColumn("dim", F.size("embedding")), "vectors")
    single = isinstance(rows.schema["embedding"].dataType.elementType, FloatType)
    edges = keep(_forest_edges(reps, "<f4" if single else "<f8"), "links")
    clusters = components(edges)
    found = (reps.select("label", "embedding", "rep", "weight").join(clusters.select(F.col("node").alias("rep"), "component"), "rep", "left")
             .join(_counts(reps, clusters), "rep", "left")
             .select("label", "embedding", F.coalesce("component", "rep").alias("component_id"),
                     (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")))
    linked = good.join(found, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    rest = (all_rows.where(~usable() | F.col("label").isNull() | F.col("vec_id").isNull())
            .select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return linked.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
