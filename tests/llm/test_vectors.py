from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlab.llm import ann_forest, embedding_dedup, queries

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int"


def valid(e):
    return e is not None and len(e) > 0 and all(x is not None and math.isfinite(x) for x in e) and any(x != 0 for x in e)


def frame(spark, rows):
    from pyspark.sql import functions as F
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("rep", "weight", "size", "segment", "rank", "score")})


def planted(seed=0):
    rng = np.random.default_rng(seed)
    v = lambda x: [float(a) for a in np.float32(x)]
    rows, i = [], 0
    for c in range(25):
        centre = rng.standard_normal(16)
        for _ in range(rng.integers(1, 9)):
            rows.append((i, v(centre + rng.standard_normal(16) * rng.choice([0.02, 0.05, 0.1, 0.15])), int(c % 3)))
            i += 1
    hot = rng.standard_normal(16)
    rows += [(1000 + k, v(hot), 1) for k in range(60)] + [(2000, v(2 * hot), 1), (2001, v(hot), 2)]
    rows += [(1, None, 1), (3000, [0.0] * 16, 1), (3001, [float("nan")] + [1.0] * 15, 1), (3002, [None] + [1.0] * 15, 1), (3003, v(hot), None),
             (3004, [float("inf")] + [1.0] * 15, 1), (3005, [1.0, 2.0], 1), (3006, [1.0, 2.0], 1), (None, v(hot), 1), (3007, [], 1), (1000, v(hot), 1)]
    return rows


def plain_links(rows):
    n, links = len(rows), [[] for _ in rows]
    for i in range(n):
        for j in range(n):
            (a, x, lx), (b, y, ly) = rows[i], rows[j]
            if i != j and None not in (a, b, lx, ly) and lx == ly and valid(x) and valid(y) and len(x) == len(y):
                x, y = np.array(x), np.array(y)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                    links[i].append(j)
    out = []
    for i in range(n):
        todo, seen = [i], {i}
        while todo:
            new = set(links[todo.pop()]) - seen
            seen |= new
            todo += new
        c = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(links[i]), c, rows[i][0] is None or c == rows[i][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("leaf, block", [(512, 1024), (8, 8)])
def test_planted_copies(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(embedding_dedup, "LEAF", leaf)
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = planted()
    got = embedding_dedup.dedup(frame(spark, rows)).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=str) == plain_links(rows)


def test_forests_of_many_labels_stay_off_the_driver(spark, monkeypatch):
    """No label's vectors are collected, and no table with rows per label is broadcast whatever its size."""
    from pyspark.sql import DataFrame
    monkeypatch.setattr(embedding_dedup, "LEAF", 8)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 8)
    monkeypatch.setattr(embedding_dedup, "PART", 16, raising=False)
    rng = np.random.default_rng(5)
    rows = []
    for label in range(40):
        centres = rng.standard_normal((8, 16))
        rows += [(1000 * label + k, [float(a) for a in np.float32(centres[k % 8] + 0.05 * rng.standard_normal(16))], label) for k in range(30)]
    seen = []
    collect, real = DataFrame.collect, embedding_dedup._forest_edges

    def watched(reps, kind):
        monkeypatch.setattr(DataFrame, "collect", lambda self: seen.append(self.columns) or collect(self))
        edges = real(reps, kind)
        monkeypatch.setattr(DataFrame, "collect", collect)
        assert "strategy=broadcast" not in edges._jdf.queryExecution().logical().toString()
        return edges
    monkeypatch.setattr(embedding_dedup, "_forest_edges", watched)
    got = embedding_dedup.dedup(frame(spark, rows)).collect()
    assert not seen
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=str) == plain_links(rows)


@pytest.mark.parametrize("dim", [16, 64, 384, 768])
def test_forest_splits_and_keeps_near_pairs_in_any_dimension(dim):
    """With the shipped constants: leaves far below the group, and near pairs that share one in some tree."""
    rng = np.random.default_rng(dim)
    x = rng.standard_normal((2048, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    # partners at cosine 0.98
    away = rng.standard_normal(x.shape)
    away -= (away * x).sum(axis=1, keepdims=True) * x
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    partners = 0.98 * x + math.sqrt(1 - 0.98 ** 2) * away
    together = np.zeros(len(x), bool)
    for tree in range(embedding_dedup.TREES):
        cuts = embedding_dedup.fit_tree(x, 100_000, tree)
        who, leaf = embedding_dedup.leaves(x, tree, cuts)
        assert len(cuts) >= 15 and np.unique(leaf, return_counts=True)[1].max() < 0.25 * len(x)
        own = set(zip(who.tolist(), leaf.tolist(), strict=True))
        for i, f in zip(*(a.tolist() for a in embedding_dedup.leaves(partners, tree, cuts)), strict=True):
            together[i] |= (i, f) in own
    assert together.mean() > 0.995


def test_leaves_of_a_large_label_are_split_again_from_their_own_sample(spark, monkeypatch):
    """A sample of a 1/64 of the label: thin leaves go on, a dense group ends in blocks, and every link is found."""
    for name, value in (("LEAF", 32), ("BLOCK", 40), ("SAMPLE", 128), ("LEAST_SAMPLE", 8), ("ENOUGH", 32), ("PART", 512)):
        monkeypatch.setattr(embedding_dedup, name, value)
    rng = np.random.default_rng(11)
    x = rng.standard_normal((8000, 48))
    x[4000:5000] = x[0] + 0.02 * rng.standard_normal((1000, 48))  # near copies, one dense group
    x[5000:6000] = x[1000:2000] * 3 + 0.05 * rng.standard_normal((1000, 48))
    rows = [(i, [float(a) for a in np.float32(v)], 0 if i < 7900 else 1) for i, v in enumerate(x)]
    seen = []
    real = embedding_dedup._in_leaves

    def watched(groups, kind):
        out = real(groups, kind).persist()
        seen.append([(r.n, r.blocks) for r in out.groupBy("label", "tree", "leaf", "blocks").agg(F.count("rep").alias("n")).collect()])
        assert out.select("rep").distinct().count() == 8000 and out.where("blocks < 1").isEmpty()
        return out
    monkeypatch.setattr(embedding_dedup, "_in_leaves", watched)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.dedup(frame(spark, rows)).collect()}
    unit = np.array([v for _, v, _ in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label[None])
    np.fill_diagonal(near, False)
    least = np.arange(8000)
    while True:
        new = np.minimum(least, np.where(near, least[None], 8000).min(axis=1))
        if (new == least).all():
            break
        least = new
    assert {i: (int(n), int(c)) for i, n, c in zip(range(8000), near.sum(axis=1), least, strict=True)} == got
    # leaves are small, or are the dense group, which is dealt into blocks
    assert len(seen[0]) > 4 * 64 and all(n <= 2 * 40 * blocks for n, blocks in seen[0])


def test_dedup_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.sql(queries.ORACLES["op7_embedding_dedup"]).fetchall()
    got = queries.QUERIES["op7_embedding_dedup"](spark, SF).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == sorted(want)


def test_trees_keep_near_pairs_together():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((4000, 64))
    x = np.vstack([x, x[:1000] + 0.02 * rng.standard_normal((1000, 64)) * np.linalg.norm(x[:1000], axis=1, keepdims=True)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = [i for i in range(1000) if x[i] @ x[4000 + i] >= 0.98]
    assert len(near) > 500
    met, most = set(), 0
    for t in range(embedding_dedup.TREES):
        who, leaf = embedding_dedup.leaves(x, t, embedding_dedup.fit_tree(x[::3], len(x), t))
        assert set(who.tolist()) == set(range(len(x)))
        most = max(most, np.unique(leaf, return_counts=True)[1].max())
        places = {}
        for w, n in zip(who.tolist(), leaf.tolist(), strict=True):
            places.setdefault(w, set()).add(n)
        met |= {i for i in near if places[i] & places[4000 + i]}
    assert len(met) == len(near) and most < len(x) / 2


def plain_nearest(rows, k):
    good = {(i, tuple(e)) for i, e, _ in rows if i is not None and valid(e)}
    out = {}
    for q, e in good:
        if q % 20:
            continue
        for i, f in good:
            if i != q and len(e) == len(f):
                s = float(np.array(e, np.float64) @ np.array(f, np.float64))
                out.setdefault(q, {})
                out[q][i] = max(s, out[q].get(i, -math.inf))
    return {q: sorted(((round(-s, 12), i) for i, s in found.items()))[:k] for q, found in out.items()}


def test_planted_neighbours_are_exact_when_none_may_be_missed(spark):
    from pyspark.sql import functions as F
    rows = planted(3)
    got = {}
    for r in ann_forest.search(frame(spark, rows), F.col("vec_id") % 20 == 0, k=7, miss=0.0).collect():
        got.setdefault(r.query_id, []).append((r.rank, round(-r.score, 12), r.vec_id))
    want = plain_nearest(rows, 7)
    assert {q: [(s, i) for _, s, i in sorted(v)] for q, v in got.items()} == want
    assert all([r for r, _, _ in sorted(v)] == list(range(1, len(v) + 1)) for v in got.values())
    assert ann_forest.search(frame(spark, rows).where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_recall_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding, 0) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    x = np.array([e for _, e, _ in rows], np.float64)
    ids = np.array([i for i, _, _ in rows])
    found = {}
    for r in queries.QUERIES["op9_nearest_neighbours"](spark, "/root/testdata/sf0.1").collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for n in np.flatnonzero(ids % 20 == 0):
        s = x @ x[n]
        s[n] = -np.inf
        top = set(ids[np.argsort(-s)[:20]].tolist())
        hits += len(top & found[int(ids[n])])
        total += len(top)
    assert hits >= 0.9 * total


def test_final_levels_are_the_longest_that_miss_seldom_enough():
    trees, miss = 5, 0.1
    z = np.random.default_rng(3).standard_normal((4, trees, ann_forest.BITS))
    cosines = np.array([0.9999, 0.99, 0.97, -0.5])
    for cos, own, levels in zip(cosines, z, ann_forest.final_levels(cosines, z, miss).tolist(), strict=True):
        def chance(lengths):
            out = 1.0
            for t, n in enumerate(lengths):  # noqa: B023
                kept = [0.5 * (1 + math.erf(abs(x) * cos / math.sqrt(1 - cos * cos) / math.sqrt(2))) for x in own[t][:n]]  # noqa: B023
                out *= 1 - math.prod(kept)
            return out

        if -1 in levels:  # the root of one tree
            assert levels == [0, -1, -1, -1, -1]
            continue
        assert max(levels) - min(levels) <= 1 and levels == sorted(levels) and chance(levels) <= miss
        last = [t for t, n in enumerate(levels) if n == levels[0]][-1] if max(levels) > min(levels) else trees - 1  # the tree that climbed last
        if levels[last] < ann_forest.BITS:
            assert chance([n + (t == last) for t, n in enumerate(levels)]) > miss
    assert (ann_forest.final_levels(cosines, z, 0.0) == [0, -1, -1, -1, -1]).all()


def test_kept_signs_follow_the_projections():
    rng = np.random.default_rng(8)
    x, cos = unit(rng.standard_normal((1, 48))), 0.9
    other = rng.standard_normal((4000, 48))
    other = unit(other - (other @ x.T) * x)
    y = cos * x + math.sqrt(1 - cos * cos) * other
    first, second = ann_forest.projections(x, 0.0), ann_forest.projections(y, 0.0)
    kept = np.interp(np.abs(first) * cos / math.sqrt(1 - cos * cos), ann_forest._AT, ann_forest._NORMAL)
    same = ((first > 0) == (second > 0)).mean(axis=0)
    assert abs(same - kept[0]).mean() < 0.03 and abs(same.mean() - kept.mean()) < 0.01
    strings = ann_forest.hashes(first)
    assert [f"{h:062b}" for h in strings[0].tolist()] == ["".join("01"[int(b)] for b in t > 0) for t in first[0]]


def nearest_of_forest(spark, x):
    """Recall at 20 and rows compared of each query (ids divisible by 50) of unit vectors."""
    import pandas as pd
    from pyspark.sql import functions as F
    table = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": [r.tolist() for r in np.float32(x)]}))
    got = ann_forest.search(table, F.col("vec_id") % 50 == 0).toPandas()
    x = np.float64(np.float32(x))
    recall, scored = {}, got.groupby("query_id").n_scored.first().to_dict()
    found = got.groupby("query_id").vec_id.apply(set).to_dict()
    for q in range(0, len(x), 50):
        s = x @ x[q]
        s[q] = -np.inf
        recall[q] = len(set(np.argpartition(-s, 20)[:20].tolist()) & found.get(q, set())) / 20
    return recall, scored


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def clustered(rng, n, dim=48, size=40):
    """``n`` vectors in clusters of about ``size``, whatever ``n`` is."""
    centres = unit(rng.standard_normal((n // size, dim)))
    return unit(centres[rng.integers(0, len(centres), n)] + 0.35 * rng.standard_normal((n, dim)) / dim ** 0.5)


def test_recall_over_several_cells_inside_and_outside_a_hot_group(spark):
    rng = np.random.default_rng(4)
    n = 24_000
    for base in (unit(rng.standard_normal((n, 48))), clustered(rng, n)):
        hot = rng.permutation(n)[:n // 3]  # near copies of one vector: a third of all rows
        base[hot] = unit(base[hot[0]] + 0.1 * rng.standard_normal((len(hot), 48)) / 48 ** 0.5)
        recall, _ = nearest_of_forest(spark, base)
        inside = np.isin(list(recall), hot)
        values = np.array(list(recall.values()))
        assert values[inside].mean() >= 0.9 and values[~inside].mean() >= 0.9


def test_rows_compared_grow_slower_than_the_table(spark):
    rng = np.random.default_rng(6)
    means = []
    for n in (6_000, 24_000):
        recall, scored = nearest_of_forest(spark, clustered(rng, n))
        assert np.mean(list(recall.values())) >= 0.9
        means.append(np.mean(list(scored.values())))
    assert means[1] < 3.5 * means[0] and means[1] < 0.03 * 24_000
