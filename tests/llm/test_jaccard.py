from __future__ import annotations

import math
import random

import duckdb
import numpy as np

from cohortlab.llm import jaccard_join as jj
from cohortlab.llm import queries
from cohortlab.llm.components import components

SF = "/root/testdata/sf0.01"


def plain(rows):
    import re
    sets = []
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w and d is not None else set())
    links = [[j for j, b in enumerate(sets) if j != i and a and b and 10 * len(a & b) >= 8 * len(a | b)] for i, a in enumerate(sets)]
    seen, out = {}, []
    for i in range(len(rows)):
        if i in seen:
            continue
        todo, group = [i], {i}
        while todo:
            k = todo.pop()
            near = links[k] + [j for j, (d, _) in enumerate(rows) if d == rows[k][0] and d is not None]
            new = set(near) - group
            group |= new
            todo += new
        for k in group:
            seen[k] = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
    for i, (d, _) in enumerate(rows):
        out.append((d, seen[i], len(links[i])))
    return sorted(out, key=str)


def test_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(queries.ORACLES["op10_jaccard_join"]).fetchall()
    got = queries.QUERIES["op10_jaccard_join"](spark, SF).select("doc_id", "class_id", "n_links").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_planted_groups(spark, docs_of, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK", 16)  # large groups are dealt into blocks
    rng = random.Random(4)
    vocab = ["w%d" % i for i in range(300)]
    base = [rng.choice(vocab) for _ in range(150)]
    rows = [(None, " ".join(base)), (None, " ".join(base)), (1000, None), (1001, ""), (1002, "a b"), (1003, "a  b"), (1004, "a b c"), (1005, " ".join(base)), (1005, " ".join(base))]
    for i in range(90):  # near copies of one text, few to many changes
        t = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 6, 9])):
            t[rng.randrange(len(t))] = rng.choice(vocab)
        rows.append((i, " ".join(t)))
    for i in range(60):  # texts that share a passage only, or nothing
        rows.append((200 + i, " ".join((base[:40] if i % 2 else []) + [rng.choice(vocab) for _ in range(rng.randint(3, 80))])))
    rows.append((300, " ".join([rng.choice(vocab) for _ in range(20_000)])))
    rng.shuffle(rows)
    got = jj.join(docs_of(rows)).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == plain(rows)
    out = jj.apply_join(docs_of(rows))
    assert out.columns == docs_of(rows).columns
    kept = [r.doc_id for r in out.collect()]
    classes = {c for d, c, _ in plain(rows) if d is not None}
    assert sorted(k for k in kept if k is not None) == sorted(classes) and kept.count(None) == 2


def test_empty_table(spark, docs_of):
    none = docs_of([(1, "a")]).where("false")
    assert jj.join(none).count() == 0 and jj.apply_join(none).count() == 0


def test_pruning_bound_is_the_posterior():
    for n in (8, 40):
        for tolerance in (1e-2, 1e-5):
            m = jj.least_matches(n, 0.8, tolerance)
            grid = (np.arange(200_000) + 0.5) / 200_000
            tail = lambda k: (grid ** k * (1 - grid) ** (n - k))[grid >= 0.8].sum() / (grid ** k * (1 - grid) ** (n - k)).sum()
            assert tail(m) >= tolerance and (m == 0 or tail(m - 1) < tolerance)
    lost = sum(math.comb(240, m) * 0.8 ** m * 0.2 ** (240 - m) for m in range(jj.least_matches(240)))
    assert lost < 1e-4


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)] + [(5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for u, v in edges:
        if u != v:
            a, b = find(u), find(v)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in parent if x != 5}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_unrelated_long_texts_are_pruned(docs_of):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(5000)]
    texts = [rng.choices(words, k=1000) for _ in range(12)]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)] + [(100, " ".join([*texts[0][:990], *texts[1][:10]]))]
    got = sorted((r.doc_id, r.sig) for r in jj._signatures(docs_of(rows)).collect())
    sig = np.array([np.frombuffer(s, np.uint8) for _, s in got])
    i, j = np.triu_indices(len(sig), 1)
    assert [(got[a][0], got[b][0]) for a, b in ((i[k], j[k]) for k in jj.survivors(sig, i, j))] == [(0, 100)]
