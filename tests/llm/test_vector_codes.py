from __future__ import annotations

import hashlib
import math
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from cohortlab.llm import queries, vector_codes

SF = "/root/testdata/sf0.01"


def plain(rows):
    """The contract in Python integers, one vector at a time."""
    rows = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not rows:
        return []
    width = -(-max(len(v) for _, v, _ in rows) // 4) * 4
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    xs = [[math.floor(1024 * Fraction(x)) for x in v] + [0] * (width - len(v)) for _, v, _ in rows]
    q = width // 4
    parts = [[tuple(x[p * q:(p + 1) * q]) for x in xs] for p in range(4)]
    books = [own[:256] for own in parts]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def nearest(x, book):
        return min((dist(x, e), i) for i, e in enumerate(book))

    for _ in range(4):
        for p in range(4):
            sums: dict = {}
            for x in parts[p]:
                own = sums.setdefault(nearest(x, books[p])[1], [])
                own.append(x)
            books[p] = [tuple(sum(c) // len(sums[i]) for c in zip(*sums[i], strict=True)) if i in sums else e for i, e in enumerate(books[p])]
    found = [[nearest(parts[p][r], books[p]) for p in range(4)] for r in range(len(rows))]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    error = [sum(d for d, _ in f) for f in found]
    top = 2 ** 63 - 1
    return sorted(((i, "".join(f"{e:02x}" for _, e in f), min(err, top), min(sum(min(x, top) for x, r in zip(error, rows, strict=True) if r[2] == lab), top), sha)
                   for (i, _, lab), f, err in zip(rows, found, error, strict=True)), key=str)


def clustered(n, dim, seed, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dim))
    return [[float(x) for x in np.float32(centres[rng.integers(12)] + rng.standard_normal(dim) * spread)] for _ in range(n)]


def odd_rows():
    rows = [(i, v, [1, 2, None][i % 3]) for i, v in enumerate(clustered(330, 8, 1))]
    rows += [(1000 + i, rows[7][1], 1) for i in range(150)]  # a group of copies
    rows += [(3, rows[9][1], 2), (None, rows[11][1], None), (2000, None, 1), (2001, [1.0, None] * 4, 1), (2002, [math.nan] * 8, 1),
             (2003, [math.inf] + [0.0] * 7, 1), (2004, [0.0] * 8, 1), (2005, [1.0, 2.0, 3.0], 1), (2006, [], None)]
    return rows


CASES = {"odd": odd_rows(), "few": [(i, v, 1) for i, v in enumerate(clustered(9, 6, 2))], "one": [(5, [0.5, -0.5], None)],
         "empty": [(1, None, 1)], "huge": [(i, [1e30 * x for x in v], i % 2) for i, v in enumerate(clustered(40, 4, 3))] + [(99, [1e-3] * 4, 1)],
         "ties": [(i, [float(i % 4), float(i % 3), 0.0, 1.0], 0) for i in range(300)], "hollow": [(1, [], 1), (2, [], 2)]}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("kind", ["float", "double"])
def test_matches_plain_version(spark, name, kind):
    rows = CASES[name]
    if kind == "double" and name == "huge":
        rows = rows + [(100, [1e308, -1e308, 1.7e308, 5e-324], 1)]
    elif kind == "float":
        rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in rows]
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").selectExpr("*", "1 AS code", "2 AS error", "3 AS v", "4 AS n")
    got = sorted((tuple(r) for r in vector_codes.compress(frame.repartition(4)).collect()), key=str)
    assert got == plain(rows)


def test_bounds_spare_distances_and_stay_true(spark):
    vectors = clustered(3000, 16, 4)
    x = np.floor(np.array(vectors) * 1024)
    books = vector_codes.Codebooks.start(x[:256])
    n, g = len(x), vector_codes.GROUPS
    code, low, stamp = np.zeros((n, 4), np.uint8), np.zeros((n, 4 * g), np.float32), np.zeros((n, 4 * g), np.uint8)
    done = []
    for t in range(5):
        if t:
            means = []
            for p, own in enumerate(np.split(x, 4, axis=1)):
                means.append(np.array([np.floor(own[code[:, p] == e].mean(axis=0)) if (code[:, p] == e).any() else books.history[-1][p][e] for e in range(256)]))
            books = books.then(means)
        code, low, stamp, error, d = vector_codes._renew(books, x, code, low, stamp)
        done.append(d / n)
        assert (error == sum(vector_codes.distances(own, books.history[-1][p]).min(axis=1) for p, own in enumerate(np.split(x, 4, axis=1)))).all()
        for p, own in enumerate(np.split(x, 4, axis=1)):
            moved, dist = books.moved(p), np.sqrt(vector_codes.distances(own, books.history[-1][p]))
            dist[np.arange(n), code[:, p]] = np.inf
            for k, members in enumerate(books.groups[p]):
                bound = low[:, p * g + k] - moved[stamp[:, p * g + k], k]
                assert (bound <= dist[:, members].min(axis=1) + 1e-3).all()
            # the net displacement is never more than the drifts of the rounds between
            drift = np.array([[np.sqrt(((b[p][m] - a[p][m]) ** 2).sum(axis=1)).max() for m in books.groups[p]] for a, b in zip(books.history, books.history[1:])])
            for old in range(t):
                assert (moved[old] <= drift[old:].sum(axis=0) * (1 + 1e-6)).all()
    assert done[0] > 1024 and max(done[2:]) < 0.5 * done[0]


def test_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.sql(queries.ORACLES["op12_vector_codes"]).fetchall()
    assert sorted(tuple(r) for r in queries.QUERIES["op12_vector_codes"](spark, SF).collect()) == sorted(want)
