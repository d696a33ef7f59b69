from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from cohortlab.llm import periodic_runs, queries

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words):
    """(start, length, period) by comparing the text with itself at every distance."""
    code = {}
    x = np.array([code.setdefault(w, len(code)) for w in words], np.int64)
    n, best = len(x), {}
    for p in range(1, n // 2 + 1):
        same = np.concatenate([[0], (x[p:] == x[:-p]).astype(np.int8), [0]])
        edges = np.flatnonzero(np.diff(same))
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if e - s + p >= max(12, 2 * p):
                best.setdefault((s, e - s + p), p)  # the smallest period of a stretch comes first
    return sorted((s, k, p) for (s, k), p in best.items())


def plain(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, k, p in runs for i in range(s + p, s + k)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            sha("".join(f"{s},{k},{p}\n" for s, k, p in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def texts():
    rnd = random.Random(3)
    out = [None, "", " \n\t ", "a", "a " * 11, "a " * 12, "a b " * 6, "a b c d e f " * 2, "a b c d e f g " * 2, "x " * 5000, "a b " * 900 + "c " + "a b " * 900]
    for k in (7, 8, 9, 15, 16, 17, 300, 511, 512, 513, 1024):  # about the borders of octaves and tiles
        unit = " ".join(f"u{rnd.randrange(10 ** 6)}" for _ in range(k)) + " "
        out += ["head " + unit * 2, "head " * 3 + unit * 3 + "tail", (unit * 9 + "cut ") * 2]
    for _ in range(80):
        words = []
        while len(words) < rnd.choice([20, 60, 3000]):
            unit = [rnd.choice("abc") for _ in range(rnd.choice([1, 2, 3, 5, 9, 20, 40]))]
            words += unit * rnd.randrange(1, 7) + [rnd.choice("abcdefgh")]
        out.append(rnd.choice([" ", "  ", "\n"]).join(words))
    return out


def test_matches_plain_version(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(5, "b " * 30), (None, "c d " * 40)]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 5
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS n", "3 AS words", "4 AS lo")
    got = sorted((tuple(r) for r in periodic_runs.digest(docs.repartition(5)).collect()), key=str)
    assert got == sorted((plain(*r) for r in rows), key=str)


def test_runs_of_the_operator(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    got = sorted(tuple(r) for r in periodic_runs.runs(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted((i, *r) for i, t in rows for r in plain_runs(WORD.findall(t or "")))


def test_small_tiles_stitch(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "STRIDE", 12)
    monkeypatch.setattr(periodic_runs, "STRIDE_STEPS", 3)
    for t in texts():
        words = WORD.findall(t or "")
        flat, bounds = periodic_runs.numbered([["other", "x"] * 20, words, ["x"] * 5])
        parts: dict[int, list] = {}
        for text, lo, start, end in periodic_runs.live_tiles(flat, bounds):
            if text == 1:
                for p, own in periodic_runs.solve(flat[bounds[1] + start:bounds[1] + end].tolist(), lo).items():
                    parts.setdefault(p, []).extend([start + a, start + b] for a, b in own)
        found: dict = {}
        for p, own in sorted(parts.items()):
            joined: list = []
            for a, b in sorted(own):
                if joined and a <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], b)
                else:
                    joined.append([a, b])
            for a, b in joined:
                if b - a + p >= max(12, 2 * p):
                    found.setdefault((a, b - a + p), p)
        assert sorted((a, k, p) for (a, k), p in found.items()) == plain_runs(words)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert periodic_runs.digest(docs).collect() == [] == periodic_runs.runs(docs).collect()


def test_long_text_is_many_tiles():
    words = [f"w{i}" for i in range(200_000)] + ["a", "b", "c"] * 40_000
    flat, bounds = periodic_runs.numbered([words])
    tiles = list(periodic_runs.live_tiles(flat, bounds))
    assert len([t for t in tiles if t[1] == 1]) > 100 and min(t[2] for t in tiles if t[1] == 1) > 190_000
    assert sum(t[3] - t[2] for t in tiles if t[1] <= 64) < 12 * len(words)


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_query_on_the_whole_table(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in queries.QUERIES["op13_periodic_runs"](spark, f"/root/testdata/{sf}").collect()), key=str)
    assert got == sorted((plain(*d) for d in docs), key=str)
