from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortlab.llm import queries, repeats, suffix_repeats, superkmer

SF = "/root/testdata/sf0.01"


def units_gone(docs, split, width):
    """Per row the positions under a window that also starts in a document with a smaller id."""
    least = {}
    rows = [(d, split(t or "")) for d, t in docs]
    for d, units in rows:
        if d is not None:
            for i in range(len(units) - width + 1):
                w = tuple(units[i:i + width])
                least[w] = min(least.get(w, d), d)
    out = []
    for d, units in rows:
        gone = set()
        if d is not None:
            for i in range(len(units) - width + 1):
                if least[tuple(units[i:i + width])] < d:
                    gone |= set(range(i, i + width))
        out.append((d, units, gone))
    return out


def words(text):
    import re
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def plain_words(docs, width=50):
    out = []
    for d, units, gone in units_gone(docs, words, width):
        kept = " ".join(w for i, w in enumerate(units) if i not in gone)
        out.append((d, len(units), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def plain_bytes(docs, width=50):
    out = []
    for d, units, gone in units_gone(docs, lambda t: t.encode(), width):
        kept = bytes(b for i, b in enumerate(units) if i not in gone)
        spans = sum(1 for g in gone if g - 1 not in gone)
        out.append((d, len(units), len(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def planted(seed, n=60):
    """Documents with copies, near copies, shared passages, a hot passage, repeats inside one document and odd rows."""
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(400)] + ["é", "x\0y", "z" * 30]
    text = lambda k: [rng.choice(vocab) for _ in range(k)]
    hot, shared = text(70), [text(rng.randint(45, 160)) for _ in range(6)]
    docs = [(None, " ".join(hot)), (-5, " ".join(text(40) + hot)), (500, None), (501, ""), (502, " \t\n"), (503, "a" * 3000), (504, "a" * 2999 + " b"),
            (505, "u v " * 400), (506, "u v " * 390 + "end"), (507, " ".join(hot * 3))]
    for i in range(n):
        body = text(rng.randint(0, 120))
        if i % 3 == 0:
            body += hot + text(rng.randint(0, 30))
        if i % 4 == 1:
            body += rng.choice(shared) + text(5)
        if i % 10 == 7 and docs:
            body = (rng.choice(docs)[1] or "").split()
            if i % 20 == 7 and len(body) > 60:
                body[rng.randrange(len(body))] = "changed"
        docs.append((rng.randrange(100) if i % 15 == 3 else 1000 - i, rng.choice([" ", "  ", "\n", "\x0b", "  "]).join(body)))
    rng.shuffle(docs)
    return docs


def test_planted_words(spark, docs_of):
    docs = planted(1) + [(3, "same row " * 60)] * 2
    got = superkmer.dedup(docs_of(docs)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == plain_words(docs)
    out = superkmer.apply_dedup(docs_of(docs))
    assert out.columns == docs_of(docs).columns
    left = sorted(len(words(r.text or "")) for r in out.collect())
    want = [n - k for _, n, k, _ in plain_words(docs) if n == 0 or k < n]
    assert left == sorted(want)


def test_planted_bytes(spark, docs_of):
    docs = planted(2) + [(3, "same row " * 60)] * 2
    got = suffix_repeats.dedup(docs_of(docs)).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str) == plain_bytes(docs)
    assert all(sum(b - a for a, b in r.removed) == r.n_removed and len(r.removed) == r.n_spans for r in got)


def test_small_table_bytes_by_brute_force(spark, sf_docs):
    docs = [(d, t) for d, t, *_ in sf_docs]
    least, out = {}, []
    for d, t in sorted(docs):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 49):
            if least.setdefault(b[i:i + 50], d) < d:
                gone[i:i + 50] = True
        raw = np.frombuffer(b, np.uint8)
        runs = int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())
        out.append((d, len(b), int(gone.sum()), runs, hashlib.sha256(raw[~gone].tobytes()).hexdigest()))
    got = queries.QUERIES["op6_suffix_repeats"](spark, SF).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(out)


def test_words_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(queries.ORACLES["op4_super_kmer_dedup"]).fetchall()
    got = queries.QUERIES["op4_super_kmer_dedup"](spark, SF).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted(want)


def test_empty_table(spark, docs_of):
    none = docs_of([(1, "a")]).where("false")
    assert superkmer.dedup(none).count() == 0 and suffix_repeats.dedup(none).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab\0é", max_size=40), min_size=1, max_size=6), st.integers(1, 6))
def test_maximal_repeats_are_all_and_complete(texts, least):
    strings = [t.encode() for t in texts]
    group, length, no, offset = suffix_repeats.maximal_repeats(strings, least)
    got = defaultdict(set)
    for g, n, i, o in zip(group, length, no, offset, strict=True):
        got[g, strings[i][o:o + n]].add((int(i), int(o)))
    assert len(got) == len({g for g, _ in got})  # one string per group
    found = {s: at for (_, s), at in got.items()}
    everywhere = defaultdict(set)
    for i, s in enumerate(strings):
        for o in range(len(s)):
            for n in range(least, len(s) - o + 1):
                everywhere[s[o:o + n]].add((i, o))
    want = {}
    for s, at in everywhere.items():
        before = [strings[i][o - 1] if o else (i, o) for i, o in at]
        after = [strings[i][o + len(s)] if o + len(s) < len(strings[i]) else (i, o) for i, o in at]
        if len(at) > 1 and len(set(before)) > 1 and len(set(after)) > 1:
            want[s] = at
    assert found == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=5, max_size=60), st.integers(2, 5))
def test_window_names(numbers, width):
    names = superkmer.window_names(np.array(numbers), width)
    windows = [tuple(numbers[i:i + width]) for i in range(len(numbers) - width + 1)]
    assert len(names) == len(windows)
    assert len(set(zip(names.tolist(), windows, strict=True))) == len(set(names.tolist())) == len(set(windows))


def test_equal_windows_have_one_minimiser():
    u = superkmer.units(6, 3)
    rng = np.random.default_rng(5)
    texts = [" ".join(map(str, rng.integers(0, 3, n))).encode() for n in (200, 5, 6, 150)]
    key, no, first, n = repeats.runs([u.split(t)[0] for t in texts], u, 64)
    seen, total = {}, 0
    for k, i, f, m in zip(key.tolist(), no.tolist(), first.tolist(), n.tolist(), strict=True):
        w = texts[i].split()
        total += m
        for p in range(f, f + m):
            assert seen.setdefault(tuple(w[p:p + 6]), k) == k
    assert total == sum(max(0, len(t.split()) - 5) for t in texts)


def test_a_copy_and_another_text_under_one_id(spark):
    """The second row of id 5 repeats another document though the first is a whole copy."""
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    docs = spark.createDataFrame([(1, a), (2, b), (5, a), (5, b + " tail")], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in superkmer.dedup(docs).collect())
    assert got == [(1, 60, 0), (2, 60, 0), (5, 60, 60), (5, 61, 60)]
    cut = sorted((r.doc_id, r.n_bytes - r.n_removed) for r in suffix_repeats.dedup(docs).collect())
    assert cut == [(1, len(a)), (2, len(b)), (5, 0), (5, 5)]


def test_buckets_follow_the_text_and_change_nothing(spark, docs_of, monkeypatch):
    docs = planted(11)
    table = repeats.with_hash(docs_of(docs))
    size = sum(len((t or "").encode()) for _, t in docs)
    assert repeats._buckets(table) == repeats.BUCKETS
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 250)
    n = repeats._buckets(table)
    assert n == -(-size // 250) > 2 * repeats.BUCKETS
    dealt = repeats._dealt(spark.range(4 * n).selectExpr(f"id % {n} AS bucket", "0 AS kind"), n)
    per_task = [r.n for r in dealt.selectExpr("spark_partition_id() AS p", "bucket").distinct().groupBy("p").agg({"bucket": "count"}).toDF("p", "n").collect()]
    assert sum(per_task) == n and max(per_task) <= repeats.TOGETHER
    got = superkmer.dedup(docs_of(docs)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == plain_words(docs)
    got = suffix_repeats.dedup(docs_of(docs)).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str) == plain_bytes(docs)
