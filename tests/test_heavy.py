"""Certified heavy hitters against plain counts, at summaries so small that they must widen."""

from __future__ import annotations

import collections
import random

import pyarrow as pa
import pytest

from cohortlab.operators import heavy, notes


def _bag(kind, seed=4):
    rnd = random.Random(seed)
    rows = []
    for key in range(300):
        if kind == "zipf":
            words = collections.Counter(f"w{int(rnd.paretovariate(0.7))}" for _ in range(80))
        elif kind == "ties":
            words = collections.Counter(f"w{rnd.randrange(500)}" for _ in range(40))
        else:  # a few heavy terms among terms that occur once
            words = collections.Counter([f"hot{rnd.randrange(12)}" for _ in range(60)] + [f"once{key}-{i}" for i in range(60)])
        rows += [(key, t, n) for t, n in words.items()]
    return rows


@pytest.mark.parametrize("kind", ["zipf", "ties", "heavy"])
@pytest.mark.parametrize("counters, min_df", [(20, 1), (20, 5), (400, 1), (10 ** 6, 3)])
def test_top_terms_equal_plain_counts(spark, kind, counters, min_df):
    rows = _bag(kind)
    bag = spark.createDataFrame(rows, "subject_id long, term string, n long").repartition(5)
    total, docs = collections.Counter(), collections.Counter()
    for _, t, n in rows:
        total[t] += n
        docs[t] += 1
    want = sorted(((-n, t, docs[t]) for t, n in total.items() if docs[t] >= min_df))
    for size in (10, 10 ** 5):
        found = heavy.top_terms(bag, size, min_df, counters)
        got = sorted((-r["term_count"], r["term"], r["doc_freq"]) for r in found.collect())
        assert got[:size] == want[:size]


def test_light_terms_are_not_shuffled(spark):
    bag = spark.createDataFrame(_bag("heavy"), "subject_id long, term string, n long").repartition(5)
    found = heavy.top_terms(bag, 10, counters=200)
    assert 10 <= found.count() <= 100  # of 18,012 distinct terms


def test_summary_bounds():
    table = pa.table({"term": list("abcdef"), "low": [9, 1, 5, 5, 2, 1], "rows": [1] * 6})
    out, cut = heavy.summary(table, 2)
    assert cut == 5 and dict(zip(out["term"].to_pylist(), out["low"].to_pylist(), strict=True)) == {"a": 4}
    assert heavy.summary(table, 6) == (table, 0)


def test_vocabulary_of_an_empty_bag(spark):
    bag = spark.createDataFrame([], "subject_id long, term string, n long")
    assert notes.vocabulary(bag, 5).collect() == []
