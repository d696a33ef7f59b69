"""The topic table against a NumPy version with dense matrices, and its independence of partitions."""

from __future__ import annotations

import random

import numpy as np
import pytest
from cohort_test_tables import SF_SMALL
from pyspark.sql import functions as F

from cohortlab.operators import notes, topic_table
from cohortlab.plans import topics
from cohortlab.sources.tables import Clinical

K, SEED = 5, 41


def psi(x):
    """digamma by a long recurrence and few terms."""
    x = np.asarray(x, np.longdouble)
    out = np.zeros_like(x)
    for _ in range(200):
        out -= 1 / x
        x = x + 1
    return (out + np.log(x) - 1 / (2 * x) - 1 / (12 * x ** 2) + 1 / (120 * x ** 4)).astype(float)


def solve(n, beta, k):
    gamma = np.ones(k)
    while True:
        theta = np.exp(psi(gamma) - psi(gamma.sum()))
        phi = beta * theta
        phi = phi / phi.sum(axis=1, keepdims=True)
        new = 1 / k + (phi * n[:, None]).sum(axis=0)
        done = np.abs(new - gamma).mean() < 1e-3
        gamma = new
        if done:
            theta = np.exp(psi(gamma) - psi(gamma.sum()))
            phi = beta * theta
            return gamma, phi / phi.sum(axis=1, keepdims=True) * n[:, None]


def corpus(n_docs=60, n_terms=40):
    rnd = random.Random(8)
    out = {}
    for d in range(n_docs):
        own = {rnd.randrange(n_terms // 2) + (d % 2) * (n_terms // 2): rnd.randrange(1, 9) for _ in range(rnd.randrange(0, 15))}
        out[d] = own
    return out


def frames(spark, docs, n_terms, parts):
    rows = [(d, t, n) for d, own in docs.items() for t, n in own.items()]
    return (spark.createDataFrame(rows, "subject_id long, idx int, n long").repartition(parts), spark.range(n_terms).select(F.col("id").cast("int").alias("idx")))


@pytest.mark.parametrize("fraction", [1.0, 0.3, 0.0])
def test_equals_numpy_and_does_not_depend_on_partitions(spark, fraction):
    docs, n_terms = corpus(), 40
    results = []
    for parts, shuffles in ((1, "3"), (7, "11")):
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
        entries, terms = frames(spark, docs, n_terms, parts)
        weights = topic_table.fit(entries, terms, K, len(docs), 3, fraction, SEED)
        share = {r["subject_id"]: r["share"] for r in topic_table.distributions(entries, weights, K).collect()}
        results.append(({(r["topic"], r["idx"]): r["weight"] for r in weights.collect()}, share))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    entries, terms = frames(spark, docs, n_terms, 2)
    lam = np.zeros((K, n_terms))
    for r in topic_table.initial_weights(terms, K, SEED).collect():
        lam[r["topic"], r["idx"]] = r["weight"]
    assert 0.5 < lam.min() and abs(lam.mean() - 1) < 0.05 and 0.05 < lam.std() < 0.2
    for t in range(3):
        batch = {r[0] for r in topic_table.mini_batch(entries, t, fraction, SEED, "subject_id").select("subject_id").distinct().collect()}
        if not batch:
            continue
        beta = np.exp(psi(lam) - psi(lam.sum(axis=1))[:, None])
        found = np.zeros_like(lam)
        for d in batch:
            idx, n = np.array(list(docs[d])), np.array(list(docs[d].values()), float)
            found[:, idx] += solve(n, beta[:, idx].T, K)[1].T
        rho = (1024 + t + 1) ** -0.51
        lam = (1 - rho) * lam + rho * (1 / K + len(docs) / len(batch) * found)
    beta = np.exp(psi(lam) - psi(lam.sum(axis=1))[:, None])
    for got, share in results:
        assert len(got) == lam.size and all(abs(got[i, j] - lam[i, j]) < 1e-7 for i in range(K) for j in range(n_terms))
        assert share.keys() == {d for d, own in docs.items() if own}
        for d, own in share.items():
            gamma = solve(np.array(list(docs[d].values()), float), beta[:, list(docs[d])].T, K)[0]
            assert np.allclose(own, gamma / gamma.sum(), atol=1e-7)


def test_digamma():
    x = np.array([1e-3, 0.05, 0.5, 1.0, 3.7, 100.0])
    assert np.allclose(topic_table.digamma(x), psi(x), rtol=1e-9, atol=1e-9)
    assert abs(topic_table.digamma(np.array([1.0]))[0] + 0.5772156649015329) < 1e-11


def test_two_themes_are_told_apart(spark):
    docs, n_terms = corpus(400), 40
    entries, terms = frames(spark, docs, n_terms, 3)
    weights = topic_table.fit(entries, terms, 2, len(docs), 60, 1.0, SEED)
    share = {r["subject_id"]: int(np.argmax(r["share"])) for r in topic_table.distributions(entries, weights, 2).collect()}
    agree = np.mean([share[d] == d % 2 for d in share])
    assert max(agree, 1 - agree) > 0.95


def test_topic_terms_rank_the_weights(spark):
    c = Clinical(spark, SF_SMALL)
    bag = notes.patient_terms(c.patient_anchor, c.noteevents)
    keys = bag.select("subject_id").distinct().unionByName(spark.sql("SELECT -5L AS subject_id"))
    model = topics.fit_topics_from_bag(bag, keys, k=4, vocab_size=300)
    by: dict = {}
    for r in model.weights.collect():
        by.setdefault(r["topic"], []).append((r["weight"], r["idx"]))
    term = {r["idx"]: r["term"] for r in model.vocab.collect()}
    want = set()
    for t, own in by.items():
        total = sum(w for w, _ in own)
        want |= {(t, i + 1, term[j], round(w / total, 12)) for i, (w, j) in enumerate(sorted(own, key=lambda x: (-x[0], x[1]))[:10])}
    assert {(r["topic"], r["rank"], r["term"], round(r["weight"], 12)) for r in model.topic_terms(10).collect()} == want
    rows = {r["subject_id"]: r[1:] for r in model.topic_columns().collect()}
    assert sum(rows[-5]) == 0 and all(abs(sum(v) - 1) < 1e-9 for s, v in rows.items() if s != -5) and len(rows) == keys.count()
