"""Online variational topic model whose topic-term weights are a table.

The model is ``topic, idx, weight`` rows (weights of the Dirichlet over terms), at most
``k * vocabulary`` of them; nothing of it is on the driver.  A mini-batch is the documents whose
hash of (key, iteration) falls under the fraction, so it is the same for every partitioning.  Its entries
meet the table's expected term weights, each document is solved on its own in its task (fixed-point
iteration of its topic weights), and the statistics are one aggregate per (topic, term), with which the
table moves: ``weight = (1 - rho) weight + rho (eta + corpus / batch * statistics)``, rho = (tau + t) ** -kappa.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortlab.session import keep

#: Learning rate, and the change of a document's topic weights at which it is settled.
TAU, KAPPA, SETTLED, MOST_ROUNDS = 1024.0, 0.51, 1e-3, 1000
_GRAIN = 1 << 40


def digamma(x):
    """The logarithmic derivative of the gamma function, for columns and arrays alike: ten steps up, then its series."""
    log = F.log if isinstance(x, Column) else np.log
    y = x + 10
    r = 1 / (y * y)
    out = log(y) - 1 / (2 * y) - r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r * (1 / 240 - r / 132))))
    for i in range(10):
        out = out - 1 / (x + i)
    return out


def initial_weights(terms: DataFrame, k: int, seed: int) -> DataFrame:
    """``topic, idx, weight``: positive weights about 1 (a gamma of shape 100), drawn from the hash of (seed, topic, idx)."""
    rows = terms.select(F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("topic"), "idx")
    even = lambda salt: (F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), "topic", "idx"), F.lit(_GRAIN)) + 0.5) / _GRAIN
    normal = F.sqrt(-2 * F.log(even(1))) * F.cos(2 * np.pi * even(2))
    return rows.withColumn("weight", F.pow(1 - 1 / 900 + normal / 30, F.lit(3.0)))


def expected(weights: DataFrame, k: int) -> DataFrame:
    """``idx, beta``: exp of the expected log share of each term in topics 0 .. k - 1."""
    totals = weights.groupBy(F.col("topic").alias("_t")).agg(F.sum("weight").alias("_total"))  # k rows
    rows = weights.join(F.broadcast(totals), F.col("topic") == F.col("_t"))
    beta = F.exp(digamma(F.col("weight")) - digamma(F.col("_total")))
    gathered = rows.select("idx", "topic", beta.alias("b")).groupBy("idx").agg(F.array_sort(F.collect_list(F.struct("topic", "b"))).alias("own"))
    return gathered.select("idx", F.transform("own", lambda p: p["b"]).alias("beta"))


def document_topics(n: np.ndarray, beta: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Topic weights of a document with counts ``n`` of terms ``beta`` [term, topic], and its statistics [term, topic]."""
    alpha = 1.0 / k
    gamma = np.ones(k)
    theta = np.exp(digamma(gamma) - digamma(gamma.sum()))
    norm = beta @ theta + 1e-100
    for _ in range(MOST_ROUNDS):
        before = gamma
        gamma = alpha + theta * (beta.T @ (n / norm))
        theta = np.exp(digamma(gamma) - digamma(gamma.sum()))
        norm = beta @ theta + 1e-100
        if np.abs(gamma - before).mean() < SETTLED:
            break
    return gamma, np.outer(n / norm, theta) * beta


def _documents(entries: DataFrame, weights: DataFrame, k: int, key: str) -> DataFrame:
    """One row per document: its terms in order with counts and expected weights; at most vocabulary x k numbers."""
    # as many tasks as the session shuffles to, however small the entries are: the work is in solving the documents
    tasks = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = entries.repartition(tasks, key).join(F.broadcast(expected(weights, k)), "idx")  # the model: at most vocabulary rows
    return met.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("idx", F.col("n").cast("double").alias("n"), "beta"))).alias("own"))


def _arrays(own: pa.ListScalar, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = own.values
    return (rows.field("idx").to_numpy(), rows.field("n").to_numpy(), rows.field("beta").flatten().to_numpy().reshape(-1, k))


def distributions(entries: DataFrame, weights: DataFrame, k: int, key: str = "subject_id") -> DataFrame:
    """``<key>, share``: the topic shares (they sum to 1) of every document with an entry."""
    docs = _documents(entries, weights, k, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [document_topics(*_arrays(own, k)[1:], k)[0] for own in batch.column("own")]
            shares = pa.array([(g / g.sum()).tolist() for g in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(key), shares], [key, "share"])

    schema = StructType([docs.schema[key], *StructType.fromDDL("share array<double>").fields])
    return docs.mapInArrow(run, schema)


def statistics(entries: DataFrame, weights: DataFrame, k: int, key: str) -> DataFrame:
    """``topic, idx, found``: the statistics of the documents, added up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in batch.column("own"):
                idx, n, beta = _arrays(own, k)
                _, found = document_topics(n, beta, k)
                yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(k, dtype=np.int32), len(idx))),
                                                  pa.array(np.repeat(idx, k).astype(np.int32)), pa.array(found.ravel())], ["topic", "idx", "found"])

    parts = _documents(entries, weights, k, key).select("own").mapInArrow(run, "topic int, idx int, found double")
    return parts.groupBy("topic", "idx").agg(F.sum("found").alias("found"))


def mini_batch(entries: DataFrame, t: int, fraction: float, seed: int, key: str) -> DataFrame:
    """The entries of the documents of mini-batch ``t``."""
    return entries.where(F.pmod(F.xxhash64(F.lit(seed), F.lit(t), F.col(key)), F.lit(_GRAIN)) < int(fraction * _GRAIN))


def fit(entries: DataFrame, terms: DataFrame, k: int, corpus: int, max_iter: int, fraction: float, seed: int,
        key: str = "subject_id") -> DataFrame:
    """``topic, idx, weight`` after ``max_iter`` mini-batches of ``entries`` (key, idx, n); an empty batch changes nothing."""
    weights = keep(initial_weights(terms, k, seed), "topic-weights")
    for t in range(max_iter):
        batch = mini_batch(entries, t, fraction, seed, key)
        size = batch.select(key).distinct().count()
        if not size:
            continue
        rho = (TAU + t + 1) ** -KAPPA
        moved = weights.join(statistics(batch, weights, k, key), ["topic", "idx"], "left")
        weight = (1 - rho) * F.col("weight") + rho * (1.0 / k + corpus / size * F.coalesce("found", F.lit(0.0)))
        weights = keep(moved.select("topic", "idx", weight.alias("weight")), "topic-weights")
    return weights
