"""N-gram Jaccard join with Bayesian candidate pruning (operator 10).

Documents are sets of five-word shingles; documents with equal sets are one
representative with a weight.

1. Min-hash values in bands bring together representatives that agree on all
   values of some band (``BANDS`` of ``ROWS``: a pair at 0.8 is missed with a
   probability under 1e-5).
2. Within a band's group the min-hash values (one byte of each) are compared
   ``STEP`` at a time.  After each step a pair is dropped when the posterior
   probability, from a uniform prior, that its similarity reaches the
   threshold is below ``TOLERANCE``.  What is left of a group is handed on as
   spanning edges, not as pairs; pairs already joined by them are not compared.
3. Connected survivors form clusters, and inside a cluster every pair, the
   survivors among them, is verified exactly on its shingles.
4. Verified links give each document its number of links and its class.

Groups and clusters of more than ``BLOCK`` members are dealt into blocks, and
each pair of blocks is a row group of its own, so no task ever holds more than
two blocks.

Defined cases: words are runs of characters other than space and 09 to 0D,
unchanged; a text of one to four words is one shingle; null and empty texts
and rows without a ``doc_id`` have no links and are their own class; repeated
rows link with each other, and rows that share a ``doc_id`` share a class;
further columns are ignored by ``join`` and kept by ``apply_join``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.blocks import blocked, merge, sorted_groups
from cohortlab.llm.common import keep
from cohortlab.llm.components import components
from cohortlab.llm.repeats import _gram_hash, split_words

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS, STEP, TOLERANCE = 40, 6, 40, 1e-7
BLOCK = 512
_RNG = np.random.default_rng(99)
_A = (_RNG.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; of all words, if there are fewer."""
    h, _, _ = split_words(text)
    if not len(h):
        return h
    return np.unique(_gram_hash(h, min(words, len(h))))


def min_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """[set, hash function] of non-empty sets, 32 bits."""
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    x = np.concatenate(sets)
    x = (x ^ (x >> np.uint64(32))).astype(np.uint32)
    out = np.empty((len(sets), len(_A)), np.uint32)
    for k, (a, b) in enumerate(zip(_A, _B, strict=True)):
        out[:, k] = np.minimum.reduceat(x * a + b, starts)
    return out


@lru_cache(maxsize=8)
def least_matches(compared: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """Fewest matches among ``compared`` values that keep a pair.

    With m matches the posterior of the similarity is Beta(m + 1, n - m + 1), whose tail
    over t is P(Binomial(n + 1, t) <= m).
    """
    tail = 0.0
    for m in range(compared + 1):
        tail += math.comb(compared + 1, m) * threshold ** m * (1 - threshold) ** (compared + 1 - m)
        if tail >= tolerance:
            return m
    return compared


def survivors(sig: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Positions of the pairs (i, j) that no step of the comparison drops."""
    alive, matches = np.arange(len(i)), np.zeros(len(i), np.int32)
    for at in range(0, sig.shape[1], STEP):
        a, b = sig[i[alive], at:at + STEP], sig[j[alive], at:at + STEP]
        matches = matches + (a == b).sum(axis=1, dtype=np.int32)
        stay = matches >= least_matches(min(at + STEP, sig.shape[1]))
        alive, matches = alive[stay], matches[stay]
    return alive


def _pairs(left: np.ndarray, right: np.ndarray, same: bool, label: np.ndarray, most: int = 200_000):
    """Index pairs of two blocks (of one, if ``same``) whose labels differ, some at a time."""
    rows = max(1, most // max(1, len(right)))
    for a in range(0, len(left), rows):
        i, j = np.repeat(left[a:a + rows], len(right)), np.tile(right, len(left[a:a + rows]))
        use = label[i] != label[j]
        if same:
            use &= i < j
        if use.any():
            yield i[use], j[use]


def spanning(sig: np.ndarray, ids: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Edges (id, id) that join exactly what the surviving pairs of a group join."""
    label = np.arange(len(ids))
    one = left[:1] if len(left) else left
    first = right if not same else left[1:]
    if len(one) and len(first):  # most of a dense group joins its first member
        i = np.repeat(one, len(first))
        hit = survivors(sig, i, first)
        merge(label, i[hit], first[hit])
    for i, j in _pairs(left, right, same, label):
        hit = survivors(sig, i, j)
        merge(label, i[hit], j[hit])
    moved = np.flatnonzero(label != np.arange(len(label)))
    return ids[moved], ids[label[moved]]


def _signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, sig, bands): set digest, low bytes of the min-hash values, and a 64-bit key per band."""
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("sig", pa.binary()), ("bands", pa.list_(pa.int64()))])
    mix = np.random.default_rng(7).integers(1, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [(d, shingles(t.encode())) for d, t in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True)]
                rows = [(d, s) for d, s in rows if len(s)]
                if not rows:
                    continue
                mh = min_hashes([s for _, s in rows])
                band = (mh.reshape(len(rows), BANDS, ROWS).astype(np.uint64) * mix).sum(axis=2, dtype=np.uint64)
                band = ((band ^ (band >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)).view(np.int64)
                low = mh.astype(np.uint8)  # the top byte of a minimum over many shingles is 0 for any text
                yield pa.RecordBatch.from_arrays([
                    pa.array([d for d, _ in rows], pa.int64()), pa.array([hashlib.md5(s.tobytes()).digest() for _, s in rows], pa.binary()),
                    pa.array([r.tobytes() for r in low], pa.binary()),
                    pa.ListArray.from_arrays(np.arange(0, band.size + 1, BANDS, dtype=np.int32), pa.array(band.ravel()))], schema=schema)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .where("doc_id is not null and text is not null").mapInArrow(run, "doc_id long, digest binary, sig binary, bands array<long>"))


def _candidate_edges(reps: DataFrame) -> DataFrame:
    """Spanning edges (u, v) of the pairs that share a band and survive the pruning."""
    members = reps.select(F.explode("bands").alias("band"), "rep")
    sizes = members.groupBy("band").agg(F.count(F.lit(1)).alias("size"))
    rows = blocked(members, ["band"], F.col("rep"), sizes, BLOCK).join(reps.select("rep", "sig"), "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u, v = [], []
        held_ids, held_sigs, held_i, held_j = [], [], [], []  # small groups are compared together

        def compare():
            ids, sig = np.array(held_ids, np.int64), np.frombuffer(b"".join(held_sigs), np.uint8).reshape(len(held_ids), -1)
            i, j = np.concatenate(held_i), np.concatenate(held_j)
            for a in range(0, len(i), 100_000):
                hit = survivors(sig, i[a:a + 100_000], j[a:a + 100_000]) + a
                u.append(ids[i[hit]])
                v.append(ids[j[hit]])

        for (_, bi, bj), (ids, sigs, sides) in sorted_groups(batches, ["band", "bi", "bj"], ["rep", "sig", "side"]):
            n = len(ids)
            if n < 2:
                continue
            if n <= 16 and bi == bj:
                i, j = _triangle(n)
                held_i.append(i + len(held_ids))
                held_j.append(j + len(held_ids))
                held_ids += ids
                held_sigs += sigs
                if len(held_ids) > 20_000:
                    compare()
                    held_ids, held_sigs, held_i, held_j = [], [], [], []
            else:
                side, where = np.array(sides), np.arange(n)
                left = where[side == 0]
                a, b = spanning(np.frombuffer(b"".join(sigs), np.uint8).reshape(n, -1), np.array(ids, np.int64), left,
                                left if bi == bj else where[side == 1], bi == bj)
                u.append(a)
                v.append(b)
            if sum(map(len, u[-8:])) > 100_000 or len(u) > 2000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], names=["u", "v"])
                u, v = [], []
        if held_ids:
            compare()
        if u:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], names=["u", "v"])

    return (rows.repartition("band", "bi", "bj").sortWithinPartitions("band", "bi", "bj", "side", "rep")
            .select("band", "bi", "bj", "rep", "sig", "side").mapInArrow(run, "u long, v long").distinct())


@lru_cache(maxsize=32)
def _triangle(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n, 1)


def exact_links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, same: bool, threshold: float = THRESHOLD):
    """Pairs (i, j) of two blocks whose Jaccard similarity is at least ``threshold``, from the shared shingles."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    name, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    shared = count[name] > 1  # shingles of one set alone are in no intersection
    owner, name = owner[shared], np.unique(name[shared], return_inverse=True)[1]
    inside = np.zeros((len(sets), len(sets)), np.int64)
    order = np.argsort(name, kind="stable")
    owner, name = owner[order], name[order]
    width = 8192  # shingles at a time
    n_names = int(name[-1]) + 1 if len(name) else 0
    cuts = np.searchsorted(name, np.arange(0, n_names + width, width))
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        m = np.zeros((len(sets), width), np.float32)
        m[owner[a:b], name[a:b] - k * width] = 1
        used = np.unique(owner[a:b])
        inside[np.ix_(used, used)] += np.rint(m[used] @ m[used].T).astype(np.int64)
    i, j = (x.ravel() for x in np.meshgrid(left, right, indexing="ij"))
    if same:
        i, j = i[i < j], j[i < j]
    both = inside[i, j]
    hit = both >= threshold * (sizes[i] + sizes[j] - both) - 1e-9
    return i[hit], j[hit]


def _verified(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(kind, u, v, n): kind 0 spanning edges of verified links, kind 1 partial link counts n of representative u.

    ``members``: cluster, rep, digest, doc_id (whose text has the set), weight.
    """
    sets_schema = pa.schema([("cluster", pa.int64()), ("rep", pa.int64()), ("digest", pa.binary()), ("weight", pa.int64()), ("sets", pa.binary())])

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                cols = {c: part.column(c).to_pylist() for c in ("cluster", "rep", "digest", "weight", "text")}
                out = []
                for k, text in enumerate(cols["text"]):
                    s = shingles(text.encode())
                    if hashlib.md5(s.tobytes()).digest() == cols["digest"][k]:  # not another row with the same id
                        out.append((k, s))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([cols[c][k] for k, _ in out], f.type) for c, f in zip(("cluster", "rep", "digest", "weight"), sets_schema, strict=False)]
                        + [pa.array([s.tobytes() for _, s in out], pa.binary())], schema=sets_schema)

    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string").alias("text")).where("text is not null")
    # sorted and merged at every size: the members are a share of the documents
    rows = (texts.join(members.hint("merge"), "rep").mapInArrow(sets_of, "cluster long, rep long, digest binary, weight long, sets binary")
            .dropDuplicates(["cluster", "rep", "digest"]))
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, us, vs, ns = [], [], [], []
        for (_, bi, bj), (reps, weights, sets, sides) in sorted_groups(batches, ["cluster", "bi", "bj"], ["rep", "weight", "sets", "side"]):
            n = len(reps)
            if n < 2:
                continue
            side, where, ids, weight = np.array(sides), np.arange(n), np.array(reps, np.int64), np.array(weights, np.int64)
            left = where[side == 0]
            right = left if bi == bj else where[side == 1]
            i, j = exact_links([np.frombuffer(s, np.uint64) for s in sets], left, right, bi == bj)
            if not len(i):
                continue
            links = np.zeros(n, np.int64)
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
            label = where.copy()
            merge(label, i, j)
            moved = np.flatnonzero(label != where)
            some = np.flatnonzero(links)
            kinds += [0] * len(moved) + [1] * len(some)
            us += ids[moved].tolist() + ids[some].tolist()
            vs += ids[label[moved]].tolist() + [sets_key(sets[k]) for k in some.tolist()]
            ns += [0] * len(moved) + links[some].tolist()
            if len(kinds) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(us, pa.int64()), pa.array(vs, pa.int64()), pa.array(ns, pa.int64())], names=["kind", "u", "v", "n"])
                kinds, us, vs, ns = [], [], [], []
        if kinds:
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(us, pa.int64()), pa.array(vs, pa.int64()), pa.array(ns, pa.int64())], names=["kind", "u", "v", "n"])

    dealt = blocked(rows, ["cluster"], F.col("digest"), sizes, BLOCK)
    return (dealt.repartition("cluster", "bi", "bj").sortWithinPartitions("cluster", "bi", "bj", "side", "rep", "digest")
            .select("cluster", "bi", "bj", "rep", "weight", "sets", "side").mapInArrow(run, "kind int, u long, v long, n long"))


def sets_key(data: bytes) -> int:
    """First eight bytes of the set's digest, as a signed number."""
    return int.from_bytes(hashlib.md5(data).digest()[:8], "big", signed=True)


def join(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (least doc_id linked directly or through others), n_links (other rows at 0.8 or more) per row of ``docs``."""
    signed = keep(_signatures(docs), "signatures")
    reps = keep(signed.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("weight"),
                                             F.first("sig").alias("sig"), F.first("bands").alias("bands")), "representatives")
    clusters = components(_candidate_edges(reps))
    members = keep(reps.join(clusters.select(F.col("node").alias("rep"), F.col("component").alias("cluster")), "rep")
                   .select("cluster", "rep", "digest", "weight"), "members")
    found = keep(_verified(docs, members), "links")
    classes = components(found.where("kind = 0").select("u", "v"))
    counts = found.where("kind = 1").groupBy(F.col("u").alias("rep"), F.col("v").alias("key")).agg(F.sum("n").alias("others"))
    key = F.conv(F.substring(F.hex("digest"), 1, 16), 16, -10).cast("long")
    per_set = (reps.select("digest", "rep", "weight", key.alias("key")).join(counts, ["rep", "key"], "left")
               .join(classes.select(F.col("node").alias("rep"), F.col("component").alias("class_id")), "rep", "left")
               .select("digest", F.coalesce("class_id", "rep").alias("class_id"),
                       (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")))
    linked = signed.select("doc_id", "digest").join(per_set, "digest").select("doc_id", "class_id", "n_links")
    rest = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .where(F.col("doc_id").isNull() | F.col("text").isNull() | ~F.col("text").rlike(r"[^\x20\x09-\x0D]"))
            .select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links")))
    return linked.unionByName(rest)


def apply_join(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class: the rows of the least ``doc_id``, equal ones once; rows without an id stay."""
    classes = join(docs).where("doc_id is not null").groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    gone = classes.where("class_id < doc_id").select("doc_id")
    known = docs.where("doc_id is not null").join(gone.hint("merge"), "doc_id", "left_anti")
    return known.dropDuplicates(["doc_id", "text"]).select(*docs.columns).unionByName(docs.where("doc_id is null"))
