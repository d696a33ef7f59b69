"""Toxicity of whole texts, scored after noisy-channel deobfuscation (operator 8).

1. A character trigram model is counted over all documents (``count_trigrams``).
2. Each word is a lattice of readings: a digit or symbol may stand for a letter
   (leetspeak) or be a boundary, a run of one letter may be one or two of it,
   and separators between single letters may be dropped.  Viterbi decoding under
   the trigram model picks the reading (``Restorer``).  Most words have only one
   reading, which is kept without a search.
3. Labels are learned as a decision list over the restored words and their
   beginnings: the feature that explains most toxic rows not yet explained,
   at a high share of toxic rows, comes next (``learn``).
4. The score of a text is the share of toxic rows of its strongest feature, or
   the list's floor if it has none.

Learning uses a bounded sample of labelled rows outside the held-out third:
the ``SAMPLE_DOCS`` ids with the smallest hash.  The trigram counts and the
scores cover every whole text.

Defined cases: a null or empty text has the floor as its score, and so has
every text if nothing is labelled toxic; several labels of one id count as
toxic if one is; null labels are left out; repeated rows get equal rows;
further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import held_out, keep

SAMPLE_DOCS = 40_000
THRESHOLD = 0.7
#: A feature needs this many toxic rows not explained before it, and this share of toxic rows.
MIN_TOXIC, MIN_SHARE = 3, 0.6
#: Beginnings of words that are features, besides the words.
PREFIXES = (4, 5, 6, 7)
CACHE = 400_000

#: Readings of digits and symbols as letters.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
#: Separators that may be dropped between single letters.
SEPARATORS = " .-_*~'/\\"
#: Punctuation at the edges of a word, never a letter there.
EDGE = ".,;:!?\"'()[]{}<>«»“”‘’…-_*~#%&=/\\^`"
#: Costs of the channel in nats: a letter for a symbol, a boundary for a symbol, fewer letters, no separator.
SUBSTITUTE, BOUNDARY, COLLAPSE, DROP = 1.0, 2.0, 0.5, 0.7

_GAP, _OTHER, _SYMBOLS = 0, 1, 64
_LETTERS = re.compile(r"[^\W\d_]+")
_TRIPLE = re.compile(r"(.)\1\1")
_SINGLES = re.compile(r"(?<![^\W_])\w(?:[ .\-_*~'/\\]\w){2,}(?![^\W_])")
_SPACED = re.compile(r"\s\S\s\S\s")
_SPACED_RUN = re.compile(r"(?<!\S)\S(?:\s\S){2,}(?!\S)")
_NEAR_LEET = re.compile(r"[^\W\d_][0-9@$!|+(€£]|[0-9@$!|+(€£][^\W\d_]")


@lru_cache(maxsize=1)
def _codes() -> np.ndarray:
    """Symbol of each code point: letters a-z and of Latin-1, one for all other letters, one for the rest."""
    code = np.array([_OTHER if chr(c).isalpha() else _GAP for c in range(0x110000)], np.int32)
    plain = [*range(ord("a"), ord("z") + 1), *(c for c in range(0xDF, 0x100) if chr(c).isalpha())]
    code[plain] = np.arange(2, 2 + len(plain))
    return code


def trigram_counts(texts: list[str]) -> np.ndarray:
    """Counts of symbol triples in all texts; a run of non-letters is one gap, and texts begin and end with one."""
    raw = np.frombuffer((" " + "\n".join(texts).lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    code = _codes()[raw]
    stays = np.append(True, (code[1:] != _GAP) | (code[:-1] != _GAP))
    c = code[stays]
    if len(c) < 3:
        return np.zeros(_SYMBOLS ** 3, np.int64)
    return np.bincount((c[:-2] * _SYMBOLS + c[1:-1]) * _SYMBOLS + c[2:], minlength=_SYMBOLS ** 3)


def count_trigrams(docs: DataFrame) -> tuple:
    """((triple, count), ...) over all whole texts; at most 64 ** 3 rows come to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SYMBOLS ** 3, np.int64)
        for batch in batches:
            texts = [t for t in batch.column("text").to_pylist() if t]
            for at in range(0, len(texts), 512):
                total += trigram_counts(texts[at:at + 512])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["triple", "n"])

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "triple long, n long").groupBy("triple").agg(F.sum("n").alias("n"))
    return tuple(sorted((r.triple, r.n) for r in rows.collect()))


class Restorer:
    """Viterbi decoding of obfuscated words under the trigram model."""

    def __init__(self, trigrams: tuple):
        counts = np.zeros(_SYMBOLS ** 3)
        for triple, n in trigrams:
            counts[triple] = n
        three = counts.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS)
        two, one = three.sum(axis=0), three.sum(axis=(0, 1))
        p1 = (one + 1) / (one.sum() + _SYMBOLS)
        p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
        p3 = (three + 5 * p2[None]) / (three.sum(axis=2, keepdims=True) + 5)
        self.cost = (-np.log(p3)).tolist()
        self.code = _codes()

    def _arcs(self, s: str, i: int) -> list[tuple[str, int, float]]:
        """(letters or a blank, next position, channel cost) of the readings at position ``i``."""
        c = s[i]
        if c.isalpha():
            j = i + 1
            while j < len(s) and s[j] == c:
                j += 1
            if j - i >= 3:
                return [(c, j, COLLAPSE), (c * 2, j, COLLAPSE), (c * (j - i), j, COLLAPSE * (j - i))]
            return [(c, i + 1, 0.0)]
        if c in SEPARATORS:
            out = [(" ", i + 1, 0.0)]
            if 0 < i < len(s) - 1:
                alone = lambda k, side: s[k] not in SEPARATORS and (not 0 <= k + side < len(s) or s[k + side] in SEPARATORS)
                if alone(i - 1, -1) and alone(i + 1, 1):
                    out.append(("", i + 1, DROP))
            return out
        return [(" ", i + 1, BOUNDARY if c in LEET else 0.0), *((x, i + 1, SUBSTITUTE) for x in LEET.get(c, ""))]

    def decode(self, s: str) -> str:
        """The best reading of ``s`` (lower case)."""
        # position -> (last two symbols) -> (cost, text link); a position is dropped once its arcs are taken, so only
        # living readings stay in memory, however long the text
        best: dict[int, dict] = {0: {(_GAP, _GAP): (0.0, None)}}
        for i in range(len(s)):
            here = best.pop(i, {})
            arcs = self._arcs(s, i) if here else []
            for (a, b), (cost, back) in here.items():
                for out, j, extra in arcs:
                    x, y, total, link = a, b, cost + extra, back
                    for ch in out:
                        z = int(self.code[ord(ch)])
                        if z == _GAP and y == _GAP:
                            continue
                        total += self.cost[x][y][z]
                        x, y, link = y, z, (ch, link)
                    there = best.setdefault(j, {})
                    old = there.get((x, y))
                    if old is None or total < old[0]:
                        there[x, y] = (total, link)
        ends = [(c + self.cost[a][b][_GAP] * (b != _GAP), n, link) for n, ((a, b), (c, link)) in enumerate(best[len(s)].items())]
        out, link = [], min(ends, key=lambda e: e[:2])[2]
        while link:
            out.append(link[0])
            link = link[1]
        return "".join(reversed(out))

    def words(self, token: str) -> list[str]:
        """Restored words of one blank-separated token."""
        t = token.lower().strip(EDGE)
        if not t:
            return []
        if _TRIPLE.search(t) is None:
            if t.isalpha():
                return [t]
            if _NEAR_LEET.search(t) is None and _SINGLES.search(t) is None:
                return _LETTERS.findall(t)
        return _LETTERS.findall(self.decode(t)) if _LETTERS.search(t) else []

    def spaced(self, text: str) -> list[str]:
        """Restored words of the runs of single characters in a text."""
        if _SPACED.search(f" {text} ") is None:
            return []
        return [w for run in _SPACED_RUN.findall(text) for w in _LETTERS.findall(self.decode(re.sub(r"\s", " ", run.lower())))]


def features(word: str) -> list[str]:
    """The word, and its beginnings marked with a star."""
    return [word, *(word[:k] + "*" for k in PREFIXES if len(word) > k)]


@lru_cache(maxsize=2)
def _restorer(trigrams: tuple) -> Restorer:
    return Restorer(trigrams)


class _Known(dict):
    """token -> features of its restored words among ``wanted`` (all, if None); bounded."""

    def __init__(self, restorer: Restorer, wanted):
        self.restorer, self.wanted = restorer, wanted

    def __missing__(self, token: str) -> tuple:
        if len(self) >= CACHE:
            self.clear()
        out = self[token] = self.of(self.restorer.words(token))
        return out

    def of(self, words: list[str]) -> tuple:
        return tuple({f for w in words for f in features(w) if self.wanted is None or f in self.wanted})

    def text(self, text: str | None) -> set:
        if not text:
            return set()
        out: set = set().union(*[self[t] for t in set(text.split())])
        return out.union(self.of(self.restorer.spaced(text)))


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of the bounded sample: only ids and labels are compared, then the texts of the chosen ids are read."""
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
              .where("doc_id is not null and toxic is not null").where(~held_out())
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS))
    # at most SAMPLE_DOCS narrow rows
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
            .join(F.broadcast(chosen), "doc_id").select("text", (F.col("toxic") > 0).alias("toxic")))


def learn(docs: DataFrame, labels: DataFrame, trigrams: tuple) -> tuple:
    """((feature, share), ...) in the order learned, and the floor."""
    rows = keep(labelled_sample(docs, labels), "labelled")

    def of_toxic(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(_restorer(trigrams), None)
        for batch in batches:
            found = [sorted(known.text(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string()))], names=["features"])

    toxic = keep(rows.where("toxic").mapInArrow(of_toxic, "features array<string>").withColumn("row", F.monotonically_increasing_id()), "toxic-rows")
    pairs = toxic.select("row", F.explode("features").alias("feature"))
    often = {r.feature: r.n for r in pairs.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_TOXIC).collect()}
    candidates = frozenset(often)  # of at most SAMPLE_DOCS rows

    def of_clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count, n = _Known(_restorer(trigrams), candidates), Counter(), 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                count.update(known.text(text))
                n += 1
        names = [*count, None]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([*count.values(), n], pa.int64())], names=["feature", "n"])

    clean = rows.where("not toxic").mapInArrow(of_clean, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    in_clean = {r.feature: r.n for r in clean}
    n_clean = in_clean.pop(None, 0)
    # only features that can enter the list need to be known row by row
    sure = [f for f, n in often.items() if n / (n + in_clean.get(f, 0)) >= MIN_SHARE]
    by_feature: dict[str, set] = {}
    for r in pairs.where(F.col("feature").isin(sure)).collect() if sure else []:
        by_feature.setdefault(r.feature, set()).add(r.row)
    n_toxic = toxic.count()
    return decision_list(by_feature, in_clean, n_toxic, n_clean)


def decision_list(by_feature: dict[str, set], in_clean: dict[str, int], n_toxic: int, n_clean: int) -> tuple:
    """Greedy list: always the feature that adds most toxic rows, less the clean ones that it would take along."""
    live = {f: set(rows) for f, rows in by_feature.items() if len(rows) / (len(rows) + in_clean.get(f, 0)) >= MIN_SHARE}
    owners: dict[int, list[str]] = {}
    for f, rows in live.items():
        for r in rows:
            owners.setdefault(r, []).append(f)
    out, explained = [], 0
    while live:
        gain = lambda f: (len(live[f]) - in_clean.get(f, 0) / (1 - MIN_SHARE), -len(f), f)
        f = max(live, key=gain)
        rows = live.pop(f)
        bad = in_clean.get(f, 0)
        if len(rows) < MIN_TOXIC or len(rows) / (len(rows) + bad) < MIN_SHARE:
            continue  # its rows only get fewer; a larger one of less gain may still be good
        share = (len(rows) + 0.5) / (len(rows) + bad + 1)
        out.append((f, share))
        explained += len(rows)
        for r in rows:
            for g in owners[r]:
                if g in live:
                    live[g].discard(r)
        live = {g: s for g, s in live.items() if len(s) >= MIN_TOXIC}
    floor = (n_toxic - explained + 0.5) / (n_toxic - explained + n_clean + 1)
    return tuple(out), min(floor, MIN_SHARE / 2)


def score(docs: DataFrame, trigrams: tuple, learned: tuple) -> DataFrame:
    """``docs`` (doc_id, text, ...) -> doc_id, held_out, score, predicted.  No shuffle."""
    shares, floor = dict(learned[0]), learned[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(_restorer(trigrams), frozenset(shares))
        for batch in batches:
            scores = [max((shares[f] for f in known.text(t)), default=floor) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return (rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    trigrams = count_trigrams(docs)
    return score(docs, trigrams, learn(docs, labels, trigrams))
