"""Maximal periodic runs of words inside documents (operator 13), by scale-tiled distribution.

A run with period p is a stretch of words in which words p apart are equal: it
is an interval of *matches*, positions i with word i = word i + p, whose length
is the run's length less p.

1. **Tiles.**  Periods are taken an octave at a time, ``[lo, hi)``.  The document
   is exploded into overlapping tiles per octave, long enough that each piece of
   a match interval lies in a tile whole or meets its part in the next one.  A
   run of the octave has ``lo`` matches, so it holds a stretch of ``gram`` words
   at a multiple of ``step`` that comes again less than ``hi`` words later; tiles
   without one cannot hold a part of a run and are not sent.  (The grams are
   named exactly, see ``grams.py``; this drops no run.)
2. **Solve.**  Tiles are shuffled, each on its own, so a long document is many
   tasks' work.  At each boundary (a multiple of ``step``) one Z-function gives
   the forward match length for all periods of the octave, one on the reversed
   words the backward length; pieces that touch are one fragment.
3. **Stitch.**  Fragments are shuffled by (document, period) and those that
   touch or overlap are joined.  A stretch is found with its smallest period and
   with multiples of it, always at the same start and end: the smallest stays.

The documents themselves are not shuffled but for those with a live tile, which
meet their runs at the end.  The table between the steps is written once to the
shared scratch folder, so row numbers given in it hold when executors are lost.

Defined cases: a null or empty text has no words and no run; a null ``doc_id`` is
never changed by ``fold``; rows that share a ``doc_id`` are told apart and all
kept; an empty table gives none; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.llm.common import keep
from cohortlab.llm.grams import doubled, numbered, single, slices, words_of

#: Words of the shortest run, and repetitions of its period.
MIN_LENGTH, MIN_TIMES = 12, 2
#: Words between the starts of tiles, at least, and in steps of the octave.
STRIDE, STRIDE_STEPS = 1024, 16

_ROWS = "key long, doc_id long, n long, words string, collapsed string, lo long, start long, ids binary"
_FIELDS = ["key", "doc_id", "n", "words", "collapsed", "lo", "start", "ids"]
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]


def octave(lo: int) -> tuple[int, int, int]:
    """(hi, step, gram) of the octave that begins with period ``lo`` (1, 8, 16, 32 ...).

    A run has max(p, 12 - p) matches or more: 6 in the first octave, ``lo`` in the
    others, so ``gram`` matches begin at a multiple of ``step``.
    """
    return (8, 3, 4) if lo == 1 else (2 * lo, lo // 2, lo // 2)


def stride(step: int) -> int:
    return step * max(STRIDE_STEPS, -(-STRIDE // step))


def fold(doc_id: int | None, words: list[str]) -> list[str]:
    """The words, or for one in ten ids (by crc32) with a periodic tail, as the query's contract sets it."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a:a + p]
    return words[:a] + (tail * (-(-(n - a) // len(tail))))[:n - a]


def live_tiles(flat: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(text, lo, start, end) of the tiles that may hold a part of a run; start and end count from the text's first word."""
    names, length = single(flat, bounds), 1
    lo = 1
    while True:
        hi, step, gram = octave(lo)
        while length < gram:
            names, length = doubled(names, length), 2 * length
        at = np.flatnonzero(names >= 0)
        if not len(at):
            return
        order = at[np.argsort(names[at], kind="stable")]
        near = (names[order[1:]] == names[order[:-1]]) & (np.diff(order) < hi)
        found = order[:-1][near]
        text = np.searchsorted(bounds, found, side="right") - 1
        place = found - bounds[text]
        text, place = text[place % step == 0], place[place % step == 0]
        every, over = stride(step), hi + step + gram
        tile = place // every
        # the tile that begins last at or before the place, and the one before it where it reaches that far
        back = (tile > 0) & (place - tile * every < over)
        pairs = np.unique(np.stack([np.concatenate([text, text[back]]), np.concatenate([tile, tile[back] - 1])]), axis=1)
        for t, k in pairs.T.tolist():
            n = int(bounds[t + 1] - bounds[t])
            if n >= max(MIN_LENGTH, MIN_TIMES * lo):
                yield t, lo, k * every, min(k * every + every + over, n)
        lo = 8 if lo == 1 else 2 * lo


def z_function(s: list[int]) -> list[int]:
    """Length of the longest common prefix of ``s`` and each of its suffixes."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def solve(x: list[int], lo: int) -> dict[int, list[list[int]]]:
    """Period -> match intervals [start, end) inside a tile, those that may be a part of a run."""
    hi, step, gram = octave(lo)
    n, cap = len(x), step + gram
    raw = np.array(x, "<i4").tobytes()
    found: dict[int, list[list[int]]] = {}
    for b in range(0, n - gram - lo + 1, step):
        last = min(hi - 1, n - gram - b)  # the greatest period whose match fits
        if raw.find(raw[4 * b:4 * (b + gram)], 4 * (b + lo), 4 * (b + last + gram)) < 0:
            continue
        head = x[b:b + cap]
        z = z_function([*head, -1, *x[b + lo:b + last + cap]])[len(head) + 1:]
        periods = [p for p in range(lo, last + 1) if z[p - lo] >= gram]
        if not periods:
            continue
        tail = x[max(b - step, 0):b][::-1]
        back = z_function([*tail, -1, *x[max(b - step, 0):b + last][::-1]])[len(tail) + 1:]
        for p in periods:
            start, end = b - back[last - p], b + min(z[p - lo], cap)
            own = found.setdefault(p, [])
            if own and start <= own[-1][1]:
                own[-1][1] = max(own[-1][1], end)
            else:
                own.append([start, end])
    # an interval clear of both ends of the tile is whole: it stays if it is a run
    return {p: stay for p, own in found.items()
            if (stay := [r for r in own if r[0] == 0 or r[1] + p >= n or r[1] - r[0] >= max((MIN_TIMES - 1) * p, MIN_LENGTH - p)])}


def _prepared(change: Callable[[int | None, list[str]], list[str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column("text")):
                keys, ids = (batch.column(c).slice(at, len(texts)).to_pylist() for c in ("key", "doc_id"))
                words = [change(i, words_of(t)) for i, t in zip(ids, texts, strict=True)]
                flat, bounds = numbered(words)
                tiles = [(keys[t], None, None, None, None, lo, start, flat[bounds[t] + start:bounds[t] + end].astype("<i4").tobytes(), t)
                         for t, lo, start, end in live_tiles(flat, bounds)]
                live = {tile[-1] for tile in tiles}
                for k in range(0, len(tiles), 512):
                    columns = list(zip(*tiles[k:k + 512], strict=True))[:-1]
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, _KINDS, strict=True)], _FIELDS)
                joined = [" ".join(w) for w in words]
                out = [keys, ids, [len(w) for w in words], [j if t in live else None for t, j in enumerate(joined)],
                       [None if t in live else hashlib.sha256(j.encode("utf-8", "surrogatepass")).hexdigest() for t, j in enumerate(joined)],
                       *[[None] * len(keys)] * 3]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, _KINDS, strict=True)], _FIELDS)
    return run


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple[int, int, int, int]] = []
        for key, lo, start, ids in zip(*(batch.column(c).to_pylist() for c in ("key", "lo", "start", "ids")), strict=True):
            for p, own in solve(np.frombuffer(ids, "<i4").tolist(), lo).items():
                out += [(key, p, start + a, start + b) for a, b in own]
        columns = list(zip(*out, strict=True)) if out else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["key", "period", "first", "last"])


def stitched(fragments: DataFrame) -> DataFrame:
    """``key, start, length, period``: the maximal runs of (key, period, first, last) match intervals."""
    own = Window.partitionBy("key", "period").orderBy("first", "last")
    reach = F.max("last").over(own.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce((F.col("first") > reach).cast("int"), F.lit(1))
    whole = (fragments.withColumn("begins", begins).withColumn("part", F.sum("begins").over(own.rowsBetween(Window.unboundedPreceding, 0)))
             .groupBy("key", "period", "part").agg(F.min("first").alias("start"), F.max("last").alias("last")))
    matches = F.col("last") - F.col("start")
    runs = whole.where(matches >= F.greatest(F.col("period") * (MIN_TIMES - 1), MIN_LENGTH - F.col("period")))
    return (runs.select("key", "start", (matches + F.col("period")).alias("length"), "period")
            .groupBy("key", "start", "length").agg(F.min("period").alias("period")))


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest columns of documents with their words and sorted runs."""
    for batch in batches:
        out = []
        for doc_id, n, words, runs in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "words", "runs")), strict=True):
            runs = sorted((r["start"], r["period"], r["length"]) for r in runs or [])
            step = np.zeros(n + 1, np.int64)
            for start, period, length in runs:
                step[start + period] += 1
                step[start + length] -= 1
            kept = [w for w, gone in zip(words.split(" ") if n else [], np.cumsum(step)[:-1].tolist(), strict=True) if not gone]
            start, period, length = min(runs, key=lambda r: (-r[2], r[0], r[1])) if runs else (None, None, None)
            lines = "".join(f"{s},{k},{p}\n" for s, p, k in runs)
            out.append((doc_id, len(runs), start, length, period, 1000 * length // period if runs else None,
                        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(" ".join(kept).encode("utf-8", "surrogatepass")).hexdigest()))
        columns = list(zip(*out, strict=True)) if out else [()] * 8
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i < 6 else pa.string()) for i, c in enumerate(columns)], _OUT)


_OUT = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
_OUT_TYPES = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _table(docs: DataFrame, change) -> DataFrame:
    """Document rows (``lo`` null) and tile rows, written once."""
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return keep(rows.mapInArrow(_prepared(change), _ROWS), "periodic-tiles")


def _runs(table: DataFrame) -> DataFrame:
    tiles = table.where("lo is not null").select("key", "lo", "start", "ids").repartition("key", "lo", "start")
    return stitched(tiles.mapInArrow(_solved, "key long, period long, first long, last long"))


def runs(docs: DataFrame, change: Callable[[int | None, list[str]], list[str]] = lambda _, words: words) -> DataFrame:
    """``doc_id, start, length, period`` of every maximal run; ``change`` may rewrite a document's words first."""
    table = _table(docs, change)
    return (table.where("lo is null").select("key", "doc_id").join(_runs(table), "key")
            .select("doc_id", "start", "length", "period"))


def digest(docs: DataFrame, change: Callable[[int | None, list[str]], list[str]] = fold) -> DataFrame:
    """Per row its number of runs, the longest, and hashes of all runs and of the words left when each run keeps one period."""
    table = _table(docs, change)
    of_doc = _runs(table).groupBy("key").agg(F.collect_list(F.struct("start", "period", "length")).alias("runs"))
    rows = table.where("lo is null")
    live = (rows.where("words is not null").select("key", "doc_id", "n", "words").join(of_doc, "key", "left")
            .select("doc_id", "n", "words", "runs").mapInArrow(_finished, _OUT_TYPES))
    none = [F.lit(None).cast("long").alias(c) for c in ("start", "length", "period", "exponent_milli")]
    still = rows.where("words is null").select("doc_id", F.lit(0).cast("long").alias("n_runs"), *none,
                                               F.sha2(F.lit(""), 256).alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256"))
    return still.unionByName(live)
