"""Substring dedup by super-k-mer partitioning (operator 4).

Windows of 50 consecutive words; consecutive windows that share a minimiser
travel to its bucket as one packed string, and in the bucket sorting brings
equal windows together (``window_names``): words become numbers, numbers of
1, 2, 4, ... words are named by sorting pairs of names, so equal names mean
equal words and the groups are exact.  A word goes if a window over it also
starts in a document with a smaller id; windows are judged on the input.

The plan around it (who repeats which minimiser, merging of equal strings, the
way back) is in ``repeats``.

Defined cases: a null or empty text has no words; a null ``doc_id`` neither
loses words nor makes others lose them; rows that share a ``doc_id`` are one
document for the comparison and are cut each by its own text; further columns
are ignored by ``dedup`` and kept by ``apply_dedup``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlab.llm.repeats import Units, earlier_spans, join_words, own_spans, split_words, with_hash

WIDTH, GRAM = 50, 8


def window_names(words: np.ndarray, width: int) -> np.ndarray:
    """A number for the ``width`` numbers from each position: equal if and only if they are."""
    name, size, have = words.astype(np.int64), 1, {1: words.astype(np.int64)}
    while size * 2 <= width:
        pair = name[:-size] * (int(name.max()) + 1) + name[size:]
        name = np.unique(pair, return_inverse=True)[1]
        size *= 2
        have[size] = name
    if size < width:
        rest = width - size
        pair = name[:len(words) - width + 1] * (int(name.max()) + 1) + name[rest:rest + len(words) - width + 1]
        name = np.unique(pair, return_inverse=True)[1]
    return name


def least_documents(strings: list[bytes], low: np.ndarray, high: np.ndarray, u: Units):
    """For runs of windows of each string: the least document with that window, where it is under ``high``."""
    number: dict[bytes, int] = {}
    split = [s.split(b" ") for s in strings]
    words = np.array([number.setdefault(w, len(number)) for s in split for w in s], np.int64)
    counts = np.array([len(s) for s in split])
    windows = counts - u.width + 1
    owner = np.repeat(np.arange(len(strings)), windows)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    name = window_names(words, u.width)[(np.cumsum(counts) - counts)[owner] + place]
    order = np.argsort(name, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(name[order]) != 0))
    least = np.empty(len(name), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(low[owner[order]], first), np.diff(np.append(first, len(name))))
    hit = np.flatnonzero(least < high[owner])
    if not len(hit):
        return hit, hit, hit, hit
    new = np.append(True, (np.diff(hit) != 1) | (np.diff(least[hit]) != 0) | (np.diff(owner[hit]) != 0))
    a = hit[new]
    n = np.diff(np.append(np.flatnonzero(new), len(hit)))
    return owner[a], place[a], place[a] + n, least[a]


def units(width: int = WIDTH, gram: int = GRAM) -> Units:
    return Units(width, gram, split_words, join_words)


def _cut(docs: DataFrame, width: int, gram: int) -> DataFrame:
    """doc_id, text, text_hash, spans of every row."""
    rows = with_hash(docs)
    return rows.join(earlier_spans(rows, units(width, gram), least_documents), "doc_id", "left")


def dedup(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept (the remaining words, joined by one space) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, own, spans in zip(*(batch.column(c) for c in ("doc_id", "text", "text_hash", "spans")), strict=True):
                raw = (text.as_py() or "").encode()
                _, a, b = split_words(raw)
                own = own.as_py()
                gone = own_spans(spans.as_py(), own, len(a), width)
                keep, at = [], 0
                for x, y in [*gone, (len(a), len(a))]:
                    keep += [raw[i:j] for i, j in zip(a[at:x].tolist(), b[at:x].tolist(), strict=True)]
                    at = y
                kept = b" ".join(keep)
                out.append((doc_id.as_py(), len(a), sum(y - x for x, y in gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return _cut(docs, width, gram).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")


def apply_dedup(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """``docs`` without the repeated words: texts that lose words keep the rest joined by one space.

    A document that loses all its words goes; every other row stays, and texts that lose nothing stay as they are.
    """
    rows = docs.withColumns({"_id": F.col("doc_id").cast("long"), "_hash": F.xxhash64(F.col("text").cast("string"))})
    spans = earlier_spans(with_hash(docs), units(width, gram), least_documents).withColumnRenamed("doc_id", "_id").withColumnRenamed("spans", "_spans")
    out_schema = T.StructType(docs.schema.fields)
    where = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            stay = np.ones(len(texts), bool)
            for i, (own, spans) in enumerate(zip(batch.column("_hash").to_pylist(), batch.column("_spans").to_pylist(), strict=True)):
                if not spans or texts[i] is None:
                    continue
                raw = texts[i].encode()
                _, a, b = split_words(raw)
                gone = np.zeros(len(a), bool)
                for x, y in own_spans(spans, own, len(a), width):
                    gone[x:y] = True
                if not gone.any():
                    continue
                texts[i] = b" ".join([raw[x:y] for x, y in zip(a[~gone].tolist(), b[~gone].tolist(), strict=True)]).decode()
                stay[i] = not gone.all()
            columns = [batch.column(c) for c in out_schema.names]
            columns[where] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=out_schema.names).filter(pa.array(stay))

    return rows.join(spans, "_id", "left").mapInArrow(run, out_schema)
