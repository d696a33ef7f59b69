"""Repeated byte strings from the interval tree of an enhanced suffix array (operator 6).

Texts are UTF-8 bytes.  The 50-byte windows under a repeated minimiser meet in
its bucket (``repeats``); there ``maximal_repeats`` sorts the suffixes, scans
the common prefixes of neighbours with a stack and reports every interval of
at least 50 common bytes whose occurrences differ to the left, with all its
occurrences.  In each occurrence in a document with a greater id than the
least one, the bytes go.

Every 50-byte string that two documents share extends to such a group, so the
union of the groups covers exactly the bytes under strings that also start in
a document with a smaller id.

Defined cases: a null or empty text has no bytes; a null ``doc_id`` neither
loses bytes nor makes others lose them; rows that share a ``doc_id`` are one
document for the comparison and are cut each by its own text; matches never
cross rows; the bytes that remain may end inside a character, so ``kept`` is
binary; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortlab.llm.repeats import _BYTE, Units, _gram_hash, earlier_spans, join_bytes, own_spans, split_bytes, with_hash

WIDTH, GRAM = 50, 16


def maximal_repeats(strings: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All left-diverse common-prefix intervals of at least ``least`` bytes, with all their occurrences.

    Returns (group, length, string number, offset), one entry per occurrence.

    Only suffixes that can lie in such an interval are sorted: those whose first ``least`` bytes
    occur again, with another byte (or a start) to the left of some occurrence.  Where all have
    the same byte to the left, the interval is part of a longer repeat.
    """
    lengths = np.array([len(s) for s in strings], np.int64)
    longest = int(lengths.max())
    # ff is in no UTF-8 text, so 0 can end a string; the tail lets every suffix be read to the greatest length
    text = np.frombuffer(b"\0".join([s.replace(b"\0", b"\xff") for s in strings]) + bytes(longest + 1), np.uint8)
    starts = np.cumsum(lengths + 1) - lengths - 1
    owned = np.maximum(lengths - least + 1, 0)
    no = np.repeat(np.arange(len(strings)), owned)
    offset = np.arange(len(no)) - np.repeat(np.cumsum(owned) - owned, owned)
    nothing = (np.zeros(0, np.int64),) * 4
    if len(no) < 2:
        return nothing
    suffix = starts[no] + offset
    head = _gram_hash(_BYTE[text], least)[suffix]
    left = np.where(offset > 0, text[np.maximum(suffix - 1, 0)].astype(np.int64), -1 - np.arange(len(suffix)))  # a start differs from all
    order = np.argsort(head, kind="stable")
    edge = np.flatnonzero(np.append(True, np.diff(head[order]) != 0))
    size = np.diff(np.append(edge, len(order)))
    own = left[order]
    use = order[np.repeat((size > 1) & (np.minimum.reduceat(own, edge) != np.maximum.reduceat(own, edge)), size)]
    if not len(use):
        return nothing
    no, offset, left, suffix = no[use], offset[use], left[use], suffix[use]
    # the enhanced suffix array: suffixes to the end of their string, in order, and neighbours' common prefixes
    room = lengths[no] - offset
    table = np.lib.stride_tricks.sliding_window_view(text, longest)[suffix]
    table[np.arange(longest)[None, :] >= room[:, None]] = 0
    order = np.argsort(np.ascontiguousarray(table).view(f"S{longest}").ravel(), kind="stable")
    no, offset, left, room, table = no[order], offset[order], left[order], room[order], table[order]
    differ = table[1:] != table[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), longest)
    common = np.minimum(common, np.minimum(room[:-1], room[1:]))
    edge = np.flatnonzero(np.append(True, common < least))
    size = np.diff(np.append(edge, len(no)))
    groups: list[tuple[int, int, int]] = []
    for a, n in zip(edge[size > 1].tolist(), size[size > 1].tolist(), strict=True):
        groups += _intervals(common[a:a + n - 1].tolist(), left[a:a + n].tolist(), a)
    if not groups:
        return nothing
    first, last, length = (np.array(x, np.int64) for x in zip(*groups, strict=True))
    n = last - first
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    return np.repeat(np.arange(len(n)), n), np.repeat(length, n), no[at], offset[at]


def _intervals(common: list[int], left: list[int], base: int) -> list[tuple[int, int, int]]:
    """Stack scan of one run: (first, last + 1, length) of the left-diverse intervals of its tree."""
    out = []
    stack: list[list[int]] = []  # length, first, least left byte, greatest left byte
    for i in range(len(left)):
        now = common[i - 1] if i else 0
        first, low, high = i - 1, left[i - 1] if i else 0, left[i - 1] if i else 0
        while stack and stack[-1][0] > now:
            length, first, low, high = stack.pop()
            if low != high:
                out.append((base + first, base + i, length))
            if stack:
                stack[-1][2], stack[-1][3] = min(stack[-1][2], low), max(stack[-1][3], high)
        if i:
            if not stack or stack[-1][0] < now:
                stack.append([now, first, low, high])
            stack[-1][2], stack[-1][3] = min(stack[-1][2], left[i]), max(stack[-1][3], left[i])
    while stack:
        length, first, low, high = stack.pop()
        if low != high:
            out.append((base + first, base + len(left), length))
        if stack:
            stack[-1][2], stack[-1][3] = min(stack[-1][2], low), max(stack[-1][3], high)
    return out


def least_documents(strings: list[bytes], low: np.ndarray, high: np.ndarray, u: Units):
    """Runs of windows of each string with their least document, where it is under ``high``: the string's own, or a repeat group's."""
    windows = np.array([max(0, len(s) - u.width + 1) for s in strings], np.int64)
    start = np.cumsum(windows) - windows
    owner = np.repeat(np.arange(len(strings)), windows)
    least = low[owner]
    group, length, no, offset = maximal_repeats(strings, u.width)
    if len(group):
        first = np.flatnonzero(np.append(True, np.diff(group) != 0))
        found = np.repeat(np.minimum.reduceat(low[no], first), np.diff(np.append(first, len(group))))
        use = found < low[no]  # the others tell their string nothing new
        found, a, n = found[use], (start[no] + offset)[use], (length - u.width + 1)[use]
        at = np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        np.minimum.at(least, at, np.repeat(found, n))
    hit = np.flatnonzero(least < high[owner])
    if not len(hit):
        return hit, hit, hit, hit
    new = np.append(True, (np.diff(hit) != 1) | (np.diff(least[hit]) != 0) | (np.diff(owner[hit]) != 0))
    a = hit[new]
    n = np.diff(np.append(np.flatnonzero(new), len(hit)))
    place = a - start[owner[a]]
    return owner[a], place, place + n, least[a]


def units(width: int = WIDTH, gram: int = GRAM) -> Units:
    return Units(width, gram, split_bytes, join_bytes)


def dedup(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes) and the removed runs of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("kept_sha256", pa.string()), ("kept", pa.binary()), ("removed", pa.list_(pa.list_(pa.int64())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, own, spans in zip(*(batch.column(c) for c in ("doc_id", "text", "text_hash", "spans")), strict=True):
                raw, own = (text.as_py() or "").encode(), own.as_py()
                gone = own_spans(spans.as_py(), own, len(raw), width)
                kept = b"".join(raw[x:y] for x, y in zip([0, *(b for _, b in gone)], [*(a for a, _ in gone), len(raw)], strict=True))
                out.append((doc_id.as_py(), len(raw), sum(b - a for a, b in gone), len(gone), hashlib.sha256(kept).hexdigest(), kept,
                            [list(g) for g in gone]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    rows = with_hash(docs)
    found = rows.join(earlier_spans(rows, units(width, gram), least_documents), "doc_id", "left")
    return found.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, removed array<array<long>>")
