"""What the two repeat operators share: windows of units, their minimisers, and who repeats them.

A unit is a word or a byte.  Each window of ``width`` units is assigned to the
smallest hash of the ``gram``-unit grams in it (its minimiser); consecutive
windows with the same minimiser form one super-k-mer.  Equal windows have the
same minimiser, so they meet in the minimiser's bucket.

1. ``_wanted``: the documents' minimisers go to their buckets, packed (a few
   bytes each); a minimiser of a single document cannot head a repeat.
2. ``_spans``: the documents meet the list of their repeated minimisers and send
   those super-k-mers as packed strings to the buckets, where the operator's own
   method (sorting, or an enhanced suffix array) finds for each window the least
   document that has it.
3. The spans of each document come back and it is cut.

Hot minimisers and strings are merged before they are shuffled.  What many
documents of one task share is settled there: a minimiser of two of them is
known to repeat, and a string of two of them is known to go from the greater
one.  So a task sends each minimiser and each string once, whatever share of
the documents has it.  A document equal to a smaller one as a whole sends no
strings: all its windows are known to repeat.

Hash collisions only let some strings through step 1; step 2 compares the units
themselves.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BASE = 0x9E3779B97F4A7C15
#: Fixed random value of each byte.
_BYTE = np.random.default_rng(2024).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Windows of one super-k-mer at most; longer runs go on as the next one.
RUN = 64
#: Minimisers and bytes of strings packed at once, and bytes of text looked at together.
_PACK, _PACK_BYTES, _STEP = 1_000_000, 8 << 20, 1 << 20
#: Bytes of text to a bucket, and buckets at least; a task takes up to ``TOGETHER`` of them, one after the other.
BUCKET_BYTES, BUCKETS, TOGETHER = 8 << 20, 64, 4


@dataclass(frozen=True)
class Units:
    """``split(text bytes) -> (hash, from, to)`` of each unit; ``join(text bytes, first, last, from, to)`` packs a run."""

    width: int
    gram: int
    split: Callable[[bytes], tuple[np.ndarray, np.ndarray, np.ndarray]]
    join: Callable[[bytes, int, int, np.ndarray, np.ndarray], bytes]


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def split_bytes(text: bytes):
    return _BYTE[np.frombuffer(text, np.uint8)], None, None


def join_bytes(text: bytes, first: int, last: int, a, b) -> bytes:
    return text[first:last]


def split_words(text: bytes):
    """Words between the bytes 20 and 09 to 0D; a word's hash is a polynomial of its bytes."""
    raw = np.frombuffer(text, np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = (raw != 0x20) & ((raw < 0x09) | (raw > 0x0D))
    turn = np.diff(inside)
    a, b = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    if not len(a):
        return np.zeros(0, np.uint64), a, b
    if len(raw) > len(_POWERS[0]):
        _grow(len(raw))
    up, down = _POWERS
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[:len(raw)], out=total[1:])
    h = (total[b] - total[a]) * down[a]
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9), a, b


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grow(n: int) -> None:
    """Powers of the base and of its inverse, up to ``n``."""
    for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
        p = np.full(n + 1, base, np.uint64)
        p[0] = 1
        _POWERS[k] = np.cumprod(p, dtype=np.uint64)


def join_words(text: bytes, first: int, last: int, a: np.ndarray, b: np.ndarray) -> bytes:
    return b" ".join([text[i:j] for i, j in zip(a[first:last].tolist(), b[first:last].tolist(), strict=True)])


def _gram_hash(unit: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` units from each position, by doubling."""
    out, length, h, size = None, 0, unit, 1
    while True:
        if n & size:
            if out is None:
                out, length = h, size
            else:
                m = len(h) - length
                out, length = out[:m] * _power(size) + h[length:length + m], length + size
        if size * 2 > n:
            break
        h = h[:-size] * _power(size) + h[size:]
        size *= 2
    out = out ^ (out >> np.uint64(31))
    out = out * np.uint64(0x7FB5D329728EA185)
    return out ^ (out >> np.uint64(27))


def _sliding_min(h: np.ndarray, k: int) -> np.ndarray:
    size = 1
    while size * 2 <= k:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[:-(k - size)], h[k - size:]) if k > size else h


def runs(hashes: list[np.ndarray], u: Units, n_buckets: int):
    """(key, text number, first window, windows) of all super-k-mers of some texts; key = bucket << 32 | hash."""
    long_ones = [i for i, h in enumerate(hashes) if len(h) >= u.width]
    if not long_ones:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64))
    counts = np.array([len(hashes[i]) for i in long_ones])
    least = _sliding_min(_gram_hash(np.concatenate([hashes[i] for i in long_ones]), u.gram), u.width - u.gram + 1)
    starts = np.cumsum(counts) - counts
    windows = counts - u.width + 1
    owner = np.repeat(np.arange(len(counts)), windows)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    least = least[starts[owner] + place]
    new = np.ones(len(owner), bool)
    new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(owner)))
    if (length > RUN).any():  # cut long runs
        times = -(-length // RUN)
        k = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        first, length = np.repeat(first, times) + k * RUN, np.minimum(np.repeat(length, times) - k * RUN, RUN)
    h = least[first]
    key = ((h % np.uint64(n_buckets)) << np.uint64(32)) | (h >> np.uint64(32))
    return key.astype(np.int64), np.array(long_ones)[owner[first]], place[first], length


def _dump(*arrays: np.ndarray) -> bytes:
    """Arrays as byte planes, compressed; small numbers cost little."""
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        data = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b""
        parts.append(struct.pack("<IB", len(a), a.itemsize) + data)
    return zstandard.compress(b"".join(parts), 1)


def _load(data: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.decompress(data), 0, []
    while at < len(raw):
        n, size = struct.unpack_from("<IB", raw, at)
        planes = np.frombuffer(raw, np.uint8, n * size, at + 5).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{size}").ravel())
        at += 5 + n * size
    return out


def _deltas(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=a.dtype.type(0))


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple):
    """(key values, rows) of consecutive rows with the same ones; the partition is sorted by them."""
    now, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if rows and key != now:
                yield now, rows
                rows = []
            now = key
            rows.append(row)
    if rows:
        yield now, rows


def _texts(batch: pa.RecordBatch, step: int = _STEP):
    """(row numbers, texts as bytes) of about ``step`` bytes at a time; rows without id or text are left out."""
    column = batch.column("text").cast(pa.binary())
    ids = batch.column("doc_id").is_valid().to_pylist()
    rows, texts, size = [], [], 0
    for i, ok in enumerate(ids):
        text = column[i].as_py() if ok else None
        if text:
            rows.append(i)
            texts.append(text)
            size += len(text)
            if size >= step:
                yield rows, texts
                rows, texts, size = [], [], 0
    if rows:
        yield rows, texts


def _by_document(doc: np.ndarray, *values: np.ndarray):
    """(document, bytes of its values, interleaved) of each document."""
    order = np.argsort(doc, kind="stable")
    doc, rows = doc[order], np.column_stack([v[order] for v in values]).astype(np.int64)
    cuts = np.append(np.flatnonzero(np.append(True, doc[1:] != doc[:-1])), len(doc)).tolist()
    raw, n = rows.tobytes(), 8 * rows.shape[1]
    return doc[cuts[:-1]], [raw[n * a:n * b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _buckets(docs: DataFrame) -> int:
    """As many buckets as the whole text asks for, so that what a task holds at once stays the same at every size."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("size")).first().size or 0
    return max(BUCKETS, -(-size // BUCKET_BYTES))


def _dealt(rows: DataFrame, n_buckets: int) -> DataFrame:
    """Rows by bucket; neighbouring numbers go to different tasks, so all tasks have the same number of buckets."""
    tasks = min(n_buckets, max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_buckets // TOGETHER)))
    return rows.repartitionById(tasks, (F.col("bucket") % F.lit(tasks)).cast("int")).sortWithinPartitions("bucket", "kind")


def _wanted(docs: DataFrame, u: Units, n_buckets: int) -> DataFrame:
    """(doc_id, keys): the minimisers of each document that other documents have too, as packed 64-bit keys.

    Rows of kind 0 carry a task's minimisers of one bucket, each once: hash, document, and whether the task
    knows that it repeats.  Rows of kind 1 carry answers that the task knows.
    """
    sent = pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, owners, n = [], [], 0

        def flush():
            key, doc = np.concatenate(keys), np.concatenate(owners)
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            fresh = np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]))
            key, doc = key[fresh], doc[fresh]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            size = np.diff(np.append(first, len(key)))
            known = np.repeat(size > 1, size)
            out = []
            if known.any():
                at = np.argsort(doc[known], kind="stable")
                out.append((int(key[0] % n_buckets), 1, _dump(_deltas(doc[known][at].astype(np.uint64)), key[known][at].astype(np.uint64))))
            key, doc, many = key[first], doc[first], (size > 1).astype(np.uint8)
            bucket = (key >> 32).astype(np.int64)
            cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(key)).tolist()
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                table, place = np.unique(doc[a:b], return_inverse=True)
                out.append((int(bucket[a]), 0, _dump(_deltas((key[a:b] & 0xFFFFFFFF).astype(np.uint32)), many[a:b],
                                                     np.where(many[a:b], 0, place).astype(np.uint32), _deltas(table.astype(np.uint64)))))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), sent, strict=True)], schema=sent)

        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for rows, texts in _texts(batch):
                key, doc, _, _ = runs([u.split(t)[0] for t in texts], u, n_buckets)
                if len(key):
                    keys.append(key)
                    owners.append(ids[np.array(rows)[doc]].astype(np.int64))
                    n += len(key)
                if n >= _PACK:
                    yield flush()
                    keys, owners, n = [], [], 0
        if n:
            yield flush()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(doc, key):
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(_by_document(doc, key), (pa.int64(), pa.binary()), strict=True)], names=["doc_id", "keys"])

        for (bucket, kind), packed in _groups(batches, ("bucket", "kind")):
            if kind == 1:
                for r in packed:
                    doc, key = _load(r["data"])
                    yield rows(np.cumsum(doc, dtype=np.uint64).astype(np.int64), key.astype(np.int64))
                continue
            parts = []
            for r in packed:
                h, many, place, table = _load(r["data"])
                parts.append((np.cumsum(h, dtype=np.uint32), many, np.cumsum(table, dtype=np.uint64).astype(np.int64)[place]))
            h, many, doc = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(h, kind="stable")
            h, many, doc = h[order], many[order], doc[order]
            first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            size = np.diff(np.append(first, len(h)))
            hit = np.repeat((size > 1) | (np.maximum.reduceat(many, first) > 0), size) & (many == 0)
            if hit.any():
                yield rows(doc[hit], np.int64(bucket) << 32 | h[hit].astype(np.int64))

    return _dealt(docs.mapInArrow(run, "bucket long, kind int, data binary"), n_buckets).mapInArrow(answer, "doc_id long, keys binary")


def _spans(docs: DataFrame, wanted: DataFrame, u: Units, n_buckets: int, resolve: Callable) -> DataFrame:
    """(doc_id, spans): packed (text hash, from, to) of unit spans that a smaller document has too.

    Rows of kind 0 carry a task's strings of one bucket, each once, with the places of its least document;
    rows of kind 1 carry the places in greater documents, which go as a whole.
    """
    sent = pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[tuple[int, bytes], tuple[int, list]] = {}  # (key, string) -> least document, its places
        greater: list[tuple] = []  # document, place
        size = 0

        def flush():
            out = []
            if greater:
                doc = np.array([d for d, _ in greater], np.int64)
                text_hash, first, n = np.array([p for _, p in greater], np.int64).T
                out.append((int(first.sum()) % n_buckets, 1, _dump(doc.astype(np.uint64), text_hash.view(np.uint64), first.astype(np.uint64), n.astype(np.uint32))))
            order = sorted(least, key=lambda x: x[0])
            key = np.array([k for k, _ in order], np.int64)
            bucket = key >> 32
            at = np.argsort(bucket, kind="stable")
            cuts = np.append(np.flatnonzero(np.append(True, np.diff(bucket[at]) != 0)), len(at)).tolist()
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                own = [order[i] for i in at[a:b].tolist()]
                docs_of, places = [least[x][0] for x in own], [least[x][1] for x in own]
                text_hash, first, _ = np.array([p for ps in places for p in ps], np.int64).T
                head = _dump(_deltas(key[at[a:b]].astype(np.uint64)), np.array([len(s) for _, s in own], np.uint32), np.array(docs_of, np.int64).astype(np.uint64),
                             np.array([len(p) for p in places], np.uint32), text_hash.view(np.uint64), first.astype(np.uint64))
                out.append((int(bucket[at[a]]), 0, struct.pack("<I", len(head)) + head + zstandard.compress(b"".join([s for _, s in own]), 3)))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), sent, strict=True)], schema=sent)

        for batch in batches:
            ids, hashes, lists = (batch.column(c) for c in ("doc_id", "text_hash", "lists"))
            for rows, texts in _texts(batch):
                pairs = [(i, t) for i, t in zip(rows, texts, strict=True) if lists[i].is_valid]
                if not pairs:
                    continue
                split = [u.split(t) for _, t in pairs]
                key, no, first, length = runs([s[0] for s in split], u, n_buckets)
                ends = np.searchsorted(no, np.arange(len(pairs) + 1))
                for k, (i, text) in enumerate(pairs):
                    own = np.unique(np.frombuffer(b"".join(lists[i].as_py()), np.int64))
                    at = slice(ends[k], ends[k + 1])
                    hit = np.flatnonzero(np.isin(key[at], own)) + ends[k]
                    doc_id, text_hash = ids[i].as_py(), hashes[i].as_py()
                    _, a, b = split[k]
                    for x, f, n in zip(key[hit].tolist(), first[hit].tolist(), length[hit].tolist(), strict=True):
                        string = u.join(text, f, f + n + u.width - 1, a, b)
                        old = least.get((x, string))
                        if old is None:
                            size += len(string)
                            least[x, string] = (doc_id, [(text_hash, f, n)])
                        elif old[0] == doc_id:
                            old[1].append((text_hash, f, n))
                        elif old[0] < doc_id:
                            greater.append((doc_id, (text_hash, f, n)))
                        else:
                            greater.extend((old[0], p) for p in old[1])
                            least[x, string] = (doc_id, [(text_hash, f, n)])
                if size >= _PACK_BYTES or len(greater) >= 200_000:
                    yield flush()
                    least.clear()
                    greater.clear()
                    size = 0
        if least:
            yield flush()

    def spans(doc, text_hash, a, b):
        who, data = _by_document(doc, text_hash, a, b)
        return pa.RecordBatch.from_arrays([pa.array(who, pa.int64()), pa.array(data, pa.binary())], names=["doc_id", "spans"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, kind), packed in _groups(batches, ("bucket", "kind")):
            if kind == 1:
                for r in packed:
                    doc, text_hash, first, n = (x.astype(np.int64) for x in _load(r["data"]))
                    yield spans(doc, text_hash, first, first + n + (u.width - 1))
                continue
            number: dict[bytes, int] = {}
            keys, of, docs_of, hashes, firsts = [], [], [], [], []
            for r in packed:
                n_head = struct.unpack_from("<I", r["data"])[0]
                key, lengths, doc, n_places, text_hash, first = _load(r["data"][4:4 + n_head])
                raw = zstandard.decompress(r["data"][4 + n_head:])
                cuts = np.append(0, np.cumsum(lengths, dtype=np.int64)).tolist()
                for k, a, b in zip(np.cumsum(key, dtype=np.uint64).astype(np.int64).tolist(), cuts[:-1], cuts[1:], strict=True):
                    s = raw[a:b]
                    m = number.get(s)
                    if m is None:
                        m = number[s] = len(number)
                        keys.append(k)
                    of.append(m)
                docs_of.append(np.repeat(doc.astype(np.int64), n_places))
                hashes.append(text_hash.view(np.int64))
                firsts.append(first.astype(np.int64))
                of[-len(doc):] = np.repeat(np.array(of[-len(doc):], np.int64), n_places).tolist()
            of, doc, text_hash, first = np.array(of, np.int64), *(np.concatenate(x) for x in (docs_of, hashes, firsts))
            strings = list(number)
            low, high = np.full(len(strings), np.iinfo(np.int64).max), np.full(len(strings), np.iinfo(np.int64).min)
            np.minimum.at(low, of, doc)
            np.maximum.at(high, of, doc)
            order = np.argsort(of, kind="stable")
            of, doc, text_hash, first = of[order], doc[order], text_hash[order], first[order]
            by_key = np.argsort(np.array(keys), kind="stable")
            key = np.array(keys)[by_key]
            total = np.cumsum([len(strings[i]) for i in by_key.tolist()])
            # whole keys, about _STEP bytes at a time
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            cut = starts[np.append(True, np.diff(total[starts] // _STEP) != 0)].tolist() + [len(key)]
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                own = by_key[a:b]
                no, p, q, found = resolve([strings[i] for i in own.tolist()], low[own], high[own], u)
                if not len(no):
                    continue
                at = np.argsort(own[no], kind="stable")
                no, p, q, found = own[no][at], p[at], q[at], found[at]
                # every place of a string takes every part found for it
                left, right = np.searchsorted(of, no), np.searchsorted(of, no, side="right")
                times = right - left
                place = np.repeat(left, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                p, q, found = (np.repeat(x, times) for x in (p, q, found))
                use = found < doc[place]
                place = place[use]
                if len(place):
                    yield spans(doc[place], text_hash[place], first[place] + p[use], first[place] + q[use] + (u.width - 1))

    return _dealt(docs.join(wanted, "doc_id", "left").mapInArrow(run, "bucket long, kind int, data binary"), n_buckets).mapInArrow(solve, "doc_id long, spans binary")


def earlier_spans(docs: DataFrame, u: Units, resolve: Callable) -> DataFrame:
    """Per document with repeats, the unit spans that a smaller document has too: (doc_id, spans); ``own_spans`` reads them.

    ``docs``: doc_id, text, text_hash.  ``resolve(strings, low, high, u)`` gives for distinct strings of
    one or more whole minimisers the (string number, first window, last window + 1, least document)
    tuples that matter, i.e. whose least document is under the string's greatest one.
    """
    n_buckets = _buckets(docs)
    digest = docs.where("doc_id is not null and text is not null").select("doc_id", "text_hash", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"))
    least = digest.groupBy("digest").agg(F.min("doc_id").alias("least"))
    against = digest.join(least, "digest").select("doc_id", "text_hash", (F.col("doc_id") > F.col("least")).alias("copy"))
    copies = against.where("copy").select("doc_id", "text_hash")
    # an id of which every row is a copy sends nothing; rows that share their id with another text do
    nothing_else = against.groupBy("doc_id").agg(F.min(F.col("copy").cast("int")).alias("copy")).where("copy = 1").select("doc_id")
    wanted = (_wanted(docs.select("doc_id", "text"), u, n_buckets).groupBy("doc_id").agg(F.collect_list("keys").alias("lists"))
              .join(nothing_else, "doc_id", "left_anti"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                doc, text_hash = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "text_hash"))
                who, data = _by_document(doc, text_hash, np.zeros(len(doc), np.int64), np.full(len(doc), 1 << 62))
                yield pa.RecordBatch.from_arrays([pa.array(who, pa.int64()), pa.array(data, pa.binary())], names=["doc_id", "spans"])

    found = _spans(docs, wanted, u, n_buckets, resolve).unionByName(copies.mapInArrow(whole, "doc_id long, spans binary"))
    return found.groupBy("doc_id").agg(F.collect_list("spans").alias("spans"))


def own_spans(packed: list[bytes] | None, text_hash: int | None, n: int, width: int) -> list[tuple[int, int]]:
    """The merged spans of one row among the packed spans of its ``doc_id``."""
    if not packed:
        return []
    rows = np.frombuffer(b"".join(packed), np.int64).reshape(-1, 3)
    return merged(rows[rows[:, 0] == text_hash][:, 1:].tolist(), n, width)


def merged(spans: list, n: int, width: int) -> list[tuple[int, int]]:
    """Disjoint maximal spans, clipped to ``n`` units; none is shorter than a window (a copy of a short text)."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        b = min(b, n)
        if b - a < width:
            continue
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def with_hash(docs: DataFrame) -> DataFrame:
    """doc_id, text, text_hash: the columns that the operators look at."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.xxhash64(F.col("text").cast("string")).alias("text_hash"))
