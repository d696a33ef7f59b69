"""Best-fit packing of token pieces with certified bin counts (operator 2).

Pieces are dealt by hash into partitions of a bounded number of pieces and
packed by best-fit decreasing.  Dual-feasible functions give a lower bound on
the bins that any packing of the partition's pieces needs: a partition that
meets its bound is certified and settled.  In a partition with a gap the full
bins stay; the documents of its other bins are exchanged with those of other
gap partitions (fewer partitions, another hash) and packed again, until
nothing is left open or a round saves nothing.

Defined cases: a null or empty text is one end id; repeated rows are packed
each; an empty table gives no rows; further columns pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlab.llm.common import keep
from cohortlab.llm.tokens import encoder, slices


def token_pieces(docs: DataFrame, tokenizer_path: str, rule: str = "drop", end_id: int = 0, capacity: int = 2048,
                 with_ids: bool = True) -> DataFrame:
    """Cut each document's ids (with the end id) into pieces of ``capacity``; the last may be shorter.

    Columns: doc_id, piece (from 0), start, length, ids_crc32 and, if asked for, the packed ``ids`` (little-endian).
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path, rule)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        for batch in batches:
            for at, texts in slices(batch.column("text")):
                rows: list[tuple] = []
                ids, bounds = enc.encode(texts, end_id)
                wide = ids.astype("<u4")
                for doc_id, a, b in zip(batch.column("doc_id").slice(at, len(texts)).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    for piece, start in enumerate(range(a, b, capacity)):
                        stop = min(start + capacity, b)
                        rows.append((doc_id, piece, start - a, stop - start, zlib.crc32(wide[start:stop]), *([ids[start:stop].tobytes()] if with_ids else [])))
                cols = list(zip(*rows, strict=True)) or [()] * (5 + with_ids)
                yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=False)], names=names[:len(cols)])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(cut, schema))


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of the volume bound and two families of dual-feasible functions."""
    if not len(lengths):
        return 0
    sizes, counts = np.unique(np.asarray(lengths, dtype=np.int64), return_counts=True)
    best = -(-int((sizes * counts).sum()) // capacity)
    # f_t: sizes over capacity - t count as a whole bin, sizes under t as nothing
    for t in np.unique(np.concatenate([sizes[sizes <= capacity // 2], [1]])):
        f = np.where(sizes > capacity - t, capacity, np.where(sizes < t, 0, sizes))
        best = max(best, -(-int((f * counts).sum()) // capacity))
    # u_k: (k + 1) x / capacity rounded down, in k-ths of a bin; whole numbers stay as they are
    for k in range(1, 33):
        whole, rest = np.divmod((k + 1) * sizes, capacity)
        u = np.where(rest == 0, k * sizes, whole * capacity)  # k times the function, still integers
        best = max(best, -(-int((u * counts).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, fill of the bin) of each piece; ``lengths`` must be in descending order."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by room left
    rooms, fills = 0, []  # bit r of rooms: some bin has room r
    for i, n in enumerate(lengths.tolist()):
        fits = rooms >> n
        if fits and n:
            room = n + (fits & -fits).bit_length() - 1
            b = open_at[room].pop()
            if not open_at[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += n
        if room - n:
            open_at[room - n].append(b)
            rooms |= 1 << (room - n)
    return bins, offsets, np.array(fills, np.int64)[bins] if len(bins) else bins


def pack(pieces: DataFrame, capacity: int = 2048, per_partition: int = 50_000, rounds: int = 6) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) with sequence_id and offset.

    A task holds about ``per_partition`` pieces.  Each round is written to the
    shared scratch folder, so a lost executor costs one task, and ids depend on
    the data only.
    """
    names, schema = pieces.columns, pieces.schema
    out_schema = T.StructType([*schema.fields, T.StructField("sequence_id", T.LongType()),
                               T.StructField("offset", T.LongType()), T.StructField("settled", T.BooleanType())])

    def packer(round_no: int, n_parts: int, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables = [b for b in batches if b.num_rows]
            if not tables:
                return
            table = pa.Table.from_batches(tables)
            for part in np.unique(table["_part"].to_numpy()):
                own = table.filter(pa.compute.equal(table["_part"], int(part)))
                own = own.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("start", "ascending")])
                lengths = own["length"].to_numpy()
                bins, offsets, fills = best_fit_decreasing(lengths, capacity)
                certified = int(bins.max()) + 1 == lower_bound(lengths, capacity)
                settled = np.full(len(bins), True) if certified or last else fills == capacity
                ids = (np.int64(round_no) << 58) | (np.int64(part) << 32) | bins
                for b in (own.drop_columns(["_part"]).append_column("sequence_id", pa.array(ids))
                          .append_column("offset", pa.array(offsets)).append_column("settled", pa.array(settled))).to_batches():
                    yield b
        return run

    settled, todo, before = [], pieces, None
    for r in range(rounds):
        n = todo.count()
        if not n:
            break
        n_parts = -(-n // per_partition)
        last = r == rounds - 1 or n == before
        dealt = todo.withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece", F.lit(r)), F.lit(n_parts)).cast("long"))
        packed = keep(dealt.repartition(n_parts, "_part").mapInArrow(packer(r, n_parts, last), out_schema), f"packed-{r}")
        settled.append(packed.where("settled"))
        before, todo = n, packed.where("not settled").select(*names)
        if last or n_parts == 1:  # one partition alone has nobody to exchange with
            settled.append(packed.where("not settled"))
            break
    if not settled:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    out = settled[0]
    for s in settled[1:]:
        out = out.unionByName(s)
    return out.drop("settled")


def pack_documents(docs: DataFrame, tokenizer_path: str, rule: str = "drop", end_id: int = 0, capacity: int = 2048,
                   with_ids: bool = False) -> DataFrame:
    """Pieces of all ``docs`` with their place: doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset.

    The texts are encoded once; what the rounds move is one narrow row per piece unless ``with_ids`` is set.
    """
    return pack(keep(token_pieces(docs, tokenizer_path, rule, end_id, capacity, with_ids), "pieces"), capacity)
