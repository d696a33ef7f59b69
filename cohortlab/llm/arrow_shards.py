"""Token ids as Arrow stream files of equal-length sequences (operator 1).

Each shard file holds two Arrow IPC streams, one after the other:

1. ``input_ids fixed_size_list<uint16|uint32>[seq_len]`` and ``mask
   fixed_size_list<uint8>[seq_len / 8]``, a bit per id, lowest first: the shard's documents joined in ascending
   ``doc_id`` order and cut into sequences of ``seq_len``.  All batches have
   ``rows_per_batch`` sequences and so the same byte length: sequence ``i`` is
   found by arithmetic and read without copying (``Shard``), ids and mask alike.
   The tail is padding with mask 0.
2. ``doc_id int64, start int64, n_tokens int64``: where each document lies in
   the shard.

Spark's own file writer commits the files and Spark's binary reader reads them
back, so any store that Spark reaches will do and a lost task leaves nothing
behind.  The writer ends each record with a separator; it is set to the last
four bytes of the second stream's end mark (all zero), so the file is exactly
the two streams.

Defined cases: a null or empty text is one end id; a null ``doc_id`` sorts
first; rows that share a ``doc_id`` are ordered by text and all kept; an
empty table gives no files; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlab.llm.common import keep
from cohortlab.llm.tokens import encoder, slices

#: Bytes of earlier pieces of text and their ids that a worker keeps.
KNOWN_BYTES = 96 << 20
_TAIL = b"\x00\x00\x00\x00"
_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def _shard_bytes(ids: np.ndarray, doc_ids: list, lengths: list[int], seq_len: int, rows: int) -> bytes:
    """Both streams of one shard."""
    size = rows * seq_len
    kind = pa.from_numpy_dtype(ids.dtype)
    schema = pa.schema([("input_ids", pa.list_(pa.field("item", kind, False), seq_len)),
                        ("mask", pa.list_(pa.field("item", pa.uint8(), False), seq_len // 8))])
    ones = np.full(size // 8, 255, np.uint8)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as out:
        for at in range(0, max(len(ids), 1), size):
            part, mask = ids[at:at + size], ones
            if len(part) < size:  # the last batch
                mask = np.packbits(np.arange(size) < len(part), bitorder="little")
                part = np.concatenate([part, np.zeros(size - len(part), ids.dtype)])
            out.write_batch(pa.record_batch([
                pa.FixedSizeListArray.from_arrays(pa.array(part, kind), type=schema.field(0).type),
                pa.FixedSizeListArray.from_arrays(pa.array(mask), type=schema.field(1).type)], schema=schema))
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1].astype(np.int64)
    with pa.ipc.new_stream(sink, _INDEX) as out:
        out.write_batch(pa.record_batch([pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(lengths, pa.int64())],
                                        schema=_INDEX))
    data = sink.getvalue().to_pybytes()
    if not data.endswith(_TAIL):
        raise ValueError("an Arrow stream ends with four zero bytes")
    return data[:-len(_TAIL)]


def write_shards(docs: DataFrame, path: str, tokenizer_path: str, rule: str = "lead", end_id: int | None = 2,
                 seq_len: int = 1024, rows_per_batch: int = 16, shard_tokens: int = 4_000_000) -> str:
    """Encode ``docs`` (doc_id, text) and write shard files under ``path`` in ascending ``doc_id`` order.

    ``seq_len`` is a multiple of 8.  One shuffle: the texts, range-partitioned by ``doc_id``.  A task holds one
    shard (``shard_tokens`` ids, or one longer document) at a time, and ``KNOWN_BYTES`` of pieces met before.
    """
    if seq_len % 8:
        raise ValueError("seq_len must be a multiple of 8: a mask is a whole number of bytes")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path, rule, KNOWN_BYTES)
        parts, doc_ids, lengths, total = [], [], [], 0

        def shard() -> pa.RecordBatch:
            return pa.record_batch([pa.array([_shard_bytes(np.concatenate(parts), doc_ids, lengths, seq_len, rows_per_batch)], pa.binary())],
                                   names=["content"])

        for batch in batches:
            for at, texts in slices(batch.column("text")):
                ids, bounds = enc.encode(texts, end_id)
                own = batch.column("doc_id").slice(at, len(texts)).to_pylist()
                i = 0
                while i < len(own):  # up to the document that fills the shard
                    j = min(int(np.searchsorted(bounds, bounds[i] + shard_tokens - total)), len(own))
                    j = max(j, i + 1)
                    parts.append(ids[bounds[i]:bounds[j]].copy())
                    doc_ids += own[i:j]
                    lengths += np.diff(bounds[i:j + 1]).tolist()
                    total += int(bounds[j] - bounds[i])
                    i = j
                    if total >= shard_tokens:
                        yield shard()
                        parts, doc_ids, lengths, total = [], [], [], 0
        if doc_ids:
            yield shard()

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    (ordered.mapInArrow(pack, "content binary").select(F.col("content").cast("string").alias("value"))
     .write.option("lineSep", _TAIL.decode()).option("maxRecordsPerFile", 1).text(path))
    return path


def unpacked(bits: np.ndarray) -> np.ndarray:
    """The booleans of mask bits."""
    return np.unpackbits(bits, bitorder="little").view(np.bool_)


class Shard:
    """Random access to one shard file's bytes (a memory map, a buffer); nothing is copied."""

    def __init__(self, data):
        self.buffer = data if isinstance(data, pa.Buffer) else pa.py_buffer(data)
        source = pa.BufferReader(self.buffer)
        self.schema = pa.ipc.read_schema(source)
        self._first = source.tell()
        batch = pa.ipc.read_record_batch(pa.ipc.read_message(source), self.schema)
        self._step, self._rows = source.tell() - self._first, batch.num_rows
        pos = source.tell()
        size = self.buffer.size
        # every batch message has the same length; the end mark starts with ff ff ff ff 00 00 00 00
        self.n_batches = 1
        while pos < size and self.buffer.slice(pos, 8).to_pybytes() != b"\xff\xff\xff\xff\x00\x00\x00\x00":
            pos += self._step
            self.n_batches += 1
        with pa.ipc.open_stream(self.buffer.slice(pos + 8)) as reader:
            self.index = reader.read_all()

    def _batch(self, b: int) -> pa.RecordBatch:
        return pa.ipc.read_record_batch(pa.ipc.read_message(self.buffer.slice(self._first + b * self._step)), self.schema)

    def __len__(self) -> int:
        return self.n_batches * self._rows

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask bits of sequence ``i``, both views of the file's bytes; ``unpacked`` makes booleans of the bits."""
        batch = self._batch(i // self._rows)
        ids, bits = (batch.column(k)[i % self._rows].values.to_numpy(zero_copy_only=True) for k in (0, 1))
        return ids, bits

    def tokens(self) -> np.ndarray:
        """All unmasked ids in order."""
        out = []
        for b in range(self.n_batches):
            batch = self._batch(b)
            ids = batch.column(0).flatten().to_numpy(zero_copy_only=True)
            out.append(ids[unpacked(batch.column(1).flatten().to_numpy(zero_copy_only=True))])
        return np.concatenate(out)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens, ids_crc32, shard.

    ``start`` counts the ids of all documents before it: the shard's place (a
    running sum over one row per shard) plus the place in the shard.
    """
    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                data = content.as_buffer()
                if data is None or not data.size:
                    continue
                shard = Shard(data)
                ids, table = shard.tokens(), shard.index
                starts, counts = table["start"].to_numpy(), table["n_tokens"].to_numpy()
                wide = ids.astype("<u4")
                crcs = [zlib.crc32(wide[s:s + n]) for s, n in zip(starts, counts, strict=True)]
                yield pa.record_batch([table["doc_id"].combine_chunks(), pa.array(starts), pa.array(counts),
                                       pa.array(crcs, pa.int64()), pa.array([name.rsplit("/", 1)[-1]] * len(crcs), pa.string())],
                                      names=["doc_id", "at", "n_tokens", "ids_crc32", "shard"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    # written once, so that the shards are read once
    docs = keep(files.mapInArrow(documents, "doc_id long, at long, n_tokens long, ids_crc32 long, shard string"), "shard-documents")
    # Spark's names, part-<partition>-<job>-c<file>.<kind>: the numbers have more digits when there are many
    number = lambda pattern: F.regexp_extract("shard", pattern, 1).try_cast("long")
    before = Window.orderBy(number(r"^part-(\d+)"), number(r"-c(\d+)(?:\.|$)"), "shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = (docs.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
             .select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    return docs.join(bases, "shard").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens",
                                            "ids_crc32", "shard")
