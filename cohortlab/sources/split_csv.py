"""Multi-line CSV read by many tasks.

A line break ends a record only outside quotes, so whether a line begins a record depends on the
number of quotes before it in the file.  Spark reads the file's lines in splits;

1. a first pass counts the quotes of each block (file and start of the split), and running sums
   over these few rows tell for each block whether it begins inside a quoted field;
2. a second pass assembles records block by block, in the order of the file.  What a block holds of
   the record before it and of the one it leaves open, two fragments at most, is shuffled and joined.

Records then go through Spark's own CSV parser, a row each.  This needs RFC 4180 files: a literal quote
stands doubled inside a quoted field, and nowhere else.  ``\\r\\n`` and ``\\n`` both end a record; blank lines are
skipped; line breaks inside quotes stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of the block table that may be broadcast (the table is counted first); beyond it the lines are joined to it.
BROADCAST_BLOCKS = 200_000

_OUT = "file string, block long, part int, first boolean, closes boolean, text string"
_FIELDS = ["file", "block", "part", "first", "closes", "text"]
_KINDS = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.string()]
#: Parts: the end or middle of a record that began in an earlier block, a whole record, the beginning of one left open.
_REST, _WHOLE, _OPEN = 0, 1, 2


class _Block:
    """Records of one block, from its lines in order."""

    def __init__(self, file: str, block: int, inside: bool):
        self.file, self.block, self.inside = file, block, inside
        self.part = _REST if inside else _WHOLE
        self.lines: list[str] = []
        self.first = block == 0

    def add(self, line: str, odd: bool) -> tuple | None:
        self.lines.append(line)
        self.inside ^= odd
        if self.inside:
            return None
        row = (self.file, self.block, self.part, self.first and self.part == _WHOLE, True, "\n".join(self.lines))
        self.lines = []
        if self.part == _WHOLE and not row[-1].strip("\r"):
            return None  # a blank line
        self.first &= self.part != _WHOLE
        self.part = _WHOLE
        return row

    def end(self) -> tuple | None:
        """The record left open."""
        if not self.lines:
            return None
        return (self.file, self.block, _REST if self.part == _REST else _OPEN, self.first, False, "\n".join(self.lines))


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Block | None = None
    for batch in batches:
        out = []
        odd = pc.bit_wise_and(pc.count_substring(batch.column("value"), '"'), 1).to_pylist()
        for file, block, inside, line, o in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "inside", "value")), odd, strict=True):
            if now is None or (now.file, now.block) != (file, block):
                out.append(now.end() if now else None)
                now = _Block(file, block, inside)
            out.append(now.add(line, bool(o)))
        yield _rows(out)
    if now:
        yield _rows([now.end()])


def _rows(out: list[tuple | None]) -> pa.RecordBatch:
    rows = [r for r in out if r]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(_FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], _FIELDS)


def records(spark: SparkSession, path: str) -> DataFrame:
    """``text, first``: every record of the files at ``path`` as one string; ``first`` marks the first of its file."""
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (lines.groupBy("file", "block").agg(F.sum(quotes).alias("n"))
              .select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) % 2 == 1).alias("inside")))
    if blocks.count() <= BROADCAST_BLOCKS:
        ordered = lines.join(F.broadcast(blocks), ["file", "block"])  # the lines stay in the order of their split
    else:
        numbered = lines.withColumn("at", F.monotonically_increasing_id())
        ordered = numbered.join(blocks, ["file", "block"]).sortWithinPartitions("file", "block", "at")
    parts = ordered.select("file", "block", "inside", "value").mapInArrow(_assemble, _OUT)
    whole = parts.where(F.col("part") == _WHOLE).select("text", "first")
    # at most two fragments a block: the rest of an open record, then the next open one
    own = Window.partitionBy("file").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = parts.where(F.col("part") != _WHOLE).withColumn("record", F.sum((F.col("part") == _OPEN).cast("int")).over(own))
    joined = (cut.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "part", "text", "first"))).alias("own"))
              .select(F.array_join(F.transform("own", lambda p: p["text"]), "\n").alias("text"), F.exists("own", lambda p: p["first"]).alias("first")))
    return whole.unionByName(joined)


def read_text_columns(spark: SparkSession, path: str, names: list[str], header: bool, options: dict[str, str]) -> DataFrame:
    """The columns ``names`` of the files as text; records with another number of fields are dropped."""
    rows = records(spark, path)
    rows = rows.where(~F.col("first")) if header else rows
    schema = ", ".join([*(f"`{n}` string" for n in names), "_whole_record string"])
    own = {k: v for k, v in options.items() if k not in ("mode", "header", "inferSchema")}
    own |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_whole_record", "multiLine": "true", "maxCharsPerColumn": "-1"}
    parsed = rows.select(F.from_csv(F.regexp_replace("text", r"\r$", ""), F.lit(schema), own).alias("row"))
    return parsed.where("row._whole_record is null").select(*[F.col(f"row.`{n}`").alias(n) for n in names])
