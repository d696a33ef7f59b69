"""File sources and sinks: CSV tables (quoted, optionally multi-line), Parquet tables, temp views.

CSV columns are found by their header names and read as text; rows with the
wrong number of fields are dropped, whatever columns are asked for, and a value
that does not fit its column's type becomes NULL (``bad_values`` counts them).
A doubled quote inside a quoted field is a literal quote.  Quoted fields may
span lines only with ``multi_line=True``; such files too are split over tasks
(``split_csv.py``).  Sinks write a directory of part
files; ``write_single_csv`` is the explicit exception.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cohortlab.sources import split_csv

# fixed value: the table-name rule
_TABLE_NAME = re.compile(r"(\w+)(\.csv)?$")

CSV_READ_OPTIONS = {
    "escape": '"',
    "quote": '"',
    "sep": ",",
    "mode": "DROPMALFORMED",
    "inferSchema": "false",
    "columnPruning": "false",  # a row is whole or dropped, not judged by the columns that a query reads
}

CSV_WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',
    "quote": '"',
    "sep": ",",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}


def infer_table_name(path: str) -> str:
    """Table name from a file path: the last word before an optional ``.csv``; else the path itself."""
    m = _TABLE_NAME.search(path)
    return m.group(1) if m else path


def _struct(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def read_csv_text(spark: SparkSession, path: str, schema: StructType | str, header: bool = True,
                  multi_line: bool = False, **options: str) -> DataFrame:
    """The columns of ``schema`` as text, found by header name (by position without a header)."""
    fields = _struct(schema).fields
    reader = spark.read.options(**dict(CSV_READ_OPTIONS, header=str(header).lower(), multiLine=str(multi_line).lower(), **options))
    if multi_line:
        names = [f.name for f in fields] if not header else reader.csv(path).columns
        raw = split_csv.read_text_columns(spark, path, names, header, CSV_READ_OPTIONS | options)
        if not header:
            return raw
    elif not header:
        return reader.schema(StructType([StructField(f.name, StringType()) for f in fields])).csv(path)
    else:
        raw = reader.csv(path)
    missing = [f.name for f in fields if f.name.lower() not in {c.lower() for c in raw.columns}]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return raw.select(*[F.col(f"`{f.name}`").alias(f.name) for f in fields])


def read_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True,
             multi_line: bool = False, **options: str) -> DataFrame:
    """A typed CSV table: every structurally whole row, with NULL where a value does not fit its type."""
    raw = read_csv_text(spark, path, schema, header, multi_line, **options)
    return raw.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in _struct(schema).fields])


def bad_values(spark: SparkSession, path: str, schema: StructType | str, header: bool = True,
               multi_line: bool = False, **options: str) -> DataFrame:
    """One row: per column, the number of values that ``read_csv`` turns to NULL because they do not fit."""
    raw = read_csv_text(spark, path, schema, header, multi_line, **options)
    bad = [F.count_if(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull()).alias(f.name)
           for f in _struct(schema).fields]
    return raw.agg(*bad)


def read_headerless_csv(spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = False) -> DataFrame:
    """A CSV without a header row; the schema gives the column names in order."""
    return read_csv(spark, path, schema, header=False, multi_line=multi_line)


def load_csv_as_table(spark: SparkSession, path: str, schema: StructType | str,
                      table_name: str | None = None, multi_line: bool = False) -> DataFrame:
    """Read a CSV and register it as a temp view named after the file (or ``table_name``)."""
    df = read_csv(spark, path, schema, multi_line=multi_line)
    df.createOrReplaceTempView(table_name or infer_table_name(path))
    return df


def register_tables(spark: SparkSession, tables: dict[str, StructType | str | tuple]) -> dict[str, DataFrame]:
    """Register several CSV files as temp views; returns name -> DataFrame.

    ``tables``: path -> schema, or path -> (schema, options of ``load_csv_as_table``), e.g.
    ``{"NOTEEVENTS.csv": (schema, {"multi_line": True})}``.
    """
    out = {}
    for path, value in tables.items():
        schema, options = value if isinstance(value, tuple) else (value, {})
        out[options.get("table_name") or infer_table_name(path)] = load_csv_as_table(spark, path, schema, **options)
    return out


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **options: str) -> str:
    """Write a directory of CSV part files with a header row (RFC-4180 quoting)."""
    df.write.mode(mode).options(**dict(CSV_WRITE_OPTIONS, **options)).csv(path)
    return path


def write_single_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """One CSV part file, by request: the result is computed in parallel and then written by one task."""
    return write_csv(df.repartition(1), path, mode)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
