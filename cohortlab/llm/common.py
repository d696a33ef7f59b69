"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.session import keep

__all__ = ["WORD", "drop_table", "held_out", "keep", "read"]

#: Words: maximal runs of characters other than space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for rows whose crc32 of the id as text leaves 1 on division by 3; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def drop_table(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that no later job reads, in whatever store it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
