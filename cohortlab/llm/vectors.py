"""Valid vectors and their distinct representatives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(embedding: str = "embedding") -> Column:
    """Not null, not zero, and every component a finite number."""
    e = F.col(embedding)
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(e.isNotNull() & finite & F.exists(e, lambda x: x != 0), F.lit(False))


def typed(rows: DataFrame, *others: Column) -> DataFrame:
    """vec_id, embedding (array of doubles) and ``others``."""
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), *others)
