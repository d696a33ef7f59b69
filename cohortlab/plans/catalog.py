"""Registry of named queries (Spark) and their DuckDB oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the whole test tables.
The oracle is an ANSI SQL text over the raw tables (clinical views inlined as
CTEs).  Floating results are rounded to 6 places on both sides so that
summation order cannot change a value hash; column names match exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def r6(c) -> "F.Column":
    """Round to 6 decimals as ``round(x * 1e6) / 1e6`` in double arithmetic.

    That is how the SQL oracle rounds a double; rounding the exact decimal
    value instead differs on rare near-ties, so both sides use the same form.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double") * F.lit(1e6)) / F.lit(1e6)


def load_all() -> None:
    """Import every query module so that its ``@register`` calls run."""
    from cohortlab.plans import q_cohort, q_metrics, q_notes, q_phenotype, q_vitals, q_io, q_models  # noqa: F401
