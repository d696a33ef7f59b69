"""Code sets as a rule table: ``code_set, prefix, len`` rows, any number of sets and prefixes of any length.

A rule holds for a code whose first ``len`` characters are ``prefix``.  The rules of each length, one row per
prefix, go to every task and meet the rows there in an equi-join: no literal list in the plan, no test per rule,
and the rows stay where they are, so a code that a third of all rows carry, or a missing one, makes no large
task.  What goes to the tasks is the rule table, which does not grow with the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def rule_table(spark: SparkSession, code_sets: dict[str, dict[int, list[str]]]) -> DataFrame:
    """The rules of ``{set: {length: prefixes}}``."""
    rows = [(name, prefix, length) for name, lists in code_sets.items() for length, prefixes in lists.items() for prefix in prefixes]
    return spark.createDataFrame(rows, "code_set string, prefix string, len int")


def with_code_sets(codes: DataFrame, rules: DataFrame, code_col: str = "icd9_code", out: str = "code_sets") -> DataFrame:
    """``codes`` with the sorted array of the sets that each row's code is in; empty for none and for a missing code."""
    none = F.array().cast("array<string>")
    lengths = sorted(r[0] for r in rules.where("len > 0").select("len").distinct().collect())  # one number per length
    found, parts = codes, [none]
    for k in lengths:
        of_prefix = (rules.where(F.col("len") == k).groupBy(F.col("prefix").alias(f"_prefix_{k}"))
                     .agg(F.collect_set("code_set").alias(f"_sets_{k}")))
        found = found.join(F.broadcast(of_prefix), F.substring(code_col, 1, k) == F.col(f"_prefix_{k}"), "left")
        parts.append(F.coalesce(f"_sets_{k}", none))
    return found.select(*codes.columns, F.sort_array(F.array_distinct(F.concat(*parts))).alias(out))


def sets_of_codes(codes: DataFrame, rules: DataFrame, code_col: str = "icd9_code") -> DataFrame:
    """``<code_col>, code_sets``: the sorted sets of each distinct code that is in one."""
    distinct = codes.where(F.col(code_col).isNotNull()).select(code_col).distinct()
    return with_code_sets(distinct, rules, code_col).where(F.size("code_sets") > 0)


def with_flags(codes: DataFrame, rules: DataFrame, sets: list[str], code_col: str = "icd9_code") -> DataFrame:
    """``codes`` with a 0 / 1 column per set of ``sets``."""
    found = with_code_sets(codes, rules, code_col, "_sets")
    return found.select(*codes.columns, *[F.array_contains("_sets", s).cast("int").alias(s) for s in sets])
