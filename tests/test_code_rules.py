"""The rule table against plain ``startswith``."""

from __future__ import annotations

import random

from cohortlab.functions.codes import SEPSIS_CODE_SETS
from cohortlab.operators import code_rules
from cohortlab.session import scratch_dir


def test_ten_thousand_random_prefixes(spark):
    rnd = random.Random(6)
    word = lambda n: "".join(rnd.choice("0123456789EV") for _ in range(n))
    rules = [(f"set{rnd.randrange(300)}", word(rnd.choice([2, 3, 3, 4, 5, 9]))) for _ in range(10_000)]
    hot = rules[0][1] + "00"
    codes = [(i, hot if i % 3 == 0 else None if i % 50 == 1 else word(rnd.randrange(1, 7))) for i in range(3000)]
    table = spark.createDataFrame([(s, p, len(p)) for s, p in rules], "code_set string, prefix string, len int")
    frame = spark.createDataFrame(codes, "id long, icd9_code string")
    got = {r["id"]: r["code_sets"] for r in code_rules.with_code_sets(frame, table).collect()}
    assert got == {i: sorted({s for s, p in rules if c is not None and c.startswith(p)}) for i, c in codes}


def test_length_counts_and_empty_rules(spark):
    """A rule of more characters than its prefix holds only for the code that is just the prefix."""
    table = code_rules.rule_table(spark, {"a": {4: ["486"]}, "b": {2: ["48"]}})
    frame = spark.createDataFrame([(1, "486"), (2, "4860"), (3, None)], "id long, icd9_code string")
    got = {r["id"]: (r["a"], r["b"]) for r in code_rules.with_flags(frame, table, ["a", "b"]).collect()}
    assert got == {1: (1, 1), 2: (0, 1), 3: (0, 0)}
    assert code_rules.with_flags(frame, table.where("false"), ["a"]).agg({"a": "sum"}).collect()[0][0] == 0


def test_rows_are_not_dealt_by_their_code(spark):
    """A code of most rows, and no code at all, must not bring these rows into one task: the rows meet the rules where they are."""
    path = scratch_dir(spark, "codes")
    rows = [(i, None if i % 5 == 1 else "486" if i % 9 == 0 else "4019") for i in range(900)]
    spark.createDataFrame(rows, "id long, icd9_code string").write.parquet(path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = code_rules.with_flags(spark.read.parquet(path), code_rules.rule_table(spark, SEPSIS_CODE_SETS), list(SEPSIS_CODE_SETS))
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = {r["id"]: [r[s] for s in SEPSIS_CODE_SETS] for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == {i: [int(c == "486"), 0, 0, 0] for i, c in rows}
    assert "SortMergeJoin" not in plan and "hashpartitioning(icd9_code" not in plan, plan


def test_sets_of_codes_names_each_code_once(spark):
    table = code_rules.rule_table(spark, {"a": {3: ["486"], 5: ["48600"]}, "b": {2: ["48"], 0: [""]}, "c": {2: ["48"]}})
    frame = spark.createDataFrame([("486",), ("486",), ("48600",), ("99",), (None,)], "icd9_code string")
    got = sorted(tuple(r) for r in code_rules.sets_of_codes(frame, table).collect())
    assert got == [("486", ["a", "b", "c"]), ("48600", ["a", "b", "c"])]
