"""Readers for the raw parquet tables and the clinical projection over them.

The clinical jobs read MIMIC-shaped tables (ICU stays, diagnoses, chart events,
...).  The test data is a TPC-H-like star schema, so each clinical table is a
fixed projection of it (documented in ``FIXTURES.md``).  Every projection is a
column-pruned scan plus at most one equi-join, so filters above it still reach
the parquet reader.

``VIEW_SQL`` holds the same projections as SQL text; the DuckDB oracle inlines
them as CTEs and the tests check that both forms agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(value: Column, mapping: list[tuple[object, object]], default=None) -> Column:
    """CASE value WHEN k THEN v ... ELSE default END."""
    expr = reduce(lambda acc, kv: acc.when(value == kv[0], F.lit(kv[1])),
                  mapping[1:], F.when(value == mapping[0][0], F.lit(mapping[0][1])))
    return expr.otherwise(F.lit(default))


def _mod_lookup(value: Column, modulus: int, mapping: list[tuple[int, object]], default) -> Column:
    """CASE value % modulus WHEN k THEN v ... ELSE default END, as one constant-array lookup.

    The array literal is folded once, so the expression stays small even after
    the optimizer copies it into every filter pushed below the projection.
    """
    table = dict(mapping)
    arr = F.array(*[F.lit(table.get(i, default)).cast("string") for i in range(modulus)])
    m = value % modulus
    return F.when(m >= 0, F.element_at(arr, (m + 1).cast("int"))).otherwise(F.lit(default).cast("string"))


def _line_orders(spark: SparkSession, sf_dir: str, *line_cols: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", *line_cols)
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(od, li.l_orderkey == od.o_orderkey)


def icustays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_orders(spark, sf_dir, "l_shipdate").select(
        F.col("o_custkey").alias("subject_id"), F.col("l_orderkey").alias("hadm_id"),
        F.to_date("l_shipdate").alias("intime"))


_DIAG_CODES = [(0, "99592"), (1, "78552"), (2, "0389"), (3, "486"), (4, "5990"), (5, "49121"), (6, "5849"),
               (7, "4589"), (8, "2874"), (9, "570"), (10, "5695"), (11, None)]


def diagnoses_icd(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = _mod_lookup(F.col("l_partkey"), 24, _DIAG_CODES, "4019")
    return _line_orders(spark, sf_dir, "l_partkey", "l_linenumber").select(
        F.col("o_custkey").alias("subject_id"), F.col("l_orderkey").alias("hadm_id"),
        F.col("l_linenumber").alias("seq_num"), code.cast("string").alias("icd9_code"))


def procedures_icd(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = _mod_lookup(F.col("l_suppkey"), 10, [(0, "9670"), (1, "9671"), (2, "9672"), (3, "967")], "3893")
    return _line_orders(spark, sf_dir, "l_suppkey").select(
        F.col("o_custkey").alias("subject_id"), F.col("l_orderkey").alias("hadm_id"), code.alias("icd9_code"))


def chartevents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    even = F.col("event_id") % 2 == 0
    itemid = (F.when(F.col("event_id") % 7 == 0, F.lit(999999))
              .when(F.col("event_type") == "click", F.when(even, F.lit(211)).otherwise(F.lit(220045)))
              .when(F.col("event_type") == "view", F.when(even, F.lit(442)).otherwise(F.lit(224167)))
              .when(F.col("event_type") == "purchase", F.lit(228234))
              .when(F.col("event_type") == "signup", F.lit(228232))
              .otherwise(F.lit(226329)))
    valuenum = F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("value"))
    return ev.select(F.col("user_id").alias("subject_id"), F.col("ts").alias("charttime"),
                     itemid.alias("itemid"), valuenum.alias("valuenum"))


def labevents(spark: SparkSession, sf_dir: str) -> DataFrame:
    od = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    name = _case(F.col("o_orderpriority"), [("1-URGENT", "Glucose"), ("2-HIGH", "Fasting Glucose"),
                                            ("3-MEDIUM", "glucose"), ("5-LOW", "Sodium")], "Glucose, Serum")
    return od.select(F.col("o_custkey").alias("subject_id"), F.col("o_orderdate").alias("charttime"),
                     name.alias("test_name"), (F.col("o_totalprice") / 2000).alias("value"))


def noteevents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes with their chart date and, for three of four, a chart time up to two days later."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    later = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30 + F.col("doc_id") % 3).cast("int"))
    charttime = F.when(F.col("doc_id") % 4 != 0, F.concat(later.cast("string"), F.lit(" 19:08:00")))
    return docs.select((F.col("doc_id") % 150).alias("subject_id"),
                       F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("chartdate"),
                       charttime.alias("charttime"), F.col("doc_id").alias("note_id"), "text")


def patient_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = read_table(spark, sf_dir, "events").select("user_id").distinct()
    uid = F.col("user_id")
    return users.select(uid.alias("subject_id"),
                        F.date_add(F.lit("2024-01-15").cast("date"), (uid % 15).cast("int")).alias("max_date"),
                        F.when(uid % 3 == 0, F.lit(1)).otherwise(F.lit(0)).alias("angus"),
                        (F.lit(20) + uid % 70).alias("first_admit_age"))


def medications(spark: SparkSession, sf_dir: str) -> DataFrame:
    med = _mod_lookup(F.col("l_partkey"), 40, [(0, "Lantus"), (1, "insulin NPH"), (2, "Metformin"), (3, "glyburide")],
                      "aspirin")
    return _line_orders(spark, sf_dir, "l_partkey", "l_shipdate").select(
        F.col("o_custkey").alias("subject_id"), F.to_date("l_shipdate").alias("med_date"), med.alias("medicine"))


def dm_diagnoses(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = _mod_lookup(F.col("l_partkey"), 60, [(0, "250.00"), (1, "250.02"), (2, "250.01"), (3, "790.21")], "401.9")
    return _line_orders(spark, sf_dir, "l_partkey", "l_shipdate").select(
        F.col("o_custkey").alias("subject_id"), F.to_date("l_shipdate").alias("dx_date"), code.alias("code"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    """Predictions; one row in 13 has no score, one in 17 a NaN score, one in 19 no predicted class."""
    r, i = (F.col("doc_id") * 37) % 100, F.col("doc_id")
    p = (F.when(i % 13 == 5, F.lit(None)).when(i % 17 == 5, F.lit(float("nan"))).otherwise(r.cast("double") / 100))
    return lab.select("doc_id", F.col("quality").alias("y"), p.cast("double").alias("p"),
                      F.when(i % 19 == 5, F.lit(None)).when(r >= 50, F.lit(1)).otherwise(F.lit(0)).alias("h"))


VIEWS = {
    "icustays": icustays,
    "diagnoses_icd": diagnoses_icd,
    "procedures_icd": procedures_icd,
    "chartevents": chartevents,
    "labevents": labevents,
    "noteevents": noteevents,
    "patient_anchor": patient_anchor,
    "medications": medications,
    "dm_diagnoses": dm_diagnoses,
    "predictions": predictions,
}


class Clinical:
    """Lazy accessor for the clinical views of one data folder: ``Clinical(spark, d).icustays``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return VIEWS[name](self.spark, self.sf_dir)
        raise AttributeError(name)

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)


# Same projections as SQL (DuckDB and Spark SQL both run these unchanged).
VIEW_SQL = {
    "icustays": "SELECT o_custkey AS subject_id, l_orderkey AS hadm_id, cast(l_shipdate AS date) AS intime "
                "FROM lineitem JOIN orders ON l_orderkey=o_orderkey",
    "diagnoses_icd": "SELECT o_custkey AS subject_id, l_orderkey AS hadm_id, l_linenumber AS seq_num, "
                     "CASE l_partkey % 24 WHEN 0 THEN '99592' WHEN 1 THEN '78552' WHEN 2 THEN '0389' WHEN 3 THEN '486' "
                     "WHEN 4 THEN '5990' WHEN 5 THEN '49121' WHEN 6 THEN '5849' WHEN 7 THEN '4589' WHEN 8 THEN '2874' "
                     "WHEN 9 THEN '570' WHEN 10 THEN '5695' WHEN 11 THEN NULL ELSE '4019' END AS icd9_code "
                     "FROM lineitem JOIN orders ON l_orderkey=o_orderkey",
    "procedures_icd": "SELECT o_custkey AS subject_id, l_orderkey AS hadm_id, CASE l_suppkey % 10 WHEN 0 THEN '9670' "
                      "WHEN 1 THEN '9671' WHEN 2 THEN '9672' WHEN 3 THEN '967' ELSE '3893' END AS icd9_code "
                      "FROM lineitem JOIN orders ON l_orderkey=o_orderkey",
    "chartevents": "SELECT user_id AS subject_id, ts AS charttime, CASE WHEN event_id % 7 = 0 THEN 999999 "
                   "WHEN event_type='click' THEN CASE WHEN event_id % 2 = 0 THEN 211 ELSE 220045 END "
                   "WHEN event_type='view' THEN CASE WHEN event_id % 2 = 0 THEN 442 ELSE 224167 END "
                   "WHEN event_type='purchase' THEN 228234 WHEN event_type='signup' THEN 228232 ELSE 226329 END AS itemid, "
                   "CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS valuenum FROM events",
    "labevents": "SELECT o_custkey AS subject_id, o_orderdate AS charttime, CASE o_orderpriority WHEN '1-URGENT' THEN "
                 "'Glucose' WHEN '2-HIGH' THEN 'Fasting Glucose' WHEN '3-MEDIUM' THEN 'glucose' WHEN '5-LOW' THEN "
                 "'Sodium' ELSE 'Glucose, Serum' END AS test_name, o_totalprice/2000 AS value FROM orders",
    "noteevents": "SELECT doc_id % 150 AS subject_id, cast(date '2024-01-01' + cast(doc_id % 30 AS int) AS date) "
                  "AS chartdate, CASE WHEN doc_id % 4 <> 0 THEN cast(cast(date '2024-01-01' + cast(doc_id % 30 + doc_id % 3 AS int) "
                  "AS date) AS varchar) || ' 19:08:00' END AS charttime, doc_id AS note_id, text FROM documents",
    "patient_anchor": "SELECT user_id AS subject_id, cast(date '2024-01-15' + cast(user_id % 15 AS int) AS date) "
                      "AS max_date, CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END AS angus, 20 + user_id % 70 AS "
                      "first_admit_age FROM (SELECT DISTINCT user_id FROM events) u",
    "medications": "SELECT o_custkey AS subject_id, cast(l_shipdate AS date) AS med_date, CASE l_partkey % 40 WHEN 0 "
                   "THEN 'Lantus' WHEN 1 THEN 'insulin NPH' WHEN 2 THEN 'Metformin' WHEN 3 THEN 'glyburide' ELSE "
                   "'aspirin' END AS medicine FROM lineitem JOIN orders ON l_orderkey=o_orderkey",
    "dm_diagnoses": "SELECT o_custkey AS subject_id, cast(l_shipdate AS date) AS dx_date, CASE l_partkey % 60 WHEN 0 "
                    "THEN '250.00' WHEN 1 THEN '250.02' WHEN 2 THEN '250.01' WHEN 3 THEN '790.21' ELSE '401.9' END "
                    "AS code FROM lineitem JOIN orders ON l_orderkey=o_orderkey",
    "predictions": "SELECT doc_id, quality AS y, CASE WHEN doc_id % 13 = 5 THEN NULL WHEN doc_id % 17 = 5 THEN "
                   "cast('NaN' AS double) ELSE cast((doc_id * 37) % 100 AS double)/100 END AS p, CASE WHEN doc_id % 19 = 5 "
                   "THEN NULL WHEN (doc_id * 37) % 100 >= 50 THEN 1 ELSE 0 END AS h FROM labels",
}


def with_views(sql: str, *views: str) -> str:
    """Prefix ``sql`` with the CTEs of the named clinical views (for the DuckDB oracle)."""
    ctes = ",\n".join(f"{v} AS ({VIEW_SQL[v]})" for v in views)
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":  # merge the query's own CTE list into ours
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
