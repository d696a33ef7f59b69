"""Registered queries: CSV / Parquet round trips and date parsing.

Round trips write into the session's shared scratch folder (``spark.checkpoint.dir``)
and read the files back, so the returned DataFrame is the re-read table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlab.functions.expressions import parse_iso_date, parse_us_date
from cohortlab.plans import q_cohort, q_vitals
from cohortlab.plans.catalog import ORACLES, register
from cohortlab.session import scratch_dir
from cohortlab.sources import files
from cohortlab.sources.tables import Clinical, with_views


@register("scan_csv", with_views(
    "SELECT subject_id, CASE WHEN note_id % 7 <> 0 THEN chartdate END AS chartdate, charttime, note_id, text FROM noteevents",
    "noteevents"))
def scan_csv(spark, d):
    """Notes (multi-line text with quotes) as CSV with the columns in another order and dates that are none, read by name."""
    notes = Clinical(spark, d).noteevents
    mixed = notes.select("text", "charttime", F.when(F.col("note_id") % 7 == 0, F.lit("no date")).otherwise(
        F.col("chartdate").cast("string")).alias("chartdate"), "note_id", "subject_id")
    path = files.write_csv(mixed, scratch_dir(spark, "notes-csv"))
    return files.read_csv(spark, path, notes.schema, multi_line=True)


@register("sink_csv_roundtrip", ORACLES["sepsis_date"])
def sink_csv_roundtrip(spark, d):
    df = q_cohort.sepsis_date(spark, d)
    path = files.write_csv(df, scratch_dir(spark, "sepsis-csv"))
    return files.read_csv(spark, path, df.schema)


@register("sink_parquet_roundtrip", ORACLES["vitals_features"])
def sink_parquet_roundtrip(spark, d):
    path = files.write_parquet(q_vitals.vitals_features(spark, d), scratch_dir(spark, "features-parquet"))
    return files.read_parquet(spark, path)


@register("parse_dates", with_views(
    "SELECT subject_id, max_date, strftime(max_date, '%-m/%-d/%Y') AS us_text, max_date AS us_date, "
    "strftime(max_date, '%Y-%m-%d') || ' 19:08:00' AS iso_text, max_date AS iso_date FROM patient_anchor",
    "patient_anchor"))
def parse_dates(spark, d):
    """Anchor dates rendered as ``M/d/yyyy`` and ``yyyy-MM-dd HH:mm:ss`` text and parsed back."""
    p = Clinical(spark, d).patient_anchor.select("subject_id", "max_date")
    txt = p.select("subject_id", "max_date", F.date_format("max_date", "M/d/yyyy").alias("us_text"),
                   F.concat(F.date_format("max_date", "yyyy-MM-dd"), F.lit(" 19:08:00")).alias("iso_text"))
    return txt.select("subject_id", "max_date", "us_text", parse_us_date("us_text").alias("us_date"),
                      "iso_text", parse_iso_date("iso_text").alias("iso_date"))

