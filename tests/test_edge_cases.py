"""Tiny literal fixtures for the null / date / CSV / pivot semantics."""

from __future__ import annotations

import datetime as dt
import math
import os
import tempfile

from pyspark.sql import functions as F

from cohortlab.functions.codes import NOTE_STOP_WORDS, T2DM_MED, distinct
from cohortlab.functions.expressions import later_of, nan_to_null, parse_iso_date, parse_us_date, prefix_flag
from cohortlab.operators import vitals
from cohortlab.session import scratch_dir
from cohortlab.sources import files


def _stats(spark, values):
    df = spark.createDataFrame([(1, "heartRate", v) for v in values], "subject_id long, label string, valuenum double")
    return vitals.vital_stats(df.withColumn("valuenum", nan_to_null("valuenum"))).collect()[0]


def test_single_row_std_is_null_then_zero(spark):
    r = _stats(spark, [1.0])
    assert r["valuenum_std"] is None and r["valuenum_median"] == 1.0 and r["valuenum_len"] == 1


def test_null_among_values_counts_rows(spark):
    r = _stats(spark, [2.0, 4.0, None])
    assert r["valuenum_median"] == 3.0 and r["valuenum_mean"] == 3.0 and r["valuenum_len"] == 3


def test_nan_is_missing(spark):
    r = _stats(spark, [2.0, float("nan")])
    assert r["valuenum_median"] == 2.0 and r["valuenum_len"] == 2
    raw = spark.createDataFrame([(2.0,), (float("nan"),)], "v double").agg(F.median("v")).collect()[0][0]
    assert math.isnan(raw)  # without the NaN -> NULL step


def test_later_of_null_semantics(spark):
    d1, d2 = dt.date(2020, 1, 1), dt.date(2020, 1, 2)
    df = spark.createDataFrame([(d1, d2), (None, d2), (d1, None)], "a date, b date")
    got = [r[0] for r in df.select(later_of("a", "b")).collect()]
    assert got == [d2, d2, None]


def test_bad_dates_become_null(spark):
    df = spark.createDataFrame([("garbage",), ("2101-10-20 19:08:00",), ("1/2/2101",)], "s string")
    got = df.select(parse_iso_date("s").alias("iso"), parse_us_date("s").alias("us")).collect()
    assert got[0]["iso"] is None and got[0]["us"] is None
    assert got[1]["iso"] == dt.date(2101, 10, 20)
    assert got[2]["us"] == dt.date(2101, 1, 2)


def test_prefix_flag_null_and_short_codes(spark):
    df = spark.createDataFrame([("9670",), ("967",), (None,), ("96721",)], "c string")
    got = [r[0] for r in df.select(prefix_flag("c", {4: ["9670", "9672"]})).collect()]
    assert got == [1, 0, 0, 1]


def test_quoted_multiline_csv_and_malformed_rows(spark):
    d = tempfile.mkdtemp(prefix="cohortlab-csv-")
    path = os.path.join(d, "NOTEEVENTS.csv")
    with open(path, "w") as f:
        f.write('ROW_ID,SUBJECT_ID,TEXT\n')
        f.write('1,10,"first line\nsecond ""quoted"" line"\n')
        f.write('2,11,plain note\n')
        f.write('3,12,too,many,fields\n')
        f.write('4\n')
    df = files.load_csv_as_table(spark, path, "ROW_ID long, SUBJECT_ID long, TEXT string", multi_line=True)
    rows = sorted(df.collect(), key=lambda r: r["ROW_ID"])
    assert [r["ROW_ID"] for r in rows] == [1, 2]
    assert rows[0]["TEXT"] == 'first line\nsecond "quoted" line'
    assert spark.sql("SELECT count(*) FROM NOTEEVENTS").collect()[0][0] == 2


def test_table_name_from_path():
    assert files.infer_table_name("/data/mimic/CHARTEVENTS.csv") == "CHARTEVENTS"
    assert files.infer_table_name("wasb://c@a/x/PatientDetailsWithMaxDate.csv") == "PatientDetailsWithMaxDate"
    assert files.infer_table_name("/data/dir/") == "/data/dir/"


def test_anti_join_keeps_null_key(spark):
    left = spark.createDataFrame([(1,), (None,), (3,)], "subject_id long")
    right = spark.createDataFrame([(1,), (None,)], "subject_id long")
    got = sorted(left.join(right, "subject_id", "left_anti").collect(), key=lambda r: (r[0] is not None, r[0]))
    assert [r[0] for r in got] == [None, 3]


def test_all_null_pivot_cell_exists_and_is_zero(spark):
    chart = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 10, 8), 211, 80.0), (1, dt.datetime(2024, 1, 10, 9), 211, 90.0),
         (1, dt.datetime(2024, 1, 10, 9), 442, 120.0), (2, dt.datetime(2024, 1, 10, 9), 442, 110.0)],
        "subject_id long, charttime timestamp_ntz, itemid int, valuenum double")
    pats = spark.createDataFrame([(1, dt.date(2024, 1, 10), 0), (2, dt.date(2024, 1, 10), 0), (3, dt.date(2024, 1, 10), 1)],
                                 "subject_id long, max_date date, angus int")
    out = {r["subject_id"]: r for r in vitals.vitals_features(chart, pats).collect()}
    assert len(out[1]) == 3 + 80
    assert out[1]["lastDay_valuenum_std_manualBP"] == 0 and out[1]["lastDay_valuenum_len_manualBP"] == 1
    assert out[1]["lastDay_valuenum_median_heartRate"] == 85.0
    assert out[3]["history_valuenum_len_heartRate"] == 0  # patient without readings: all zeros


def test_fixed_value_list_sizes():
    assert len(NOTE_STOP_WORDS) == 287 and len(distinct(NOTE_STOP_WORDS)) == 268
    assert len(T2DM_MED) == 33 and len(distinct(T2DM_MED)) == 31


def test_headerless_csv_and_bulk_registration(spark):
    d = tempfile.mkdtemp(prefix="cohortlab-csv2-")
    topics_path = os.path.join(d, "topics.csv")
    with open(topics_path, "w") as f:
        f.write("7,0.25,0.75\n8,1.0,0.0\n")
    df = files.read_headerless_csv(spark, topics_path, "subject_id long, topic_1 double, topic_2 double")
    assert sorted(tuple(r) for r in df.collect()) == [(7, 0.25, 0.75), (8, 1.0, 0.0)]
    labs_path = os.path.join(d, "LABEVENTS.csv")
    with open(labs_path, "w") as f:
        f.write("subject_id,charttime\n1,2101-10-20 19:08:00\n")
    views = files.register_tables(spark, {labs_path: "subject_id long, charttime timestamp_ntz"})
    assert set(views) == {"LABEVENTS"}
    assert spark.sql("SELECT max(to_date(charttime)) FROM LABEVENTS").collect()[0][0] == dt.date(2101, 10, 20)


def test_single_file_sink(spark):
    df = spark.range(10).withColumnRenamed("id", "subject_id")
    out = files.write_single_csv(df, scratch_dir(spark, "single"))
    back = files.read_csv(spark, out, "subject_id long")
    assert back.count() == 10 and len([f for f in back.inputFiles() if f.endswith(".csv")]) == 1


def test_csv_columns_by_name_and_bad_values(spark):
    path = scratch_dir(spark, "csv")
    spark.createDataFrame([("valuenum,subject_id,charttime",), ("1.5,1,2101-01-01 08:00:00",), ("abc,2,2101-01-02 08:00:00",),
                           (",3,not a time",), ("1,2",)], "value string").repartition(1).write.text(path)
    schema = "subject_id long, charttime timestamp_ntz, valuenum double"
    df = files.read_csv(spark, path, schema)
    rows = {r["subject_id"]: r for r in df.collect()}
    assert set(rows) == {1, 2, 3} and rows[1]["valuenum"] == 1.5 and rows[2]["valuenum"] is None and rows[3]["charttime"] is None
    assert {df.count(), df.select("subject_id").count(), df.select("valuenum").count(), len(df.select("charttime").collect())} == {3}
    bad = files.bad_values(spark, path, schema).collect()[0]
    assert (bad["subject_id"], bad["charttime"], bad["valuenum"]) == (0, 1, 1)



def test_approx_median_close_to_exact(spark):
    df = spark.createDataFrame([(1, "heartRate", float(v)) for v in range(1, 102)],
                               "subject_id long, label string, valuenum double")
    exact = vitals.vital_stats(df).collect()[0]["valuenum_median"]
    approx = vitals.vital_stats(df, approx_median=True).collect()[0]["valuenum_median"]
    assert exact == 51.0 and abs(approx - exact) <= 1.0


def test_sepsis_forms_agree_on_null_stay_time(spark):
    from cohortlab.operators import cohort
    dx = spark.createDataFrame([(1, 10, "99592"), (2, 20, "99592")], "subject_id long, hadm_id long, icd9_code string")
    px = spark.createDataFrame([], "subject_id long, hadm_id long, icd9_code string")
    st = spark.createDataFrame([(1, 10, None), (2, 20, dt.date(2024, 1, 2))], "subject_id long, hadm_id long, intime date")
    a = sorted(tuple(r) for r in cohort.sepsis_date(dx, px, st).collect())
    b = sorted(tuple(r) for r in cohort.sepsis_date(dx, px, st, one_pass=False).collect())
    assert a == b == [(1, None), (2, dt.date(2024, 1, 2))]


def test_notes_concat_order_and_null_notes(spark):
    from cohortlab.operators import notes
    df = spark.createDataFrame(
        [(1, dt.date(2024, 1, 2), 5, "second"), (1, dt.date(2024, 1, 1), 9, "first"), (1, dt.date(2024, 1, 2), 3, None),
         (2, dt.date(2024, 1, 1), 1, None)],
        "subject_id long, chartdate date, note_id long, text string")
    got = {r["subject_id"]: r["text"] for r in notes.notes_concat(df).collect()}
    assert got == {1: "first second"}  # NULL notes are dropped, not joined as "null"
