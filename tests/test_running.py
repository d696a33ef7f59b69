"""Running sums, order statistics and the quantile sketch against plain Python, with a hot group."""

from __future__ import annotations

import bisect
import math
import random
import statistics

from pyspark.sql import functions as F

from cohortlab.operators import running, vitals


def _hot(spark, n=30_000):
    """A third of all rows in one group, all values distinct; many small groups; a null group; missing values."""
    rnd = random.Random(7)
    rows = [("hot", i * 0.37 + rnd.random() / 10, 1) for i in range(n // 3)]
    rows += [(f"g{rnd.randrange(400)}" if rnd.random() < 0.95 else None, rnd.choice([None, round(rnd.gauss(80, 9), 1)]), rnd.randrange(1, 9)) for _ in range(2 * n // 3)]
    rnd.shuffle(rows)
    return rows, spark.createDataFrame(rows, "g string, valuenum double, n long").repartition(6)


def test_exact_statistics_of_a_hot_group(spark):
    rows, df = _hot(spark)
    by: dict = {}
    for g, v, n in rows:
        by.setdefault(g, []).append((v, n))
    got = {r["g"]: r for r in vitals.stats_of_counts(df, ["g"]).collect()}
    assert got.keys() == by.keys()
    for g, own in by.items():
        values = [v for v, n in own if v is not None for _ in range(n)]
        r = got[g]
        assert r["valuenum_len"] == sum(n for _, n in own)
        assert r["valuenum_median"] == statistics.median(values)
        assert math.isclose(r["valuenum_mean"], statistics.fmean(values), rel_tol=1e-12)
        assert math.isclose(r["valuenum_std"], statistics.stdev(values), rel_tol=1e-9)


def test_hot_group_is_cut_into_ranges(spark):
    _, df = _hot(spark)
    ranged = df.repartitionByRange(8, "g", "valuenum").withColumn("r", F.spark_partition_id())
    assert ranged.where("g = 'hot'").select("r").distinct().count() >= 3


def test_groups_without_a_value_and_with_one(spark):
    df = spark.createDataFrame([("none", None, 3), ("one", 2.5, 1), ("two", 1.0, 1), ("two", 4.0, 1), (None, 7.0, 2)], "g string, valuenum double, n long")
    for approx in (False, True):
        got = {r["g"]: tuple(r)[1:] for r in vitals.stats_of_counts(df, ["g"], approx_median=approx).collect()}
        assert got["none"] == (None, None, None, None, 3) and got["one"] == (2.5, 2.5, 2.5, None, 1)
        assert got[None] == (7.0, 7.0, 7.0, 0.0, 2) and got["two"][2] == 2.5
        assert vitals.stats_of_counts(df.where("false"), ["g"], approx_median=approx).collect() == []


def test_sketch_rank_error_on_heavy_ties(spark):
    rnd = random.Random(3)
    heavy = [("t", float(v), w) for v, w in ((1, 9000), (5, 1), (7, 1), (9, 8990))] + [("t", 20 + rnd.random(), 1) for _ in range(4000)]
    even = [("e", rnd.random(), 1) for _ in range(50_000)]
    nine = [("n", 1.0, 9), ("n", 5.0, 1), ("n", 7.0, 1)]
    df = spark.createDataFrame(heavy + even + nine, "g string, valuenum double, n long")
    probs = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    for points in (20, 1000):
        got = {r["g"]: r for r in running.weighted_quantiles(df, ["g"], probs, points=points).collect()}
        for g, own in (("t", heavy), ("e", even), ("n", nine)):
            flat = sorted(v for _, v, w in own for _ in range(w))
            for name, p in probs.items():
                v, n = got[g][name], len(flat)
                low, high = bisect.bisect_left(flat, v) + 1, bisect.bisect_right(flat, v)
                off = 0 if low <= math.ceil(p * n) <= high else min(abs(low - p * n), abs(high - p * n))
                assert off <= n / points + 1, (g, name, off)
    assert got["n"]["p50"] == 1.0


def test_sketch_does_not_depend_on_partitions(spark):
    _, df = _hot(spark, 6000)
    one, many = (sorted(running.weighted_quantiles(f, ["g"], {"m": 0.5}, points=50).collect(), key=str) for f in (df.coalesce(1), df.repartition(13)))
    assert one == many


def test_running_meter_and_numbers(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice([1.5, 2.0, 8.25]), rnd.randrange(0, 4)) for i in range(5000)]
    df = spark.createDataFrame(rows, "batch long, val double, n long").repartition(7)
    total, count, want = 0.0, 0, []
    for i, v, n in rows:
        total, count = total + v * n, count + n
        want.append((i, v, n, total, count, total / count if count else None))
    assert [tuple(r) for r in running.running_meter(df, [F.col("batch")]).orderBy("batch").collect()] == want
    numbered = running.dense_numbers(df, [F.col("val").desc(), F.col("batch")])
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert [(r["batch"], r["idx"]) for r in numbered.orderBy("idx").collect()] == [(r[0], k) for k, r in enumerate(order)]
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Exchange SinglePartition" in x and "_add_" in x]


def test_chunks_of_a_hot_patient(spark):
    """A patient with a third of all notes is many chunks over several ranges; the chunks join to the whole text."""
    from cohortlab.operators import notes
    rnd = random.Random(2)
    rows = [(1 if i % 3 == 0 else rnd.randrange(2, 40), f"2024-01-{1 + i % 28:02d}", i, None if i % 41 == 0 else "é" * rnd.randrange(0, 60)) for i in range(3000)]
    df = spark.createDataFrame(rows, "subject_id long, chartdate string, note_id long, text string").repartition(5)
    chunks = notes.note_chunks(df, chunk_bytes=500)
    whole: dict = {}
    for s, _, _, t in sorted((r for r in rows if r[3] is not None), key=lambda r: (r[0], r[1], r[2])):
        whole.setdefault(s, []).append(t)
    whole = {s: " ".join(t) for s, t in whole.items()}
    got = chunks.collect()
    assert {r["subject_id"]: r["text"] for r in notes.text_of_chunks(chunks).collect()} == whole
    assert len([r for r in got if r["subject_id"] == 1]) > 50 and max(len(r["text"].encode()) for r in got) < 500 + 121
    for r in got:
        part = r["text"].encode()
        assert whole[r["subject_id"]].encode()[r["offset"]:r["offset"] + len(part)] == part
