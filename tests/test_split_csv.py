"""Multi-line CSV over many splits against Python's csv module."""

from __future__ import annotations

import csv
import random

import pytest

from cohortlab.session import scratch_dir
from cohortlab.sources import files, split_csv


@pytest.fixture
def splits(spark):
    """Splits of a few dozen bytes."""
    names = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": None}
    old = {k: spark.conf.get(k) for k in names}

    def set_to(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield set_to
    for k, v in old.items():
        spark.conf.set(k, v)


def _texts(seed, n):
    rnd = random.Random(seed)
    pick = ["word", "a b", '"', '""', "\n", "\n\n", ",", "\r\n", "é", "x" * 40, '"quoted"', "end.", "'", "\\"]
    return ["".join(rnd.choice(pick) for _ in range(rnd.randrange(1, 9))) for _ in range(n)]


def _write(folder, name, rows, end="\n"):
    import os
    path = folder.removeprefix("file:")
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator=end, quoting=csv.QUOTE_MINIMAL).writerows(rows)
    return path


@pytest.mark.parametrize("size", [16, 64, 1000, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_match_plain_parser(spark, splits, size, end):
    rows = [[str(i), t, "z"] for i, t in enumerate(_texts(size, 120)) if t.strip()]
    path = _write(scratch_dir(spark, "split-csv"), "notes.csv", [["id", "text", "tail"], *rows], end)
    splits(size)
    got = files.read_csv(spark, path, "text string, id long", multi_line=True)
    assert sorted((r["id"], r["text"]) for r in got.collect()) == sorted((int(i), t) for i, t, _ in rows)
    if size < 100:
        assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() > 3


def test_long_records_span_many_blocks(spark, splits):
    long = "line with \"quotes\", and commas\n" * 400
    rows = [["1", "short"], ["2", long], ["3", long + "end"], ["4", "after"]]
    folder = scratch_dir(spark, "split-csv")
    path = _write(folder, "a.csv", [["id", "text"], *rows])
    _write(folder, "b.csv", [["id", "text"], ["5", "other\nfile"], ["6", long]])
    splits(500)
    got = files.read_csv(spark, path, "id long, text string", multi_line=True)
    want = [(int(i), t) for i, t in rows] + [(5, "other\nfile"), (6, long)]
    assert sorted((r["id"], r["text"]) for r in got.collect()) == want


def test_same_rows_as_the_one_task_reader(spark, splits):
    """Blank lines, rows of another width, a missing last line break, values that do not fit."""
    import os
    folder = scratch_dir(spark, "split-csv").removeprefix("file:")
    os.makedirs(folder)
    text = 'id,text\n1,"a\nb"\n\n2,short\n3\n4,"x",extra\nno number,"c ""d"" e"\n5,"last\nline"'
    with open(f"{folder}/t.csv", "w") as f:
        f.write(text)
    splits(9)
    got = sorted(map(tuple, files.read_csv(spark, folder, "id long, text string", multi_line=True).collect()), key=str)
    plain = spark.read.options(**dict(files.CSV_READ_OPTIONS, header="true", multiLine="true")).csv(folder)
    want = sorted(((None if r["id"] == "no number" else int(r["id"]), r["text"]) for r in plain.collect()), key=str)
    assert got == want == sorted([(1, "a\nb"), (2, "short"), (None, 'c "d" e'), (5, "last\nline")], key=str)
    assert files.bad_values(spark, folder, "id long", multi_line=True).collect()[0]["id"] == 1
    assert files.read_headerless_csv(spark, folder, "a string, b string", multi_line=True).count() == 5


def test_blocks_beyond_the_broadcast_bound(spark, splits, monkeypatch):
    rows = [[str(i), t] for i, t in enumerate(_texts(5, 60)) if t.strip()]
    path = _write(scratch_dir(spark, "split-csv"), "n.csv", [["id", "text"], *rows])
    splits(50)
    monkeypatch.setattr(split_csv, "BROADCAST_BLOCKS", 0)
    got = files.read_csv(spark, path, "id long, text string", multi_line=True)
    assert sorted((r["id"], r["text"]) for r in got.collect()) == sorted((int(i), t) for i, t in rows)


def test_register_tables_with_options(spark):
    path = _write(scratch_dir(spark, "split-csv"), "NOTEEVENTS.csv", [["id", "text"], ["1", "a\nb"]])
    out = files.register_tables(spark, {f"{path}/NOTEEVENTS.csv": ("id long, text string", {"multi_line": True})})
    assert list(out) == ["NOTEEVENTS"] and [tuple(r) for r in spark.table("NOTEEVENTS").collect()] == [(1, "a\nb")]
