from __future__ import annotations

import random
import re

import duckdb

from cohortlab.llm import line_quality, queries

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """Counts by their definition, one text at a time."""
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    base = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered), base)


def texts():
    rnd = random.Random(5)
    out = [None, "", " \t\n", "word", "é" * 30, "a " * 40, "x y " * 25, "one two three four five six seven eight. " * 3,
           "a b c\na b c\n a b c\n\n \nd", "#*$%&|<> " * 30, "A whole sentence of words stands here. " + "y " * 60]
    for _ in range(60):
        words = [rnd.choice("ab") if rnd.random() < 0.7 else f"w{rnd.randrange(9)}." for _ in range(rnd.randrange(1, 120))]
        out.append("".join(w + rnd.choice([" ", "\n", "  ", "\t"]) for w in words))
    return out


PROSE = "The patients came in the morning and left at noon. " * 1 + "None of them stayed over the night, as far as we know."


def test_counts_match_plain_versions(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(3, "again a row of this id"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS _row", "2 AS _text", "3 AS kept", "4 AS r", "5 AS words")
    got = [tuple(r)[:7] for r in line_quality.quality(docs).collect()]
    assert sorted(map(str, got)) == sorted(str((i, *plain(t))) for i, t in rows)
    assert all(not r.kept for r in line_quality.quality(docs).where("base_failed").collect())


def test_whole_operator_keeps_other_columns_and_replaces_its_own(spark):
    docs = spark.createDataFrame([(1, PROSE + "\nhome | news | about | login.", "x", 7)], "doc_id long, text string, kept string, _row int")
    row = line_quality.clean(docs).collect()[0]
    assert row.cleaned == PROSE and row.failed_navigation == 1 and row.kept is True and row["_row"] == 7
    back = line_quality.apply_clean(docs)
    assert back.columns == docs.columns and [tuple(r) for r in back.collect()] == [(1, PROSE, "x", 7)]
    assert line_quality.apply_clean(docs.where("false")).collect() == [] == line_quality.quality(docs.where("false")).collect()


def test_rules_of_a_line():
    rule = lambda line: line_quality.failed_rule(line, WORD.findall(line))
    assert rule(PROSE) == -1 and rule("Is it so?\r") == -1 and rule("“It is so.”") == -1 and rule("真的。") == -1
    assert rule(PROSE + " and a tail") == -1  # a sentence ends in its second half
    assert rule("no end of a sentence here") == 1 and rule("THIS!! IS!! LOUD!! NOW.") == 1 and rule("on$$$ and*** in%%% it.") == 1
    assert rule("one | two words | three | four.") == 0 and rule("Click here to go on.") == 0 and rule("a » b » c.") == 0
    assert rule("Licensed under the Apache License, Version 2.0.") == 2 and rule("© 2020 by them. All of it.") == 2


def test_documents_that_lose_too_much_go():
    prose, lost = PROSE + "\n", [f"words{i} without any{i} end{i} of a{i} sentence{i} in{i} them\n" for i in range(4)]
    assert line_quality.judge([prose + lost[0]])[0][6] is True
    assert line_quality.judge([prose + "".join(lost)])[0][5:7] == (False, False)


def test_very_long_text_and_long_word():
    long = "".join(f"w{i} stands here.\n" for i in range(60_000))
    got = line_quality.judge(["z" * 3_000_000 + " " + "short one. " * 30, long])
    assert got[0][:2] == (61, 3_000_270) and got[1][0] == 180_000 and got[1][4] == 0 and got[1][6] is True


def test_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(queries.ORACLES["op11_line_quality"]).fetchall()
    got = [tuple(r) for r in queries.QUERIES["op11_line_quality"](spark, SF).collect()]
    assert sorted(got) == sorted(want)


def test_separates_labelled_documents(spark):
    found = queries.QUERIES["op11_line_quality"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("n_words >= 20")
    n = {(r.quality, r.kept): r["count"] for r in found.groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) == 0 and n.get((0, True), 0) <= 2
