from __future__ import annotations

import tracemalloc
import zlib

import numpy as np

from cohortlab.llm import queries, toxicity
from cohortlab.llm.toxicity import Restorer, trigram_counts

SF = "/root/testdata/sf0.01"
TEXT = ["you are a stupid idiot and a loser", "the pathetic clown is a moron", "what a good day it is", "scum and trash", "a cool pool of books"] * 20


def model(texts=TEXT):
    c = trigram_counts(texts)
    some = np.flatnonzero(c)
    return Restorer(tuple(zip(some.tolist(), c[some].tolist(), strict=True)))


def test_restores_leet_spacing_and_repetition():
    r = model()
    for token, want in [("tr@sh", "trash"), ("$tupid", "stupid"), ("m0r0n", "moron"), ("s-t-u-p-i-d", "stupid"), ("stuuuupid", "stupid"),
                        ("COOOOL", "cool"), ("pathet1c!!", "pathetic"), ("1d10t", "idiot"), ("clown.", "clown")]:
        assert r.words(token) == [want], token
    assert r.spaced("you s t u p i d one") == ["stupid"]
    assert r.words("it's") == ["it", "s"] and r.words("2024") == [] and r.words("!!") == [] and r.words("") == []


def test_viterbi_is_the_best_reading():
    r = model()

    def readings(s, i=0):
        if i == len(s):
            yield "", 0.0
            return
        for out, j, extra in r._arcs(s, i):
            for rest, cost in readings(s, j):
                yield out + rest, cost + extra

    def cost(text):
        x = y = total = 0
        for ch in text:
            z = int(r.code[ord(ch)])
            if z == 0 and y == 0:
                continue
            total += r.cost[x][y][z]
            x, y = y, z
        return total + (r.cost[x][y][0] if y else 0)

    def squeeze(t):
        return " ".join(t.split())
    for s in ["st0p1d", "l-o-s-e-r", "sc!!um", "cooool", "1 d 1 0 t"]:
        best = min(cost(t) + c for t, c in readings(s))
        got = squeeze(r.decode(s))
        assert any(squeeze(t) == got and abs(cost(t) + c - best) < 1e-9 for t, c in readings(s)), s


def test_a_long_token_is_decoded_whole_in_bounded_memory():
    r = model()
    peaks = []
    for n in (500, 8000):
        tracemalloc.start()
        text = r.decode("s7up1d_m0r0n_" * n)
        peaks.append(tracemalloc.get_traced_memory()[1] / (13 * n))
        tracemalloc.stop()
        assert text.split() == ["stupid", "moron"] * n
    assert peaks[1] < 300  # bytes a character: the reading itself, not a table of all readings


def test_trigram_counts_are_plain_counts(spark, sf_docs):
    texts = ["Ab, c!", "É x1y", "日本 a"]
    c = trigram_counts(texts)
    code = toxicity._codes()
    line = " " + "\n".join(texts).lower() + " "
    raw = [int(code[ord(ch)]) for ch in line]
    symbols = [c for b, c in zip([1, *raw], raw, strict=False) if b or c]
    want = np.zeros_like(c)
    for a, b, d in zip(symbols, symbols[1:], symbols[2:], strict=False):
        want[(a * 64 + b) * 64 + d] += 1
    assert (c == want).all()


def test_held_out_labels(spark):
    import duckdb
    label = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SF}/labels.parquet'").fetchall())
    rows = queries.QUERIES["op8_toxicity"](spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    found = [r for r in rows if r.held_out and r.predicted and r.doc_id in label]
    assert found and sum(label[r.doc_id] for r in found) >= 0.9 * len(found)


def test_defined_cases(spark, docs_of):
    docs = docs_of([(i, "you are an idiot here" if i % 4 == 0 else "you are an honest one here") for i in range(60)]
                   + [(100, None), (None, "an 1d!ot"), (101, ""), (102, "i d i o t"), (103, "fine"), (103, "fine"), (104, "idiot " * 20000)])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(60)] + [(1, None), (None, 1), (2, 0)], "doc_id long, toxic int")
    rows = toxicity.score_documents(docs, labels).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == 67 and by[None].predicted == by[102].predicted == by[104].predicted == 1
    assert by[100].score == by[101].score == by[103].score < 0.5 and by[None].held_out is False
    nothing = toxicity.score_documents(docs, labels.where("false")).collect()
    assert {r.predicted for r in nothing} == {0}
    assert toxicity.score_documents(docs.where("false"), labels).count() == 0


def test_a_failing_feature_is_dropped_and_the_list_goes_on():
    alone = toxicity.decision_list({"a": set(range(10)), "b": set(range(13))}, {"b": 5}, 13, 100)
    assert [f for f, _ in alone[0]] == ["a"]
    # after "a", "small" holds 4 toxic rows and 3 clean ones (gain -3.5), "large" 145 and 60 (gain -5, share 0.71)
    rows = {"a": set(range(40)), "small": set(range(36, 44)), "large": set(range(100, 245))}
    learned, _ = toxicity.decision_list(rows, {"small": 3, "large": 60}, 245, 1000)
    assert [f for f, _ in learned] == ["a", "large"]
    assert dict(learned)["large"] == 145.5 / 206
