from __future__ import annotations

import random
import zlib

import numpy as np

from cohortlab.llm import language, queries
from cohortlab.llm.language import CrossParser

SF = "/root/testdata/sf0.01"


def phrases(text: str, known: str) -> int:
    """Greedy longest phrases of ``text`` that occur in ``known``; an unknown symbol is a phrase."""
    n = at = 0
    while at < len(text):
        k = 1
        while at + k <= len(text) and text[at:at + k] in known:
            k += 1
        at += max(1, k - 1)
        n += 1
    return n


def test_parse_equals_plain_search(sf_docs):
    known = {"en": "the cat sat on the mat and the dog ran", "de": "der hund lief und die katze sass auf der matte"}
    parser = CrossParser({k: [v] for k, v in known.items()})
    texts = ["the dog sat", "die matte", "q", "zzz the", "a", "ünd der cat!! 12 the", "the cat " * 400]
    got, counts = parser.parse(texts)
    for j, text in enumerate(texts):
        plain = "".join(c if c.isalpha() else " " for c in text)
        while "  " in plain:
            plain = plain.replace("  ", " ")
        assert counts[j] == len(plain)
        for k, name in enumerate(parser.languages):
            want = sum(phrases(plain[i:i + language.BLOCK], known[name] + "\0") for i in range(0, len(plain), language.BLOCK))
            assert got[k, j] == want, (text, name)


def test_packed_transitions_are_the_automatons_and_do_not_grow_with_the_alphabet():
    rng = random.Random(5)
    for size, n in ((3, 400), (40, 4000), (4000, 6000)):
        step = language.suffix_automaton([language._FIRST + min(size - 1, int(rng.paretovariate(0.5))) for _ in range(n)])
        alphabet = language._FIRST + size
        table, root = language.packed(step, alphabet)
        at, todo = {1: root}, [1]
        while todo:
            s = todo.pop()
            got = language.follow(table, at[s], np.arange(alphabet))
            assert set(np.flatnonzero(got).tolist()) == set(step[s])
            for c, to in step[s].items():
                if to not in at:
                    todo.append(to)
                assert at.setdefault(to, int(got[c])) == got[c]
        assert len(set(at.values())) == len(step) - 1
        assert len(table) <= 2 * sum(map(len, step)) + 2 * alphabet


def test_held_out_accuracy(spark, sf_docs):
    lang = {r[0]: r[2] for r in sf_docs}
    rows = queries.QUERIES["op3_language_id"](spark, SF).collect()
    assert len(rows) == len(sf_docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)


def test_defined_cases(spark, docs_of):
    docs = docs_of([(1, "ein haus und ein hund", "de"), (2, "a house and a dog", "en"), (3, None, "en"), (None, "a dog", None),
                    (5, "", "de"), (6, "123 !?", "en"), (7, "ein hund", None), (7, "ein hund", None), (8, "собака", None)])
    learned = language.sample(docs, train=False)
    got = [(r.doc_id, r.lang_pred, r.score) for r in language.identify(docs, learned).collect()]
    by = dict((a, b) for a, b, _ in got)
    assert by[3] == by[5] == by[6] == "und" and by[7] == "de" and by[None] == "en" and by[8] in ("de", "en")
    assert got.count((7, "de", got[6][2])) == 2 and len(got) == 9
    none = docs.where("false")
    assert language.predict_documents(none).count() == 0
    unlabelled = docs_of([(1, "some text")])
    assert [(r.lang_pred, r.score) for r in language.predict_documents(unlabelled).collect()] == [("und", 0.0)]


def test_query_equals_plain_parsing(spark):
    """The whole query on a whole table: sample, parse by plain search, bits, choice and score."""
    import math

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    learned = {k: v for k, v in language.sample(docs)}
    alphabet = {c for blocks in learned.values() for t in blocks for c in t.lower() if c.isalpha()}

    def symbols(text):
        out = []
        for c in text.lower():
            if c.isalpha():
                out.append(c if c in alphabet else "\1")
            elif not out or out[-1] != " ":
                out.append(" ")
        return "".join(out)

    known = {k: "".join(symbols(t) + "\0" for t in blocks) for k, blocks in learned.items()}
    want = []
    for doc_id, text in docs.select("doc_id", "text").collect():
        s = symbols(text or "")
        if not any(c.isalpha() for c in text or ""):
            want.append((doc_id, "und", 0.0))
            continue
        cost = sorted((sum(phrases(s[i:i + language.BLOCK], known[k]) for i in range(0, len(s), language.BLOCK)) * math.log2(len(known[k]) + 1) / len(s), k)
                      for k in known)
        want.append((doc_id, cost[0][1], cost[1][0] / (cost[0][0] + cost[1][0])))
    got = sorted((r.doc_id, r.lang_pred, r.score) for r in queries.QUERIES["op3_language_id"](spark, sf).collect())
    assert len(got) == len(want) > 100
    for a, b in zip(got, sorted(want), strict=True):
        assert a[:2] == b[:2] and math.isclose(a[2], b[2], rel_tol=1e-9)
