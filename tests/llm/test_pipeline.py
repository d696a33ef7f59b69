from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from test_jaccard import plain
from test_repeats import plain_words, planted, words
from test_tokens_packing_mixing import check_packing, crc, mix_plain
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from cohortlab.llm.common import keep

SF = "/root/testdata/sf0.001"


def test_registered():
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "substring_dedup", "mix_sources", "pack_sequences"]


@pytest.mark.parametrize("which", ["table", "planted", "empty"])
def test_stages_on_their_own_input(spark, which):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    if which != "table":
        rows = [(d, t, "en" if i % 3 else None, ["a", "b", None][i % 3], None) for i, (d, t) in enumerate(planted(9))]
        docs = spark.createDataFrame(rows + [(7000, "123 !", "en", "a", None)], docs.schema)
    if which == "empty":
        docs = docs.where("false")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(keep(stage(spark, frames[-1], SF), f"test-{name}"))
        if name != "pack_sequences":
            assert frames[-1].columns == docs.columns, name
    raw, lang, one, cut, mixed, packed = ([tuple(r) for r in f.collect()] for f in frames)
    assert Counter(lang) == Counter(r for r in raw if any(c.isalpha() for c in r[1] or ""))
    classes = {c for d, c, _ in plain([(r[0], r[1]) for r in lang]) if d is not None}
    assert {r[0] for r in one if r[0] is not None} == classes and set(one) <= set(lang)
    want = Counter((d, n - k) for d, n, k, _ in plain_words([(r[0], r[1]) for r in one]) if n == 0 or k < n)
    assert Counter((r[0], len(words(r[1] or ""))) for r in cut) == want
    size, total, target = mix_plain([r[:4] for r in cut])
    taken = defaultdict(int)
    times = Counter(mixed)
    assert set(times) <= set(cut)
    for r, k in times.items():
        assert k <= 3 * cut.count(r)
        taken[r[3]] += k * len(words(r[1] or ""))
    for s in total:
        assert abs(taken[s] - target[s]) <= max((n for n, r in zip(size, cut, strict=True) if r[3] == s), default=0) + 1
    plain_tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = Counter()
    for r in mixed:
        ids = [*plain_tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0]
        pieces.update((r[0], s // 2048, s, len(ids[s:s + 2048]), crc(ids[s:s + 2048])) for s in range(0, len(ids), 2048))
    out = frames[-1].collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == pieces
    n = check_packing(out, 2048)
    assert n <= 1.02 * np.ceil(sum(r.length for r in out) / 2048) + 2


def test_further_columns_of_any_name_pass_the_stages(spark):
    from pyspark.sql import functions as F
    names = ("score", "lang_pred", "_id", "_tie", "_n", "_rows", "_place", "_times", "_pass", "_hash", "_spans", "words", "extra_0", "kept")
    rows = [(d, t, "en", "a", None) for d, t in planted(4) if d is not None and t][:60]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = plain.withColumns({c: F.concat(F.lit(c + "-"), F.col("doc_id").cast("string")) for c in names})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        bare, docs = keep(stage(spark, docs.select(*plain.columns), SF), "bare"), keep(stage(spark, docs, SF), "named")
        assert docs.columns == [*plain.columns, *names] and docs.count() > 0
        assert sorted(map(str, bare.collect())) == sorted(map(str, docs.select(*plain.columns).collect()))
        for r in docs.collect():
            assert all(r[c] == f"{c}-{r['doc_id']}" for c in names)
