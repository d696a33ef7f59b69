from __future__ import annotations

import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cohortlab.llm import arrow_shards, mixing, packing, queries
from cohortlab.llm.tokens import Encoder, slices
from cohortlab.session import scratch_dir

SF = "/root/testdata/sf0.01"
BYTE, WORDS = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))
ODD = [None, "", " ", "\n", "a", " a", "a ", "a  b", "a \n b\t c ", "x y z", "é ́e é", "it's we'LL I'd", "1234 5 六七 八",
       "\x1c a\x85b 　c", "!!! ... ?!a", "Σας ΣΑΣ", "word " * 5000, "n" * 3000, "\U0001f600 \U0001f600\U0001f601", "a\r\n\r\nb",
       "a <|endoftext|> b", "<|endoftext|>", "x<|startoftext|>y <|endoftext|>\nz ", "a  b<|endoftext|>"]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path, rule", [(BYTE, "lead"), (BYTE, "whole"), (WORDS, "drop")])
def test_pieces_encode_like_whole_texts(path, rule, sf_docs):
    plain = Tokenizer.from_file(path)
    enc = Encoder(path, rule)
    texts = ODD + [r[1] for r in sf_docs[:150]]
    for end in (None, 7):
        ids, bounds = enc.encode(texts, end)
        for text, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
            assert ids[a:b].tolist() == plain.encode(text or "", add_special_tokens=False).ids + [7] * (end is not None), repr(text)
    assert [x.tolist() for x in enc.encode([])] == [[], [0]]


def test_slices_are_bounded_by_bytes():
    column = pa.array(["aaaa", None, "bb", "c" * 50, "", "dd", "eeee"])
    assert [(at, part.to_pylist()) for at, part in slices(column, 6)] == [(0, ["aaaa", None, "bb"]), (3, ["c" * 50]), (4, ["", "dd", "eeee"])]


def test_token_shards_equal_brute_force(spark, sf_docs):
    plain = Tokenizer.from_file(BYTE)
    want, start = {}, 0
    for doc_id, text, *_ in sorted(sf_docs):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        want[doc_id] = (start, len(ids), crc(ids))
        start += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.QUERIES["op1_token_shards"](spark, SF).collect()}
    assert got == want


def test_shards_round_trip_and_random_access(spark, docs_of):
    docs = docs_of([(5, "b c d"), (None, "null id"), (3, None), (3, "same id"), (9, "long " * 4000), (4, ""), (7, "b c d")])
    path = arrow_shards.write_shards(docs, scratch_dir(spark, "t"), BYTE, end_id=2, seq_len=8, rows_per_batch=2, shard_tokens=50)
    rows = sorted(arrow_shards.read_documents(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 3, 3, 4, 5, 7, 9]
    assert [r.start for r in rows] == np.concatenate([[0], np.cumsum([r.n_tokens for r in rows])[:-1]]).tolist()
    assert rows[1].n_tokens == 1 and rows[3].ids_crc32 == crc([2])
    for r in spark.read.format("binaryFile").load(path).collect():
        if not r.length:
            continue
        shard = arrow_shards.Shard(bytes(r.content))
        reader = pa.ipc.open_stream(bytes(r.content))
        plain = np.concatenate([b.column(0).flatten().to_numpy() for b in reader])
        for i in range(len(shard)):
            ids, mask = shard.sequence(i)
            assert ids.tolist() == plain[8 * i:8 * i + 8].tolist() and len(arrow_shards.unpacked(mask)) == 8
            assert all(shard.buffer.address <= x.ctypes.data < shard.buffer.address + shard.buffer.size for x in (ids, mask))
        assert len(shard.tokens()) == sum(shard.index["n_tokens"].to_pylist())


def test_empty_table(spark, docs_of):
    none = docs_of([(1, "a")]).where("false")
    path = arrow_shards.write_shards(none, scratch_dir(spark, "t"), BYTE)
    assert arrow_shards.read_documents(spark, path).count() == 0
    assert packing.pack_documents(none, WORDS).count() == 0
    assert mixing.mix(none).count() == 0 and mixing.apply_mix(none).count() == 0


def check_packing(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_equals_brute_force_pieces(spark, sf_docs):
    plain = Tokenizer.from_file(WORDS)
    want = set()
    for doc_id, text, *_ in sf_docs:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
        want |= {(doc_id, s // 2048, s, len(ids[s:s + 2048]), crc(ids[s:s + 2048])) for s in range(0, len(ids), 2048)}
    rows = queries.QUERIES["op2_best_fit_packing"](spark, SF).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    n = check_packing(rows, 2048)
    assert n <= 1.01 * packing.lower_bound(np.array([r.length for r in rows]), 2048) + 1


def test_packing_rounds_keep_every_piece(spark):
    rng = np.random.default_rng(3)
    lengths = [int(x) for x in rng.integers(300, 1000, 900)] + [1000] * 40
    df = spark.createDataFrame([(i % 700, i, 0, n, "x") for i, n in enumerate(lengths)],
                               "doc_id long, piece int, start long, length long, size string")
    rows = packing.pack(df, capacity=1000, per_partition=100, rounds=4).collect()
    assert sorted((r.doc_id, r.piece, r.length) for r in rows) == sorted((i % 700, i, n) for i, n in enumerate(lengths))
    n = check_packing(rows, 1000)
    single, _, _ = packing.best_fit_decreasing(np.sort(np.array(lengths))[::-1], 1000)
    assert n <= 1.05 * (single.max() + 1)


def test_lower_bounds_hold_and_certify():
    assert packing.lower_bound(np.array([6, 6, 6]), 10) == 3  # volume alone says 2
    assert packing.lower_bound(np.array([4, 4, 4, 4, 4]), 10) == 3
    assert packing.lower_bound(np.array([], int), 10) == 0
    rng = np.random.default_rng(0)
    for _ in range(200):
        x = np.sort(rng.integers(1, 21, rng.integers(1, 40)))[::-1]
        bins, _, fills = packing.best_fit_decreasing(x, 20)
        assert packing.lower_bound(x, 20) <= bins.max() + 1 and fills.max() <= 20


def test_packing_odd_rows(spark, docs_of):
    rows = packing.pack_documents(docs_of([(1, None), (1, None), (None, ""), (2, "w " * 5000), (3, "a")]), WORDS, with_ids=True).collect()
    assert len(rows) == 3 + 3 + 1
    check_packing(rows, 2048)
    assert all(len(r.ids) == 2 * r.length for r in rows)


def mix_plain(rows, weights=(5, 2, 1), repeats=3):
    size = [len((t or "").split()) for _, t, _, _ in rows]
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(n for n, r in zip(size, rows, strict=True) if r[3] == s) for s in sources}
    w = {s: weights[i % 3] for i, s in enumerate(sources)}
    target, left, open_ = {}, sum(total.values()), set(sources)
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > repeats * total[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = repeats * total[s]
            left -= target[s]
        open_ -= over
    return size, total, target


def test_mix_targets_and_takings(spark, docs_of):
    rows = [(i, "w " * (1 + i * 7 % 50), None, s) for i, s in enumerate(["a"] * 60 + ["b"] * 300 + [None] * 30 + ["c"] * 3)]
    rows += [(1000, None, None, "b"), (1001, "", None, "d"), (1002, "x y", None, "c"), (1002, "x y", None, "c"), (None, "null id", None, "a")]
    size, total, target = mix_plain(rows)
    df = docs_of(rows)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    source = {r[0]: r[3] for r in rows}
    taken = defaultdict(int)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == total[s] and r.target == pytest.approx(target[s])
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        taken[s] += r.taken
    for s in total:
        assert abs(taken[s] - target[s]) <= 50, s
    again = mixing.mix(df.repartition(3)).collect()
    key = lambda r: (str(r.doc_id), r.tie, r.taken)
    assert sorted(got, key=key) == sorted(again, key=key)
    out = mixing.apply_mix(df)
    assert out.columns == df.columns
    words = sum(len((r.text or "").split()) for r in out.collect())
    assert words == sum(taken.values())


def test_mix_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(queries.ORACLES["op5_weighted_mix"]).df().sort_values("doc_id").reset_index(drop=True)
    got = queries.QUERIES["op5_weighted_mix"](spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert got.astype(str).equals(want[list(got.columns)].astype(str))


def test_shards_are_in_order_by_number(spark, docs_of, tmp_path):
    docs = docs_of([(k, f"text {k} " * 5) for k in range(40)])
    path = arrow_shards.write_shards(docs.coalesce(1), scratch_dir(spark, "t"), BYTE, end_id=2, seq_len=8, rows_per_batch=2, shard_tokens=50)
    files = [(r.path.rsplit("/", 1)[-1], bytes(r.content)) for r in spark.read.format("binaryFile").load(path).collect() if len(r.content)]
    names = ["part-99999-u-c999", "part-99999-u-c1000", "part-100000-u-c000"]
    assert all(f.startswith("part-") and "-c0" in f for f, _ in files) and len(files) >= 3
    for name, (file, content) in zip(names, sorted(files), strict=False):
        (tmp_path / (name + file[file.index("."):] if "." in file else name)).write_bytes(content)
    rows = sorted(arrow_shards.read_documents(spark, str(tmp_path)).collect(), key=lambda r: r.start)
    order = list(dict.fromkeys(r.shard.split(".")[0] for r in rows))
    assert order == names
    assert [r.start for r in rows] == np.concatenate([[0], np.cumsum([r.n_tokens for r in rows])[:-1]]).tolist()


@pytest.mark.parametrize("path, rule", [(BYTE, "lead"), (WORDS, "drop")])
def test_pieces_met_before_are_not_encoded_again(path, rule, sf_docs):
    enc, asked = Encoder(path, rule, 1 << 24), []
    joined = enc._joined
    enc._joined = lambda pieces, marks: (asked.extend(pieces), joined(pieces, marks))[1]
    texts = ODD + [r[1] for r in sf_docs[:100]]
    first = enc.encode(texts, 2)
    n = len(asked)
    again = enc.encode(texts, 2)
    assert n > 1000 and len(asked) == n
    assert [x.tolist() for x in first] == [x.tolist() for x in again]


@pytest.mark.parametrize("path, rule", [(BYTE, "lead"), (WORDS, "drop")])
@pytest.mark.parametrize("known", [0, 3000, 60_000, 400_000])
def test_known_pieces_are_bounded_and_change_no_id(path, rule, known, sf_docs):
    plain = Tokenizer.from_file(path)
    enc = Encoder(path, rule, known)
    texts = ODD + [r[1] for r in sf_docs[:80]] + ODD + [r[1] for r in sf_docs[:10]]
    for at in range(0, len(texts), 7):
        part = texts[at:at + 7]
        ids, bounds = enc.encode(part, 7)
        for text, a, b in zip(part, bounds[:-1], bounds[1:], strict=True):
            assert ids[a:b].tolist() == plain.encode(text or "", add_special_tokens=False).ids + [7], repr(text)
        assert all(k._size <= k.limit and len(k._place) * k.PIECE_BYTES <= k.limit for k in (enc._words, enc._others))
