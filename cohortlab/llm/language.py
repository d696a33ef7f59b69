"""Language identification by cross-parsing entropy (operator 3).

For each language a suffix automaton is built over labelled text.  A text is
parsed greedily into the longest phrases that occur in the language's text;
the language that needs the fewest phrases, weighted by the bits that point
into its text (log2 of its length) and divided by the number of symbols, wins.

Symbols are the lower-case letters of the labelled text, one symbol for all
other letters and one for each run of non-letters.  Texts are cut into blocks
of ``BLOCK`` symbols whose phrases add up, and all blocks of a batch are parsed
in step, so a long text costs no more than many short ones.

Learning uses a bounded sample of labelled rows: per language the
``SAMPLE_DOCS`` rows with the smallest hash of the id, and of their texts the
``SAMPLE_BLOCKS`` blocks of ``SAMPLE_CHARS`` characters with the smallest hash.
Nothing else is bounded: every whole text is scored.

Defined cases: a null text, or one without a letter, is ``und`` with score 0,
and so is every text if nothing is labelled; equal costs go to the first
language by code point; repeated rows get equal rows; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType
from pyspark.sql.window import Window

from cohortlab.llm.common import held_out
from cohortlab.llm.tokens import slices

SAMPLE_DOCS, SAMPLE_BLOCKS, SAMPLE_CHARS = 256, 96, 512
BLOCK = 1024
#: Bytes of text that are parsed in step (one longer text alone).
PARSE_BYTES = 2 << 20
UND = "und"
#: Symbols: separator of labelled blocks (in no text), letters outside the alphabet, non-letters, then the alphabet.
_BREAK, _OTHER, _GAP, _FIRST = 0, 1, 2, 3


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point: is it a letter?"""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Per state the transitions (symbol -> state) of the automaton of all substrings; state 1 is the start, 0 means none."""
    step: list[dict[int, int]] = [{}, {}]
    link, longest = [0, 0], [0, 0]
    last = 1
    for c in symbols:
        cur = len(step)
        step.append({})
        link.append(0)
        longest.append(longest[last] + 1)
        p = last
        while p and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if not p:
            link[cur] = 1
        else:
            q = step[p][c]
            if longest[p] + 1 == longest[q]:
                link[cur] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                longest.append(longest[p] + 1)
                while p and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return step


def packed(step: list[dict[int, int]], alphabet: int) -> tuple[np.ndarray, int]:
    """(table, start state): all transitions in one array of little more entries than there are transitions, however large
    the alphabet is.

    A state becomes an offset of its own; entry ``offset + symbol`` holds the offset of its owner in the high 32 bits and
    that of the target in the low ones.  States of many transitions are placed first, each at an offset where all fit.
    """
    offset = [0] * len(step)
    used, taken = bytearray(alphabet), {0}  # entries in use; offsets of states, 0 means none
    degree = start = 0
    for s in sorted(range(1, len(step)), key=lambda s: (-len(step[s]), s)):
        symbols = sorted(step[s])
        if len(symbols) != degree:
            degree, start = len(symbols), 1
        first, tries = (symbols[0] if symbols else 0), 0
        at = start + first
        while True:
            spot = used.find(0, at)
            if spot < 0:
                spot = max(at, len(used))
            if spot + alphabet > len(used):
                used.extend(bytes(spot + alphabet))
            base = spot - first
            if base not in taken and not any(used[base + c] for c in symbols):
                break
            at, tries = spot + 1, tries + 1
        if degree <= 1 or tries > 8:
            start = base  # the entries before are nearly full
        offset[s] = base
        taken.add(base)
        for c in symbols:
            used[base + c] = 1
    table = np.zeros(max(taken) + alphabet, np.int64)
    for s in range(1, len(step)):
        for c, to in step[s].items():
            table[offset[s] + c] = offset[s] << 32 | offset[to]
    return table, offset[1]


def follow(table: np.ndarray, state: np.ndarray | int, symbol: np.ndarray) -> np.ndarray:
    """The states that follow; 0 where there is no transition."""
    entry = table[state + symbol]
    return np.where(entry >> 32 == state, entry & 0xFFFFFFFF, 0)


class CrossParser:
    """Automata of some languages (name -> labelled blocks) and the parsing of batches of texts."""

    def __init__(self, blocks: dict[str, list[str]]):
        self.languages = sorted(blocks)
        letters = sorted({c for texts in blocks.values() for t in texts for c in t.lower() if c.isalpha()})
        self.code = np.where(_letters(), _OTHER, _GAP).astype(np.int32)
        self.code[[ord(c) for c in letters]] = np.arange(_FIRST, _FIRST + len(letters))
        self.alphabet = _FIRST + len(letters)
        self.tables, self.bits = [], []
        for name in self.languages:
            seq: list[int] = []
            for text in blocks[name]:
                seq += [*self.symbols([text])[0].tolist(), _BREAK]
            self.tables.append(packed(suffix_automaton(seq), self.alphabet))
            self.bits.append(np.log2(len(seq) + 1))

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All texts' symbols joined, and the number of each text; runs of non-letters are one symbol."""
        low = [t.lower() for t in texts]
        raw = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
        code = self.code[raw]
        first = np.zeros(len(raw) + 1, bool)
        ends = np.cumsum([len(t) for t in low])
        first[np.concatenate([[0], ends[:-1]])] = True
        stays = np.ones(len(raw), bool)
        stays[1:] = (code[1:] != _GAP) | (code[:-1] != _GAP) | first[1:-1]
        upto = np.concatenate([[0], np.cumsum(stays)])
        return code[stays], np.diff(np.concatenate([[0], upto[ends]]))

    def parse(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(phrases [language, text], symbols [text])."""
        code, counts = self.symbols(texts)
        n_blocks = -(-counts // BLOCK)
        owner = np.repeat(np.arange(len(texts)), n_blocks)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
        starts = np.repeat(np.cumsum(counts) - counts, n_blocks) + place * BLOCK
        lengths = np.minimum(counts[owner] - place * BLOCK, BLOCK)
        order = np.argsort(-lengths, kind="stable")
        owner, starts, lengths = owner[order], starts[order], lengths[order]
        active = len(lengths) - np.searchsorted(lengths[::-1], np.arange(BLOCK), side="right")
        phrases = np.zeros((len(self.languages), len(texts)), np.int64)
        states = [np.full(len(owner), root, np.int64) for _, root in self.tables]
        found = [np.zeros(len(owner), np.int32) for _ in self.languages]
        for t in range(int(lengths[0]) if len(lengths) else 0):
            a = active[t]
            c = code[starts[:a] + t]
            for (table, root), state, seen in zip(self.tables, states, found, strict=True):
                to = follow(table, state[:a], c)
                stop = np.flatnonzero(to == 0)
                if len(stop):
                    # the phrase so far ends; the next starts with this symbol, and one that never occurs is a phrase of its own
                    again = follow(table, root, c[stop])
                    seen[stop] += (state[stop] != root).astype(np.int32) + (again == 0)
                    to[stop] = np.where(again == 0, root, again)
                state[:a] = to
        for k, seen in enumerate(found):  # the phrase at the end of each block
            np.add.at(phrases[k], owner, seen + (states[k] != self.tables[k][1]))
        return phrases, counts

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [(UND, 0.0)] * len(texts)
        own = [i for i, t in enumerate(texts) if t and self.languages]
        if not own:
            return out
        phrases, counts = self.parse([texts[i] for i in own])
        cost = phrases * np.array(self.bits)[:, None] / np.maximum(counts, 1)
        letters = _letters()
        best = cost.argmin(axis=0)
        ranked = np.sort(cost, axis=0)
        for j, i in enumerate(own):
            raw = np.frombuffer(texts[i].encode("utf-32-le", "surrogatepass"), np.uint32)
            if letters[raw].any():
                second = ranked[1, j] if len(ranked) > 1 else np.inf
                score = 1.0 if np.isinf(second) else float(second / (ranked[0, j] + second))
                out[i] = (self.languages[best[j]], score)
        return out


@lru_cache(maxsize=1)
def _parser(blocks: tuple) -> CrossParser:
    """The parser of this Python worker for one sample."""
    return CrossParser({k: list(v) for k, v in blocks})


def sample(docs: DataFrame, train: bool = True) -> tuple:
    """((language, blocks), ...) from the bounded sample of rows with a ``lang`` outside the held-out third."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang")).where("lang is not null and text is not null")
    rows = rows.where(~held_out()) if train else rows
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    ids = rows.select("lang", "doc_id").withColumn("place", place).where(F.col("place") <= SAMPLE_DOCS)
    # SAMPLE_DOCS rows of each language code
    texts = rows.join(F.broadcast(ids.select("lang", "doc_id").distinct()), ["lang", "doc_id"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(lang, doc_id, i, text[i:i + SAMPLE_CHARS])
                   for lang, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "doc_id", "text")), strict=True)
                   for i in range(0, len(text), SAMPLE_CHARS)]
            yield pa.RecordBatch.from_pylist([dict(zip(("lang", "doc_id", "at", "block"), r, strict=True)) for r in out],
                                             schema=pa.schema([("lang", pa.string()), ("doc_id", pa.int64()), ("at", pa.int64()), ("block", pa.string())]))

    ranked = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", "at"), "doc_id", "at", "block"))
    chosen = (texts.mapInArrow(blocks, "lang string, doc_id long, at long, block string")
              .withColumn("place", ranked).where(F.col("place") <= SAMPLE_BLOCKS).select("lang", "block").collect())
    by: dict[str, list[str]] = {}
    for r in sorted(chosen, key=lambda r: (r.lang, r.block)):
        by.setdefault(r.lang, []).append(r.block)
    return tuple((k, tuple(v)) for k, v in sorted(by.items()))


def identify(docs: DataFrame, learned: tuple) -> DataFrame:
    """``docs`` with lang_pred and score (columns of these names are replaced); only ``text`` is looked at.  No shuffle."""
    docs = docs.drop("lang_pred", "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(learned)
        for batch in batches:
            for at, texts in slices(batch.column("text"), PARSE_BYTES):
                part = batch.slice(at, len(texts))
                found = parser.predict(texts.to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                    names=[*part.schema.names, "lang_pred", "score"])

    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return docs.mapInArrow(run, schema)


def predict_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learned outside the held-out third."""
    learned = sample(docs)
    found = identify(docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("held_out", held_out()), learned)
    return found.select("doc_id", "held_out", "lang_pred", "score")
