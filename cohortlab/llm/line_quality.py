"""Line-first quality rules (operator 11).

Every line is judged on its own, failing lines are removed, and a document that
loses too much of its text goes.  A line (``\\n``-split, with at least a word)
fails

* **navigation**: two or more cell separators with at most ``CELL_WORDS`` words a
  separator, or a short line with a navigation phrase;
* **punctuation**: no word of its second half ends in a terminal mark (closing
  quotes and brackets may follow), or more than ``MARKED_PERCENT`` of its words are marked
  (a symbol inside, or two exclamation or question marks in a row);
* **boilerplate**: a licence, copyright, cookie or sign-up phrase.

The rules run in this order; a line counts for the first that it fails.  A
document is kept when its kept lines hold at least ``KEEP_PERCENT`` of its word
characters and it passes the base rules on its whole text (``base_failed``).

One pass over the rows without a shuffle: a task holds a slice of texts (4 MB,
or one longer text).  Repeated 8-word windows come from exact names
(``grams.py``), which are computed for all texts of a slice at once.

Defined cases: a null or empty text has no words and fails the base rules; a
line without a word is neither judged nor kept; null or repeated ``doc_id``s are
rows like others; columns of the output's names are replaced, others untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortlab.llm.common import WORD
from cohortlab.llm.grams import doubled, numbered, single, slices, words_of

#: Symbols, words below which a text fails, and the share of repeated words above which it fails.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
REPEAT_PERCENT = 30
#: Words of a repeated window.
WINDOW = 8

MARKED_PERCENT = 30
CELL_WORDS = 6
NAV_WORDS = 8
KEEP_PERCENT = 50

#: Patterns that Python and RE2 read alike; the phrases are fixed values.
ENDS = r"""[.!?:;…。！？]['"’”»)\]]*( |$)"""
MARK = r"[#*$%&|<>]|[!?][!?]"
SEPARATOR = r"[|»›•·]"
NAV_PHRASES = ("click here", "log in", "login", "main menu", "next page", "previous page", "read more", "sign in", "sign up",
               "site map", "sitemap", "skip to content")
BOILERPLATE_PHRASES = ("all rights reserved", "cookie policy", "copyright", "enable javascript", "licensed under", "lorem ipsum",
                       "powered by", "privacy policy", "spdx-license-identifier", "subscribe to our", "terms of service",
                       "terms of use", "©")

_ENDS, _MARK, _SEPARATOR = re.compile(ENDS), re.compile(MARK), re.compile(SEPARATOR)
_SYMBOL = re.compile(f"[{re.escape(SYMBOLS)}]")
_NAV = re.compile("|".join(map(re.escape, NAV_PHRASES)))
_BOILERPLATE = re.compile("|".join(map(re.escape, BOILERPLATE_PHRASES)))

COLUMNS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
           "kept_chars long, failed_navigation long, failed_punctuation long, failed_boilerplate long, cleaned string")


def failed_rule(line: str, words: list[str]) -> int:
    """0 navigation, 1 punctuation, 2 boilerplate, -1 none."""
    n_words, cells, low = len(words), len(_SEPARATOR.findall(line)), line.lower()
    if (cells >= 2 and n_words <= CELL_WORDS * cells) or (n_words <= NAV_WORDS and _NAV.search(low)):
        return 0
    if not _ENDS.search(" ".join(words[n_words // 2:])) or (
            _MARK.search(line) and 100 * sum(1 for w in words if _MARK.search(w)) > MARKED_PERCENT * n_words):
        return 1
    return 2 if _BOILERPLATE.search(low) else -1


def _repeat_words(texts: list[list[str]]) -> np.ndarray:
    """Words of each text that lie in an 8-word window found twice or more in it."""
    flat, bounds = numbered(texts)
    names, length = single(flat, bounds), 1
    while length < WINDOW:
        names, length = doubled(names, length), 2 * length
    at = np.flatnonzero(names >= 0)
    step = np.zeros(len(flat) + 1, np.int64)
    step[at] += 1
    step[at + WINDOW] -= 1
    covered = np.concatenate([[0], np.cumsum(np.cumsum(step)[:-1] > 0)])
    return covered[bounds[1:]] - covered[bounds[:-1]]


def judge(texts: list[str]) -> list[tuple]:
    """One tuple of ``COLUMNS`` per text."""
    words = [words_of(t) for t in texts]
    out = []
    for text, own, repeat in zip(texts, words, _repeat_words(words).tolist(), strict=True):
        seen: set[str] = set()
        kept: list[str] = []
        dup, kept_chars, failed = 0, 0, [0, 0, 0]
        for line in text.split("\n"):
            of_line = words_of(line)
            if not of_line:
                continue
            dup += line in seen
            seen.add(line)
            rule = failed_rule(line, of_line)
            if rule < 0:
                kept.append(line)
                kept_chars += sum(map(len, of_line))
            else:
                failed[rule] += 1
        chars = sum(map(len, own))
        base = len(own) < MIN_WORDS or 100 * repeat > REPEAT_PERCENT * len(own)
        out.append((len(own), chars, len(_SYMBOL.findall(text)), dup, repeat, base, not base and 100 * kept_chars >= KEEP_PERCENT * chars,
                    kept_chars, *failed, "\n".join(kept)))
    return out


def clean(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts, the verdicts and ``cleaned``, the text of its kept lines.  No shuffle."""
    added = StructType.fromDDL(COLUMNS)
    stay = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in added.names])
    rows = docs.select(stay.alias("_row"), F.col("text").cast("string").alias("_text"))
    kinds = [pa.bool_() if f.dataType.simpleString() == "boolean" else pa.string() if f.name == "cleaned" else pa.int64() for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column("_text")):
                columns = [pa.array(c, k) for c, k in zip(zip(*judge(texts), strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("_row").slice(at, len(texts)), *columns], names=["_row", *added.names])

    return rows.mapInArrow(run, StructType([rows.schema["_row"], *added.fields])).select("_row.*", *added.names)


def apply_clean(docs: DataFrame) -> DataFrame:
    """The kept documents with their cleaned text; the columns of ``docs``, whatever their names."""
    found = clean(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), "text"))
    return found.where("kept").select(*[F.col("cleaned").alias(c) if c == "text" else F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept of every row."""
    return clean(docs.select("doc_id", "text")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                                       "base_failed", "kept")


def sql() -> str:
    """The same as ``quality`` in DuckDB's SQL."""
    phrases = lambda names: "(" + " OR ".join(f"contains(lower(line), '{p}')" for p in names) + ")"
    ends = ENDS.replace("'", "''")
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
lines AS (
  SELECT r, pos, line, regexp_extract_all(line, '{WORD}') AS words
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs) s),
judged AS (
  SELECT r, len(array_to_string(words, '')) AS chars, row_number() OVER (PARTITION BY r, line ORDER BY pos) > 1 AS dup,
         NOT regexp_matches(array_to_string(words[len(words) // 2 + 1:], ' '), '{ends}') OR 100 * len(list_filter(words, lambda w: regexp_matches(w, '{MARK}'))) > {MARKED_PERCENT} * len(words)
         OR (len(regexp_extract_all(line, '{SEPARATOR}')) >= 2 AND len(words) <= {CELL_WORDS} * len(regexp_extract_all(line, '{SEPARATOR}')))
         OR (len(words) <= {NAV_WORDS} AND {phrases(NAV_PHRASES)}) OR {phrases(BOILERPLATE_PHRASES)} AS fails
  FROM lines WHERE len(words) > 0),
by_doc AS (
  SELECT r, sum(dup::INT)::BIGINT AS n_dup_lines, coalesce(sum(CASE WHEN fails THEN 0 ELSE chars END), 0) AS kept_chars FROM judged GROUP BY r),
windows AS (
  SELECT r, pos, md5(array_to_string(words[pos:pos + {WINDOW - 1}], ' ')) AS w
  FROM docs, unnest(range(1, len(words) - {WINDOW - 2})) AS u(pos) WHERE len(words) >= {WINDOW}),
twice AS (SELECT r, w FROM windows GROUP BY r, w HAVING count(*) > 1),
covered AS (SELECT DISTINCT r, pos + k AS pos FROM windows JOIN twice USING (r, w), range(0, {WINDOW}) AS t(k)),
repeats AS (SELECT r, count(*)::BIGINT AS n FROM covered GROUP BY r),
counted AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, len(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words, coalesce(kept_chars, 0) AS kept_chars
  FROM docs LEFT JOIN by_doc USING (r) LEFT JOIN repeats USING (r)),
base AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * kept_chars >= {KEEP_PERCENT} * word_chars AS kept
FROM base
"""
