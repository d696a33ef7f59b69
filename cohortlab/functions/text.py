"""Note text: tokenizing and stop-word removal as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortlab.functions.codes import NOTE_STOP_WORDS, TOKEN_PATTERN, distinct

STOP_WORDS = distinct(NOTE_STOP_WORDS)


def tokens(text) -> Column:
    """All runs of letters of the lower-cased text (whole text, no length cap)."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 0)


def is_stop_word(term) -> Column:
    """Case-insensitive stop-word test on one token (hash-set ``IN``)."""
    term = F.col(term) if isinstance(term, str) else term
    return F.lower(term).isin(STOP_WORDS)


def without_stop_words(arr) -> Column:
    """Array of tokens with stop words removed (order kept); one hash-set test per token."""
    arr = F.col(arr) if isinstance(arr, str) else arr
    return F.filter(arr, lambda x: ~F.lower(x).isin(STOP_WORDS))
