"""Equal word stretches inside texts, found exactly: names of 2^k-word grams by doubling.

All texts of a slice of a batch lie in one flat array of word numbers.  A gram
that occurs more than once in its own text has a name >= 0, any other -1; the
name of a gram of 2L words is the pair of the names of its halves, numbered
anew, so equal names mean equal words, without hashing.  Positions without a
name drop out, so the work after the first rounds is that of the repeats alone.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pandas as pd
import pyarrow as pa

from cohortlab.llm.common import WORD

words_of = re.compile(WORD).findall


def slices(texts: pa.Array, chars: int = 1 << 22) -> Iterator[tuple[int, list[str]]]:
    """(row number, texts) of slices of at most ``chars`` characters or one longer text; null is empty."""
    at, out, size = 0, [], 0
    for i, value in enumerate(texts):
        text = value.as_py() or ""
        if out and size + len(text) > chars:
            yield at, out
            at, out, size = i, [], 0
        out.append(text)
        size += len(text)
    if out:
        yield at, out


def numbered(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts in one array, equal for equal words, and the texts' bounds in it."""
    code: dict[str, int] = defaultdict(count().__next__)
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in texts], dtype=np.int64)])
    return np.fromiter(map(code.__getitem__, chain.from_iterable(texts)), np.int64, bounds[-1]), bounds


def _repeated(at: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    """Names of the positions ``at`` by ``key``; -1 at positions without one and where a key occurs once."""
    out = np.full(n, -1, np.int64)
    names, distinct = pd.factorize(key)
    counts = np.bincount(names, minlength=len(distinct))
    stays = counts[names] > 1
    out[at[stays]] = names[stays]
    return out


def single(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Names of the words that occur again in their text."""
    n = len(flat)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    return _repeated(np.arange(n), text * (flat.max(initial=0) + 1) + flat, n)


def doubled(names: np.ndarray, length: int) -> np.ndarray:
    """Names of the grams of 2 * ``length`` words from those of ``length`` words.

    A gram over the border of two texts occurs once: it is told apart in the
    round in which the border lies between its halves.
    """
    n = len(names)
    at = np.flatnonzero(names[:max(n - length, 0)] >= 0)
    at = at[names[at + length] >= 0]
    return _repeated(at, names[at] * (names.max(initial=0) + 1) + names[at + length], n)
