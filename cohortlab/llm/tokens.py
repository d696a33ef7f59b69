"""Token ids of whole texts with the ``tokenizers`` library, one call per distinct piece of a slice.

Texts are cut where the tokenizer's own pre-tokenizer always cuts, the pieces of
a slice are numbered in Arrow, each distinct piece is encoded once, and the ids
of a text are gathered from those of its pieces.  ``rule`` names the cuts that are
safe for a file:

* ``"lead"`` (byte-level BPE whose words start with their space): before a
  single space that stands between two non-spaces.  A text with other white
  space beside a space is encoded in one call.
* ``"drop"`` (BPE that drops white space): at every space and newline.
* ``"whole"``: no cut; any other tokenizer.

A text with the string of an added token is encoded in one call, so it gets the
library's own ids.  A worker holds one slice of texts, its pieces and their ids;
an encoder with ``known_bytes`` also keeps about as many bytes of earlier pieces
and their ids, which it does not encode again (``Known``).
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text in a slice (one longer text is a slice of its own), and pieces per call.
SLICE_BYTES = 4 << 20
CALL_PIECES = 200

_LATIN = "[a-zA-ZÀ-ÖØ-öø-ÿ]+"


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(row number, part) of parts of ``column`` of at most ``limit`` bytes, or one longer text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        upto = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, side="right"))
        upto = max(upto, at + 1)
        yield at, column.slice(at, upto - at)
        at = upto


def _strings(column: pa.Array) -> list[str]:
    """The values of a column without nulls (by way of numpy, which is faster than ``to_pylist``)."""
    return column.to_numpy(zero_copy_only=False).tolist()


def _gathered(ids: np.ndarray, counts: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the pieces ``order`` one after the other, and where each begins and the last ends; ``counts``: ids of each piece."""
    sizes = counts[order]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    starts = np.cumsum(counts) - counts
    return ids[np.repeat(starts[order] - ends[:-1], sizes) + np.arange(ends[-1])], ends


class Known:
    """Ids of pieces met before, about ``limit`` bytes of them; when these are full it starts anew with the last slice's."""

    #: A piece as a key of a dict beside its text: the string and number objects, the entry, the count of ids.
    PIECE_BYTES = 160

    def __init__(self, limit: int, dtype: np.dtype):
        self.limit, self._dtype = limit, dtype
        self._clear()

    def _clear(self) -> None:
        self._place: dict[str, int] = {}
        self._ids, self._counts, self._size = np.zeros(0, self._dtype), np.zeros(0, np.int64), 0

    def _cost(self, texts: list[str], ids: np.ndarray) -> int:
        return self.PIECE_BYTES * len(texts) + 2 * sum(map(len, texts)) + ids.nbytes

    def encode(self, pieces: list[str], ids_of: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, number of ids of each, places): piece i of the distinct ``pieces`` is number ``places[i]``; ``ids_of`` encodes new ones."""
        if not self.limit:
            return *ids_of(pieces), np.arange(len(pieces))
        place = self._place
        places = np.fromiter(map(place.get, pieces, repeat(-1)), np.int64, len(pieces))
        unmet = np.flatnonzero(places < 0)
        new = [pieces[i] for i in unmet.tolist()]
        new_ids, new_counts = ids_of(new)
        first = len(self._counts)
        places[unmet] = first + np.arange(len(new))
        ids, counts = np.concatenate([self._ids, new_ids]), np.concatenate([self._counts, new_counts]).astype(np.int64)
        cost = self._cost(new, new_ids)
        if self._size + cost <= self.limit:
            place.update(zip(new, range(first, first + len(new)), strict=True))
            self._ids, self._counts, self._size = ids, counts, self._size + cost
        else:
            self._clear()
            own_ids, ends = _gathered(ids, counts, places)
            if (cost := self._cost(pieces, own_ids)) <= self.limit:
                self._place, self._ids, self._counts, self._size = dict(zip(pieces, range(len(pieces)), strict=True)), own_ids, np.diff(ends), cost
        return ids, counts, places


class Encoder:
    """Encodes slices of texts to one array of ids and the texts' bounds in it."""

    def __init__(self, path: str, rule: str, known_bytes: int = 0):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.rule = rule
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        # of two parts words, one other pieces
        self._words, self._others = Known(known_bytes * 2 // 3, self.dtype), Known(known_bytes // 3, self.dtype)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocab = self.tokenizer.get_vocab()
        #: the ids whose tokens begin with a space (rule "lead": each piece's first and no other) or end a word (rule "drop")
        self._marks = np.zeros(max(vocab.values()) + 1, bool)
        self._marks[[i for t, i in vocab.items() if (t.startswith("Ġ") if rule == "lead" else t.endswith("</w>"))]] = True
        #: rule "drop": a word of one token, which parts the pieces of a call
        words = sorted((t[:-4] for t in vocab if t.endswith("</w>") and t[:-4].isascii() and t[:-4].isalpha() and len(t) > 12), key=lambda t: (-len(t), t))
        self._stop: tuple[str, int] | None = next(((w, ids[0]) for w in words if len(ids := self._ids([w])[0]) == 1), None) if rule == "drop" else None

    def _ids(self, texts: list[str]) -> list[list[int]]:
        out = []
        for i in range(0, len(texts), 4096):
            out += [e.ids for e in self.tokenizer.encode_batch_fast(texts[i:i + 4096], add_special_tokens=False)]
        return out

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each text), a text at a time."""
        ids = self._ids(texts)
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for own in ids for i in own), self.dtype, counts.sum()), counts

    def _joined(self, pieces: list[str], marks: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each piece), many pieces a call.

        ``marks`` tells the ids that begin a piece (rule "lead") or end one (rule "drop", words of letters); without it a
        word of one token stands after each piece.
        """
        ids, counts = [np.zeros(0, self.dtype)], [np.zeros(0, np.int64)]
        lead = self.rule == "lead"
        for i in range(0, len(pieces), CALL_PIECES):
            part = pieces[i:i + CALL_PIECES]
            text = "".join(f"{p} {self._stop[0]} " for p in part) if marks is None else (" " if lead else "") + " ".join(part)
            own = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
            at = np.flatnonzero(own == self._stop[1] if marks is None else marks[own])
            if len(at) != len(part):  # a piece holds the parting word
                own, n = self._each([" " + p for p in part] if lead else part)
            elif lead:
                n = np.diff(np.append(at, len(own)))
            else:
                n = np.diff(at, prepend=-1)
                if marks is None:
                    n, own = n - 1, np.delete(own, at)
            ids.append(own)
            counts.append(n)
        return np.concatenate(ids), np.concatenate(counts)

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each piece); pieces of rule "lead" stand without their space.

        Words of Latin letters are parted from stops and commas behind them, where both rules cut, since
        there are fewer distinct words than pieces.
        """
        base = pc.utf8_rtrim(pieces, ".,")
        latin = pc.match_substring_regex(base, f"^{_LATIN}$")
        with_word, others = pieces.filter(latin), _strings(pieces.filter(pc.invert(latin)))
        words = base.filter(latin)
        words = (words if self.rule == "lead" else pc.utf8_lower(words)).dictionary_encode()
        stops = pc.replace_substring_regex(with_word, f"^{_LATIN}", "").dictionary_encode()
        found = [self._words.encode(_strings(words.dictionary), lambda new: self._joined(new, self._marks)),
                 self._each(_strings(stops.dictionary)),
                 self._others.encode(others, lambda new: self._joined(new, self._marks if self.rule == "lead" else None)
                                     if self.rule == "lead" or self._stop else self._each(new))]
        ids, counts = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        n_words, n_stops = len(found[0][1]), len(stops.dictionary)
        order = np.full((len(pieces), 2), len(counts), np.int64)
        is_word = latin.to_numpy(zero_copy_only=False)
        order[is_word, 0] = found[0][2][words.indices.to_numpy()]
        order[is_word, 1] = n_words + stops.indices.to_numpy()
        order[~is_word, 0] = n_words + n_stops + found[2][2]
        ids, ends = _gathered(ids, np.append(counts, 0).astype(np.int64), order.ravel())
        return ids, np.diff(ends[::2])

    def encode(self, texts: pa.Array | list[str | None], end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, bounds): text i (null: empty), with ``end_id`` appended, has the ids ``bounds[i]:bounds[i + 1]``."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        n, end = len(texts), np.array([] if end_id is None else [end_id], self.dtype)
        whole = np.full(n, self.rule == "whole")
        for token in self.added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        if self.rule == "whole" or not n:
            at, own, ids, counts, bad = np.zeros(n, np.int64), np.zeros(0, np.int64), [], [], None
        else:
            split = pc.split_pattern(pc.replace_substring(texts, "\n", " ") if self.rule == "drop" else texts, " ")
            first, flat = split.offsets.to_numpy()[:-1].astype(np.int64) - split.offsets[0].as_py(), split.flatten()
            at = np.diff(np.append(first, len(flat)))
            coded = flat.dictionary_encode()
            own, pieces = coded.indices.to_numpy().astype(np.int64), coded.dictionary
            if self.rule == "lead":  # a text's first piece has no space before it
                heads = flat.take(pa.array(first)).dictionary_encode()
                own[first] = heads.indices.to_numpy() + len(pieces)
                head = _strings(heads.dictionary)
                spaced = pc.or_(pc.equal(pieces, ""), pc.not_equal(pc.utf8_trim_whitespace(pieces), pieces))
                bad = np.concatenate([spaced.to_numpy(zero_copy_only=False), [p[-1:].isspace() for p in head]])
                whole |= np.logical_or.reduceat(bad[own], first)
                parts = [self._pieces(pc.if_else(spaced, "x", pieces)), self._each(head)]
            else:
                parts = [self._pieces(pieces)]
            ids, counts = ([p[k] for p in parts] for k in (0, 1))
        alone = np.flatnonzero(whole)
        lone, lone_counts = self._each(_strings(texts.take(pa.array(alone))))
        known = sum(map(len, counts))
        ids, counts = np.concatenate([*ids, lone, end]), np.concatenate([*counts, lone_counts, [len(end)]]).astype(np.int64)
        # the numbers of all pieces in order: those of a text, or the text itself, and the end
        n_own = np.where(whole, 1, at)
        place = np.concatenate([[0], np.cumsum(n_own + 1)])
        order = np.full(place[-1], len(counts) - 1, np.int64)
        if len(own):
            text = np.repeat(np.arange(n), at)
            stays = ~whole[text]
            order[(place[text] + np.arange(len(own)) - np.repeat(np.cumsum(at) - at, at))[stays]] = own[stays]
        order[place[alone]] = known + np.arange(len(alone))
        ids, ends = _gathered(ids, counts, order)
        return ids, ends[place]


_ENCODERS: dict[tuple[str, str, int], Encoder] = {}


def encoder(path: str, rule: str, known_bytes: int = 0) -> Encoder:
    """The encoder of this Python worker for a tokenizer file; it holds the file's vocabulary and ``known_bytes`` of pieces."""
    key = path, rule, known_bytes
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]
