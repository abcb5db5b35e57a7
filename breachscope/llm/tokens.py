"""Token ids of whole texts by a public tokenizer file, inside Python tasks.

A tokenizer cuts a text into units before it merges; where a cut is certain whatever
stands around it, the units on both sides can be encoded on their own. Each distinct
unit is encoded once by a worker and looked up by its hash from then on. A text that
holds one of the tokenizer's added tokens is encoded whole by the plain call.
"""

from __future__ import annotations

import os
import sys

import numpy as np

from breachscope.llm import kernel

CACHED_UNITS = 300_000
_JOINED = 200  # new units to a call

# Byte classes for cutting a word into units: ASCII letters, ASCII signs and digits
# other than the apostrophe, and the same three apart (0 for all other bytes).
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_SIGN = np.zeros(256, bool)
_SIGN[33:127] = True
_SIGN &= ~_LETTER
_SIGN[39] = False

_KIND = np.zeros(256, np.uint8)
_KIND[_LETTER], _KIND[_SIGN], _KIND[48:58] = 1, 2, 3

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 13, 32]] = True
_INK = np.zeros(256, bool)
_INK[33:127] = True
# First bytes whose characters are never white space.
_INK_2 = np.zeros(256, bool)
_INK_2[0xC3:0xE0] = True
_INK_3 = np.zeros(256, bool)
_INK_3[[0xE0, *range(0xE4, 0xF0)]] = True
_SAME = np.arange(256, dtype=np.uint8)


class Units:
    """Spans of a block's bytes that are encoded on their own, in order.
    ``first[i]:first[i + 1]`` are the units of row ``i``."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, row_start: np.ndarray):
        self.bytes, self.starts, self.ends = data, starts, ends
        self.first = np.searchsorted(starts, row_start)


def word_units(words: kernel.Words) -> Units:
    """For tokenizers that drop white space, fold case, and always cut between a letter
    and a sign: words, cut there as well."""
    data = words.bytes
    cut = np.flatnonzero((_LETTER[data[:-1]] & _SIGN[data[1:]]) | (_SIGN[data[:-1]] & _LETTER[data[1:]])) + 1
    starts = np.sort(np.concatenate((words.starts, cut)))
    ends = np.sort(np.concatenate((words.ends, cut)))
    return Units(data, starts, ends, words.row_start)


def spaced_units(rows: list[bytes]) -> Units:
    """For byte-level tokenizers, which keep white space: cuts lie before white space
    that follows anything else, and between letters, digits and signs."""
    data, row_start = kernel.joined(rows, _SAME)
    before = np.zeros(len(data), bool)
    before[1:] = _INK[data[:-1]]
    high = np.zeros(len(data), bool)
    high[1:] = data[:-1] >= 0x80
    before[2:] |= high[2:] & _INK_2[data[:-2]]
    before[3:] |= high[3:] & _INK_3[data[:-3]]
    before[4:] |= high[4:] & (data[:-4] >= 0xF0)
    before &= _BLANK[data]
    kind = _KIND[data]
    before[1:] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    row_end = row_start[1:] - 1
    before[row_end] = False  # the blank after a row is not its own
    cut = np.flatnonzero(before)
    full = row_end > row_start[:-1]
    starts = np.sort(np.concatenate((row_start[:-1][full], cut)))
    ends = np.sort(np.concatenate((row_end[full], cut)))
    return Units(data, starts, ends, row_start)


class UnitEncoder:
    """Token ids of blocks of rows, with each distinct unit encoded once until the
    cache is emptied."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        added = self._tokenizer.get_added_tokens_decoder()
        self._added = [t.content.encode() for t in added.values()]
        self._between = next(t.content for t in added.values() if t.special)
        self._between_id = self._tokenizer.token_to_id(self._between)
        self.id_type = "<u2" if self._tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self._forget()

    def _forget(self) -> None:
        self._hashes = np.zeros(0, np.uint64)
        self._starts = np.zeros(0, np.int64)
        self._counts = np.zeros(0, np.int32)
        self._pool = np.zeros(0, self.id_type)

    def _plain(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.id_type)

    def _encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units joined, and their number for each: an added token, which is
        always cut out, stands between the units of a call."""
        found = []
        for i in range(0, len(units), _JOINED):
            ids = self._plain(self._between.join(units[i : i + _JOINED]))
            found += [ids, np.array([self._between_id], self.id_type)]
        ids = np.concatenate(found)
        ends = np.flatnonzero(ids == self._between_id)
        if len(ends) != len(units):
            raise ValueError("the tokenizer did not keep the units apart")
        return ids[ids != self._between_id], np.diff(ends, prepend=-1) - 1

    def _learn(self, hashes: np.ndarray, units: list[str]) -> None:
        ids, counts = self._encode(units)
        starts = len(self._pool) + np.cumsum(counts) - counts
        self._pool = np.concatenate((self._pool, ids))
        at = np.searchsorted(self._hashes, hashes)
        self._hashes = np.insert(self._hashes, at, hashes)
        self._starts = np.insert(self._starts, at, starts)
        self._counts = np.insert(self._counts, at, counts)

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self._hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self._hashes, hashes), len(self._hashes) - 1)
        return at, self._hashes[at] == hashes

    def encode(self, rows: list[bytes], units: Units) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all rows joined, and the count for each row."""
        data, starts, ends = units.bytes, units.starts, units.ends
        odd = [i for i, row in enumerate(rows) if any(t in row for t in self._added)]
        for i in odd:  # not to be learnt: the units hold what is not theirs
            ends[units.first[i] : units.first[i + 1]] = starts[units.first[i] : units.first[i + 1]]
        hashes = kernel.Prefix(data).spans(starts, ends)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self._hashes) > CACHED_UNITS:
            self._forget()
        at, known = self._find(distinct)
        if not known.all():
            new = np.flatnonzero(~known)
            raw = data.tobytes()
            texts = [
                raw[a:b].decode("utf-8", "replace")
                for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)
            ]
            self._learn(distinct[new], texts)
            at, known = self._find(distinct)
        counts = self._counts[at][back].astype(np.int64) if len(distinct) else np.zeros(0, np.int64)
        begin = self._starts[at][back] if len(distinct) else np.zeros(0, np.int64)
        ids = self._pool[kernel.ranges(begin, counts)]
        total = np.concatenate(([0], np.cumsum(counts)))
        per_row = np.diff(total[units.first])
        if odd:
            parts = np.split(ids, np.cumsum(per_row)[:-1])
            for i in odd:
                parts[i] = self._plain(rows[i].decode())
                per_row[i] = len(parts[i])
            ids = np.concatenate(parts)
        return ids, per_row


def unit_encoder(path: str) -> UnitEncoder:
    """The encoder of this Python worker; it outlives the task, with what it has learnt."""
    kept = vars(sys).setdefault("_breachscope_unit_encoders", {})
    if path not in kept:
        kept[path] = UnitEncoder(path)
    return kept[path]
