"""Column-wise text work inside Python tasks: bytes, words and shingles as arrays.

Everything here runs over one Arrow batch that Spark hands to a task. A batch is
cut into blocks of whole rows of a few megabytes, so that the wide arrays (eight
bytes per text byte) stay small; only a single row beyond that makes a larger one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20

_rng = np.random.default_rng(20240607)
_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

# White space and every other ASCII character that is neither a letter nor a digit.
SIGNS = np.zeros(256, dtype=bool)
SIGNS[:128] = [not chr(i).isalnum() for i in range(128)]

_powers: list[np.ndarray] = [np.ones(0, np.uint64), np.ones(0, np.uint64)]


def _power_tables(length: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < length:
        for i, factor in enumerate((_BASE, _INVERSE)):
            table = np.full(length, factor, np.uint64)
            table[0] = 1
            _powers[i] = np.cumprod(table)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word; bijective."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def byte_rows(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each row; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    else:
        column = column.cast(pa.binary())
    return [b"" if x is None else x for x in column.to_pylist()]


def blocks(rows: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole rows with at most ``limit`` bytes, one row at least."""
    start, held = 0, 0
    for i, row in enumerate(rows):
        if i > start and held + len(row) > limit:
            yield start, i
            start, held = i, 0
        held += len(row)
    if start < len(rows):
        yield start, len(rows)


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Where each block of rows starts, and its rows as UTF-8 bytes (null is empty).
    Only one block at a time becomes Python objects."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(column):
        held = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, held + limit, "right")))
        yield start, byte_rows(column.slice(start, stop - start))
        start = stop


class Prefix:
    """Polynomial hashes of any span of a buffer, from one running sum."""

    def __init__(self, buffer: np.ndarray):
        powers, self._inverse = _power_tables(len(buffer) + 1)
        terms = _VALUES[buffer]
        terms *= powers[: len(buffer)]
        self._sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum(terms, out=self._sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._inverse[starts])

    def windows(self, size: int) -> np.ndarray:
        """Hash of every span of ``size`` bytes."""
        count = len(self._sums) - size
        if count <= 0:
            return np.zeros(0, np.uint64)
        return mix((self._sums[size:] - self._sums[:count]) * self._inverse[:count])


def joined(rows: list[bytes], fold: np.ndarray = _LOWER) -> tuple[np.ndarray, np.ndarray]:
    """All rows in one array with a blank after each, and where each row starts."""
    data = np.frombuffer(b" ".join(rows) + b" ", np.uint8)
    lengths = np.fromiter(map(len, rows), np.int64, len(rows))
    return fold[data], np.concatenate(([0], np.cumsum(lengths + 1)))


class Words:
    """The words of a block of rows: maximal runs without ASCII white space,
    A-Z lower-cased. ``first[i]:first[i + 1]`` are the words of row ``i``."""

    def __init__(self, rows: list[bytes], fold: np.ndarray = _LOWER, space: np.ndarray = _SPACE):
        self.bytes, self.row_start = joined(rows, fold)
        blank = space[self.bytes]
        change = np.flatnonzero(np.diff(np.concatenate(([True], blank)).view(np.int8)))
        self.starts, self.ends = change[0::2], change[1::2]
        self.hashes = Prefix(self.bytes).spans(self.starts, self.ends)
        self.first = np.searchsorted(self.starts, self.row_start)

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the word sequences of length ``size`` and their bounds by row.

        A row with fewer words, but at least one, has its whole sequence as its
        only shingle.
        """
        hashes, first = self.hashes, self.first
        counts = np.diff(first)
        made = np.maximum(counts - size + 1, (counts > 0).astype(np.int64))
        bounds = np.concatenate(([0], np.cumsum(made)))
        out = np.zeros(bounds[-1], np.uint64)
        running = hashes.copy()
        by_length = [running]
        for step in range(1, size):
            longer = running[: max(len(hashes) - step, 0)].copy()
            longer *= np.uint64(0x9FB21C651E98DF25)
            longer ^= hashes[step:]
            running = mix(longer)
            by_length.append(running)
        full = np.flatnonzero(counts >= size)
        if len(full):
            take = np.repeat(first[full] - bounds[full], made[full])
            place = _ranges(bounds[full], made[full])
            out[place] = by_length[size - 1][place + take]
        for length in range(1, size):
            short = np.flatnonzero(counts == length)
            out[bounds[short]] = by_length[length - 1][first[short]]
        return out, bounds


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, joined."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + counts, counts)


ranges = _ranges


def signed(h: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return h.view(np.int64)
