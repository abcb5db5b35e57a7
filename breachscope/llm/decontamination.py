"""Benchmark passages in documents, found by pigeonhole pieces and bit-parallel distance.

An item of ``m`` words may occur with up to ``k`` word edits. Cut into ``k + 1``
pieces, at least one piece of such an occurrence is untouched, so exact hits of the
pieces find every place to look at. There, Myers' algorithm computes the distance of
the item to the best-fitting stretch of the document, a whole column of the table in
a few operations on one wide integer.

Words are maximal runs of letters and digits, A-Z lower-cased; every other ASCII
character separates them. The items are the stated query set: they travel to the
tasks in blocks of a bounded size, and each block passes once over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breachscope.llm import kernel

SIMILARITY = 0.8
MIN_WORDS = 5
BLOCK_TEXT = 8 << 20  # bytes of item texts that travel at once

_FILTER_BITS = 20


@dataclass(frozen=True)
class Pieces:
    """Items as word hashes, and their pieces sorted by (length, hash)."""

    ids: list
    words: list[np.ndarray]
    allowed: list[int]
    by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def _sequence_hashes(hashes: np.ndarray, length: int, running: np.ndarray | None = None) -> np.ndarray:
    """Hash of every run of ``length`` words, from that of the runs one word shorter."""
    if length == 1:
        return hashes
    longer = running[: max(len(hashes) - length + 1, 0)] * np.uint64(0x9FB21C651E98DF25)
    return kernel.mix(longer ^ hashes[length - 1 :])


def cut_items(ids: list, texts: list[bytes], similarity: float, min_words: int) -> Pieces:
    words = kernel.Words(texts, space=kernel.SIGNS)
    kept, sequences, allowed = [], [], []
    raw: dict[int, list[tuple[int, int, int]]] = {}
    for i, item in enumerate(ids):
        w = words.hashes[words.first[i] : words.first[i + 1]]
        if len(w) < max(min_words, 1):
            continue
        k = min(int(len(w) * (1 - similarity) + 1e-9), len(w) - 1)
        bounds = [len(w) * j // (k + 1) for j in range(k + 2)]
        for a, b in zip(bounds, bounds[1:], strict=False):
            h = w[a : a + 1]
            for step in range(2, b - a + 1):
                h = _sequence_hashes(w[a : a + step], step, h)
            raw.setdefault(b - a, []).append((int(h[0]), len(kept), a))
        kept.append(item)
        sequences.append(w)
        allowed.append(k)
    by_length = {}
    for length, found in raw.items():
        found.sort()
        h = np.array([x[0] for x in found], np.uint64)
        seen = np.zeros(1 << _FILTER_BITS, bool)
        seen[(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        by_length[length] = (
            h, np.array([x[1] for x in found]), np.array([x[2] for x in found]), seen
        )
    return Pieces(kept, sequences, allowed, by_length)


def _piece_hits(words: kernel.Words, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, item and the word where the item would start, for every exact piece hit."""
    rows, items, starts = [], [], []
    running = words.hashes
    for length in range(1, max(pieces.by_length, default=0) + 1):
        running = _sequence_hashes(words.hashes, length, running)
        if length not in pieces.by_length or not len(running):
            continue
        h, item, offset, seen = pieces.by_length[length]
        at = np.flatnonzero(seen[(running >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        low = np.searchsorted(h, running[at], "left")
        count = np.searchsorted(h, running[at], "right") - low
        at, low, count = at[count > 0], low[count > 0], count[count > 0]
        row = np.searchsorted(words.first, at, "right") - 1
        inside = at + length <= words.first[row + 1]
        at, low, count, row = at[inside], low[inside], count[inside], row[inside]
        which = kernel.ranges(low, count)
        rows.append(np.repeat(row, count))
        items.append(item[which])
        starts.append(np.repeat(at, count) - offset[which])
    if not rows:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(rows), np.concatenate(items), np.concatenate(starts)


def best_fit(pattern: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to any stretch of ``text`` and the first
    place, as a count of words, where such a stretch ends."""
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    match: dict[int, int] = {}
    for i, symbol in enumerate(pattern.tolist()):
        match[symbol] = match.get(symbol, 0) | 1 << i
    up, down, score = full, 0, m
    best, end = m, 0
    for j, symbol in enumerate(text.tolist(), 1):
        eq = match.get(symbol, 0)
        vertical = eq | down
        diagonal = ((((eq & up) + up) ^ up) | eq) & full
        plus = down | ~(diagonal | up) & full
        minus = up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus = plus << 1 & full
        minus = minus << 1 & full
        up = minus | ~(vertical | plus) & full
        down = plus & vertical
        if score < best:
            best, end = score, j
    return best, end


def _verify(words: kernel.Words, pieces: Pieces) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item, distance, first word, end) of the best occurrence of each item."""
    rows, items, starts = _piece_hits(words, pieces)
    order = np.lexsort((starts, items, rows))
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    i, n = 0, len(order)
    rows, items, starts = rows[order].tolist(), items[order].tolist(), starts[order].tolist()
    while i < n:
        row, item, first = rows[i], items[i], starts[i]
        k, w = pieces.allowed[item], pieces.words[item]
        last = first
        while i < n and rows[i] == row and items[i] == item and starts[i] <= last + k:
            last = starts[i]
            i += 1
        low = max(first - k, int(words.first[row]))
        high = min(last + len(w) + k, int(words.first[row + 1]))
        text = words.hashes[low:high]
        distance, end = best_fit(w, text)
        if distance > k:
            continue
        _, back = best_fit(w[::-1], text[:end][::-1])
        found = (distance, low + end - back, low + end)
        if (row, item) not in best or found < best[row, item]:
            best[row, item] = found
    for (row, item), (distance, a, b) in best.items():
        yield row, item, distance, a - int(words.first[row]), b - int(words.first[row])


def _item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[list, list[bytes]]]:
    """The items by hash, in blocks of about ``BLOCK_TEXT`` bytes."""
    narrow = items.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // BLOCK_TEXT)
    for block in range(count):
        part = narrow.where(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == block) if count > 1 else narrow
        rows = sorted(part.collect(), key=lambda r: (r["id"] is None, r["id"], r["text"]))
        yield [r["id"] for r in rows], [r["text"].encode() for r in rows]


def leaks(
    docs: DataFrame,
    items: DataFrame,
    similarity: float = SIMILARITY,
    min_words: int = MIN_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, item_id, item_words, distance, first_word, end_word``: one row for each
    document row and item that occurs in it with at most ``(1 - similarity)`` of its
    words edited, at its best place (least distance, then earliest).

    Items of fewer than ``min_words`` words say too little and match nothing, as do
    null and empty texts. Items with equal texts are all reported. Repeated document
    rows are searched one by one and reported as often; a null id stays null.
    """
    spark = docs.sparkSession
    id_type = items.schema[item_id_col].dataType.simpleString()
    made = f"doc_id long, item_id {id_type}, item_words int, distance int, first_word int, end_word int"
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    found = []
    for ids, texts in _item_blocks(items, item_id_col, item_text_col):
        pieces = cut_items(ids, texts, similarity, min_words)
        shared = spark.sparkContext.broadcast(tuple(vars(pieces).values()))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            pieces = Pieces(*shared.value)
            for batch in batches:
                rows = kernel.byte_rows(batch.column(1))
                doc_ids = batch.column(0)
                for a, b in kernel.blocks(rows):
                    hits = list(_verify(kernel.Words(rows[a:b], space=kernel.SIGNS), pieces))
                    if not hits:
                        continue
                    row, item, distance, first, end = zip(*hits, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            doc_ids.take(pa.array([a + r for r in row])),
                            pa.array([pieces.ids[i] for i in item]),
                            pa.array([len(pieces.words[i]) for i in item], pa.int32()),
                            pa.array(distance, pa.int32()),
                            pa.array(first, pa.int32()),
                            pa.array(end, pa.int32()),
                        ],
                        names=["doc_id", "item_id", "item_words", "distance", "first_word", "end_word"],
                    )

        found.append(source.mapInArrow(search, made))
    if not found:
        return spark.createDataFrame([], made)
    return reduce(DataFrame.unionAll, found)


def without_leaks(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents in which no item was found. Rows with a null id stay."""
    bad = found.select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, docs[id_col] == F.col("_bad"), "left_anti")


