"""Training sequences packed by best-fit decreasing.

Documents that fit a sequence stay whole; a longer one is cut into full sequences,
with what is left over as its first piece. First pieces are packed from the longest
to the shortest, each into the tightest open sequence that still holds it.

A sequence's state is its remaining capacity, so only the number of pieces of each
length decides what best fit does. Those counts (as many as a sequence has tokens)
go to the driver; a segment tree over the remaining capacities finds the tightest
one that is open, and pieces of one length are placed by runs: into a sequence go as
many as fit, as the one just filled stays the tightest, then into the next of equal
capacity. That is the packing of one piece after the other, in steps that follow the
number of lengths and not that of documents. Pieces find their place again by their
number among those of their length, which is counted in the tasks and offset by one
small row for each task; ids never leave the task that made them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from breachscope.llm import kernel, tokens
from breachscope.session import settle

SEQUENCE_TOKENS = 1024
BLOCK_BYTES = 1 << 19

# Numbers of one length in one task; beyond so many of them they are joined by a shuffle.
_BROADCAST_ENTRIES = 1 << 20


class OpenBins:
    """A segment tree over the capacities 0 to ``size``: each inner node knows whether
    a bin is open below it, so the tightest fit is found on one path."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.open = [False] * (2 * self.leaves)

    def mark(self, capacity: int, is_open: bool) -> None:
        node = self.leaves + capacity
        self.open[node] = is_open
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def tightest(self, capacity: int) -> int | None:
        """The smallest open capacity that is not less."""
        node = self.leaves + capacity
        if self.open[node]:
            return capacity
        while node > 1:
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


@dataclass(frozen=True)
class Run:
    """Pieces ``first`` to ``first + count - 1`` of one length: ``each`` of them go to a
    bin, from bin ``bin`` on, the first of them at ``offset``."""

    size: int
    first: int
    count: int
    each: int
    bin: int
    offset: int


def best_fit(counts: dict[int, int], length: int) -> tuple[list[Run], int]:
    """Where best-fit decreasing puts ``counts[size]`` pieces of each size, and the
    number of bins."""
    tree, ranges = OpenBins(length), {}
    runs: list[Run] = []
    bins = 0

    def hold(capacity: int, first: int, count: int) -> None:
        if capacity and count:
            ranges.setdefault(capacity, []).append((first, count))
            tree.mark(capacity, True)

    for size in sorted(counts, reverse=True):
        done, total = 0, counts[size]
        while done < total:
            capacity = tree.tightest(size)
            each = (capacity or length) // size
            wanted = -(-(total - done) // each)
            if capacity is None:
                capacity, first, there = length, bins, wanted
                bins += wanted
            else:
                first, there = ranges[capacity].pop()
                if not ranges[capacity]:
                    tree.mark(capacity, False)
            used = min(wanted, there)
            placed = min(total - done, used * each)
            runs.append(Run(size, done, placed, each, first, length - capacity))
            over = placed - (used - 1) * each  # pieces in the last bin
            hold(capacity, first + used, there - used)
            hold(capacity - over * size, first + used - 1, 1)
            hold(capacity - each * size, first, used - 1)
            done += placed
    return runs, bins


class Places:
    """Looks up the bin and offset of many pieces at once."""

    def __init__(self, runs: list[Run]):
        runs = sorted(runs, key=lambda r: (r.size, r.first))
        self.size, self.first, self.each, self.bin, self.offset = (
            np.array([getattr(r, name) for r in runs], np.int64)
            for name in ("size", "first", "each", "bin", "offset")
        )
        self.bounds = np.searchsorted(self.size, np.arange(self.size.max(initial=0) + 2))

    def find(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.empty(len(size), np.int64)
        for s in np.unique(size):
            own = size == s
            low, high = self.bounds[s], self.bounds[s + 1]
            at[own] = low + np.searchsorted(self.first[low:high], rank[own], "right") - 1
        inside = rank - self.first[at]
        return (
            self.bin[at] + inside // self.each[at],
            self.offset[at] + inside % self.each[at] * size,
        )


def tokenized(docs: DataFrame, tokenizer: str, end_id: int, length: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, doc_tokens, head, head_rank, full_rank, part, ids`` of each document.

    ``head`` is the length of the first piece; ``head_rank`` numbers the first pieces
    of that length in the task ``part``, ``full_rank`` counts its full pieces before this
    document. ``ids`` are little-endian unsigned 32-bit numbers."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.unit_encoder(tokenizer)
        part = TaskContext.get().partitionId()
        closing = int(end_id).to_bytes(4, "little")
        of_size, full = [0] * (length + 1), 0
        for batch in batches:
            for start, rows in kernel.text_blocks(batch.column(1), BLOCK_BYTES):
                ids, counts = encoder.encode(rows, tokens.spaced_units(rows))
                raw = ids.astype("<u4").tobytes()
                out, end = [], 0
                for count in counts.tolist():
                    n = count + 1
                    head = (n - 1) % length + 1
                    out.append((n, head, of_size[head], full, raw[end : end + 4 * count] + closing))
                    end += 4 * count
                    of_size[head] += 1
                    full += n // length - (head == length)
                n, head, rank, before, packed = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(rows)),
                        pa.array(n, pa.int64()),
                        pa.array(head, pa.int32()),
                        pa.array(rank, pa.int64()),
                        pa.array(before, pa.int64()),
                        pa.array([part] * len(rows), pa.int32()),
                        pa.array(packed, pa.binary()),
                    ],
                    names=["doc_id", "doc_tokens", "head", "head_rank", "full_rank", "part", "ids"],
                )

    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    fields = "doc_id long, doc_tokens long, head int, head_rank long, full_rank long, part int, ids binary"
    return source.mapInArrow(encode, fields)


def _before(made: DataFrame, length: int) -> DataFrame:
    """``of_part, before``: for each task the pieces of each length in earlier tasks;
    key 0 has the full pieces."""
    heads = made.groupBy("part", "head").agg(F.count(F.lit(1)).alias("n"))
    full = (F.col("doc_tokens") - F.col("head")) / length
    fulls = made.groupBy("part").agg(F.sum(full.cast("bigint")).alias("n"))
    both = heads.unionByName(fulls.select("part", F.lit(0).alias("head"), "n"))
    earlier = Window.partitionBy("head").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return (
        both.withColumn("b", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("bigint")))
        .groupBy("part")
        .agg(F.map_from_entries(F.collect_list(F.struct("head", "b"))).alias("before"))
        .withColumnRenamed("part", "of_part")
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    length: int = SEQUENCE_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, sequence_id, offset, ids``.

    ``tokenizer`` is the path of a byte-level tokenizer's file that every executor can
    open. A document is its token ids and ``end_id``; null text is empty and makes a
    piece of one token. Documents of equal length are placed as they were read; null
    and repeated ids change nothing, each row is packed. An empty input gives an
    empty result. ``ids`` are little-endian unsigned 32-bit numbers.
    """
    made = settle(tokenized(docs, tokenizer, end_id, length, id_col, text_col))
    before = settle(_before(made, length))
    held = made.groupBy("head").agg(F.count(F.lit(1)).alias("n")).collect()
    runs, bins = best_fit({r["head"]: r["n"] for r in held}, length)
    entries = before.agg(F.sum(F.size("before"))).first()[0] or 0
    if entries <= _BROADCAST_ENTRIES:
        before = F.broadcast(before)
    numbered = made.join(before, F.col("part") == F.col("of_part")).select(
        "doc_id",
        "head",
        (F.col("head_rank") + F.element_at("before", F.col("head"))).alias("rank"),
        (F.col("full_rank") + F.element_at("before", F.lit(0))).alias("full"),
        "ids",
    )
    places = Places(runs)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, rows in kernel.text_blocks(batch.column(4), BLOCK_BYTES):
                block = batch.slice(begin, len(rows))
                head, rank, full = (block.column(i).to_numpy().astype(np.int64) for i in (1, 2, 3))
                bin_of, offset = places.find(head, rank)
                sizes = np.fromiter(map(len, rows), np.int64, len(rows)) // 4
                pieces = (sizes - head) // length + 1
                row = np.repeat(np.arange(len(rows)), pieces)
                piece = kernel.ranges(np.zeros(len(rows), np.int64), pieces)
                is_head = piece == 0
                start = np.where(is_head, 0, head[row] + (piece - 1) * length)
                size = np.where(is_head, head[row], length)
                cut = [
                    rows[r][4 * a : 4 * (a + n)]
                    for r, a, n in zip(row.tolist(), start.tolist(), size.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column(0).take(pa.array(row)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(size),
                        pa.array(np.where(is_head, bin_of[row], bins + full[row] + piece - 1)),
                        pa.array(np.where(is_head, offset[row], 0)),
                        pa.array(cut, pa.binary()),
                    ],
                    names=["doc_id", "piece", "start", "length", "sequence_id", "offset", "ids"],
                )

    fields = "doc_id long, piece int, start long, length long, sequence_id long, offset long, ids binary"
    return numbered.mapInArrow(place, fields)
