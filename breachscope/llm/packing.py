"""Training sequences packed along a space-filling curve.

Each document becomes a vector of hashed word counts, projected to a few
dimensions; its cell in that space gives a Hilbert key. Documents are range-sorted
by (key, id), so that neighbours on the curve share a sequence, and the token
stream in that order is cut every ``length`` tokens: only the last sequence of all
is padded.

Tokens are made once and written with the key of their document. Only (key, id,
count) is range-sorted; a running sum inside each range and over the ranges (one
small row each) gives every document its first token's place in the stream, and
the ids join that by row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from breachscope.llm import kernel, tokens
from breachscope.session import settle

SEQUENCE_TOKENS = 4096
DIMENSIONS = 3
BITS = 10  # cells per dimension: 2**BITS
_HASHED = 4096  # length of the hashed word-count vector
_BLOCK_BYTES = 1 << 19


def projection(dimensions: int = DIMENSIONS) -> np.ndarray:
    """A fixed random direction for each dimension of the small space."""
    return np.random.default_rng(7).standard_normal((_HASHED, dimensions)).astype(np.float32)


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each cell (one row of whole numbers below ``2**bits``) on the curve.

    Works from the highest bit down, exchanging or reflecting the lower bits of the
    axes as the curve turns; all rows at once.
    """
    axes = cells.astype(np.int64).copy()
    dims = axes.shape[1]
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for d in range(dims):
            turned = (axes[:, d] & bit) != 0
            swap = np.where(turned, 0, (axes[:, 0] ^ axes[:, d]) & low)
            axes[:, 0] ^= np.where(turned, low, swap)
            axes[:, d] ^= swap
        bit >>= 1
    for d in range(1, dims):
        axes[:, d] ^= axes[:, d - 1]
    flip = np.zeros(len(axes), np.int64)
    bit = 1 << (bits - 1)
    while bit > 1:
        flip ^= np.where(axes[:, dims - 1] & bit, bit - 1, 0)
        bit >>= 1
    axes ^= flip[:, None]
    keys = np.zeros(len(axes), np.int64)
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            keys = (keys << 1) | ((axes[:, d] >> b) & 1)
    return keys


def curve_keys(words: kernel.Words, directions: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert key of each row from its hashed word counts.

    The projection of a unit vector on a random direction is about normal with the
    variance 1, so the normal distribution's rank makes the cells about equal."""
    n = len(words.first) - 1
    place = (words.hashes & np.uint64(_HASHED - 1)).astype(np.int64)
    sums = np.zeros((len(place) + 1, directions.shape[1]))
    np.cumsum(directions[place], axis=0, dtype=np.float64, out=sums[1:])
    vectors = sums[words.first[1:]] - sums[words.first[:-1]]
    size = np.sqrt(np.maximum(np.diff(words.first), 1))[:, None]
    rank = 0.5 * (1 + np.tanh(0.8 * vectors / size))
    cells = np.minimum((rank * (1 << bits)).astype(np.int64), (1 << bits) - 1)
    return hilbert_keys(cells, bits) if n else np.zeros(0, np.int64)


def tokenized(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """``key, doc_id, doc_tokens, ids``; ids are little-endian unsigned 16-bit numbers."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, directions = tokens.unit_encoder(tokenizer), projection()
        if np.dtype(encoder.id_type).itemsize != 2:
            raise ValueError("ids of this tokenizer do not fit 16 bits")
        closing = int(end_id).to_bytes(2, "little")
        for batch in batches:
            for a, rows in kernel.text_blocks(batch.column(1), _BLOCK_BYTES):
                words = kernel.Words(rows)
                ids, counts = encoder.encode(rows, tokens.word_units(words))
                keys = curve_keys(words, directions)
                ends = np.cumsum(counts)
                raw = ids.astype("<u2").tobytes()
                packed = [
                    raw[2 * (e - c) : 2 * e] + closing
                    for e, c in zip(ends.tolist(), counts.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys),
                        batch.column(0).slice(a, len(rows)),
                        pa.array(counts + 1),
                        pa.array(packed, pa.binary()),
                    ],
                    names=["key", "doc_id", "doc_tokens", "ids"],
                )

    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(encode, "key long, doc_id long, doc_tokens long, ids binary")


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    length: int = SEQUENCE_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids``.

    ``tokenizer`` is the path of a tokenizer file that every executor can open. A
    document is its token ids and ``end_id``; null text is empty and so is one piece
    of one token. Equal keys follow the id, null first; rows with equal key and id are
    alike or follow their ids. An empty input gives an empty result. A tokenizer of
    more than 65,536 ids is refused.
    """
    made = settle(
        tokenized(docs, tokenizer, end_id, id_col, text_col).withColumn(
            "place", F.monotonically_increasing_id()
        )
    )
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # Equal texts have one key; id and place split them over range partitions.
    ordered = settle(
        made.select("key", "doc_id", "place", "doc_tokens")
        .repartitionByRange(parts, "key", "doc_id", "place")
        .sortWithinPartitions("key", "doc_id", "place")
        .withColumn("part", F.spark_partition_id())
        .withColumn("rank", F.monotonically_increasing_id())
    )
    totals = ordered.groupBy("part").agg(F.sum("doc_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select(
        F.col("part").alias("of_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_token")
    )
    within = Window.partitionBy("part").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ordered.withColumn("earlier", F.coalesce(F.sum("doc_tokens").over(within), F.lit(0)))
        .join(F.broadcast(first), F.col("part") == F.col("of_part"))
        .select(F.col("place").alias("of_place"), (F.col("first_token") + F.col("earlier")).alias("from"))
    )
    placed = made.join(starts, F.col("place") == F.col("of_place")).select(
        "doc_id", "doc_tokens", "from", "ids"
    )
    return _cut(placed, length)


def _cut(placed: DataFrame, length: int) -> DataFrame:
    """Cut each document where a sequence ends."""
    size = F.lit(length).cast("bigint")
    last = F.col("from") + F.col("doc_tokens") - 1
    pieces = placed.select(
        "doc_id",
        "doc_tokens",
        "from",
        "ids",
        F.explode(
            F.sequence(F.floor(F.col("from") / size), F.floor(last / size))
        ).alias("sequence_id"),
    )
    begin = F.greatest(F.col("from"), F.col("sequence_id") * size)
    end = F.least(F.col("from") + F.col("doc_tokens"), (F.col("sequence_id") + 1) * size)
    cut = pieces.withColumn("_b", begin).withColumn("_e", end)
    start = F.col("_b") - F.col("from")
    return cut.select(
        "doc_id",
        start.alias("start"),
        (F.col("_e") - F.col("_b")).alias("length"),
        "doc_tokens",
        "sequence_id",
        (F.col("_b") - F.col("sequence_id") * size).alias("offset"),
        F.substring("ids", (start * 2 + 1).cast("int"), ((F.col("_e") - F.col("_b")) * 2).cast("int")).alias("ids"),
    )


def wide_crc(pieces: DataFrame, keep_ids: bool = False) -> DataFrame:
    """Replace ``ids`` by ``ids_crc32``, the CRC-32 of the ids as 32-bit numbers; with
    ``keep_ids`` the ids follow as the last column."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            crc = [
                zlib.crc32(np.frombuffer(x, "<u2").astype("<u4").tobytes())
                for x in batch.column(at).to_pylist()
            ]
            columns = [pa.array(crc, pa.int64()) if i == at else c for i, c in enumerate(batch.columns)]
            names = ["ids_crc32" if n == "ids" else n for n in batch.schema.names]
            if keep_ids:
                columns, names = [*columns, batch.column(at)], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = ", ".join(
        "ids_crc32 long" if name == "ids" else f"{name} {kind}" for name, kind in pieces.dtypes
    )
    return pieces.mapInArrow(digest, fields + ", ids binary" * keep_ids)
