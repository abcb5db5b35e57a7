"""Shards of equal bytes through a fixed number of virtual slots.

A record is hashed to one of ``SLOTS`` virtual slots for good. Bytes and rows are
summed per slot, and a versioned map says which shard each slot belongs to. The
map has a fixed number of rows, so it is made on the driver and broadcast whatever
the size of the data. Rebalancing edits the map: it moves as few slots as it can
and writes the next version.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from breachscope.session import settle

SLOTS = 16384
ROW_BYTES = 16


@dataclass(frozen=True)
class SlotMap:
    """``shard_of[v]`` is the shard of virtual slot ``v``."""

    version: int
    shards: int
    shard_of: tuple[int, ...]

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(self.version, self.shards, v, s) for v, s in enumerate(self.shard_of)]
        return spark.createDataFrame(rows, "version int, shards int, virtual_slot int, shard int")


def balanced_map(slot_bytes: Sequence[int], shards: int, version: int = 1) -> SlotMap:
    """Largest slot first, each to the shard with the fewest bytes."""
    shard_of = [0] * len(slot_bytes)
    heap = [(0, s) for s in range(shards)]
    for v in sorted(range(len(slot_bytes)), key=lambda v: (-slot_bytes[v], v)):
        held, s = heap[0]
        shard_of[v] = s
        heapq.heapreplace(heap, (held + slot_bytes[v], s))
    return SlotMap(version, shards, tuple(shard_of))


def rebalanced_map(old: SlotMap, slot_bytes: Sequence[int], shards: int) -> SlotMap:
    """The next version of a map for new sizes or another number of shards.

    Slots of shards that no longer exist are dealt out first. Then each shard
    above the mean gives slots, the largest first, to the emptiest shard, where that
    brings both nearer to the mean; all other slots stay where they are.
    """
    shard_of = list(old.shard_of)
    held = [0] * shards
    members: list[list[int]] = [[] for _ in range(shards)]
    homeless = []
    for v, s in enumerate(shard_of):
        if s < shards:
            held[s] += slot_bytes[v]
            members[s].append(v)
        else:
            homeless.append(v)
    heap = [(held[s], s) for s in range(shards)]
    heapq.heapify(heap)

    def give(v: int) -> None:
        size, s = heapq.heappop(heap)
        shard_of[v] = s
        held[s] = size + slot_bytes[v]
        heapq.heappush(heap, (held[s], s))

    for v in sorted(homeless, key=lambda v: (-slot_bytes[v], v)):
        give(v)
    mean = sum(held) / shards
    for s in sorted(range(shards), key=lambda s: (-held[s], s)):
        for v in sorted(members[s], key=lambda v: (-slot_bytes[v], v)):
            while heap[0][0] != held[heap[0][1]]:  # entry of a shard that has given since
                _, stale = heapq.heappop(heap)
                heapq.heappush(heap, (held[stale], stale))
            size, target = heap[0]
            if target == s or held[s] <= mean:
                break
            if 0 < slot_bytes[v] <= 2 * min(held[s] - mean, mean - size):
                held[s] -= slot_bytes[v]
                give(v)
    return SlotMap(old.version + 1, shards, tuple(shard_of))


def records(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot``; the text itself does not travel."""
    text = F.col(text_col)
    crc = F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("bigint").alias("size"),
        crc.alias("text_crc32"),
        F.pmod(F.xxhash64(F.col(id_col), crc), F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def slot_sizes(placed: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows per virtual slot: a fixed number of rows for the driver."""
    sizes, rows = [0] * slots, [0] * slots
    summed = placed.groupBy("virtual_slot").agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n"))
    for r in summed.collect():
        sizes[r["virtual_slot"]], rows[r["virtual_slot"]] = r["s"], r["n"]
    return sizes, rows


def shard(docs: DataFrame, shards: int, slots: int = SLOTS, slot_map: SlotMap | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot, virtual_slot, map_version``.

    ``slot`` numbers the rows of a shard from 0 without gaps: each virtual slot
    starts where the one before it ends, and its rows are numbered by id, checksum
    and size. Null text has no bytes and the checksum of the empty text; a null id
    is hashed like any other. Rows that are alike in all of this share a virtual
    slot and get different numbers. An empty input gives an empty result.
    """
    spark = docs.sparkSession
    placed = settle(records(docs, slots))
    sizes, rows = slot_sizes(placed, slots)
    slot_map = slot_map or balanced_map(sizes, shards)
    filled = [0] * slot_map.shards
    table = []
    for v, s in enumerate(slot_map.shard_of):
        table.append((v, s, filled[s], slot_map.version))
        filled[s] += rows[v]
    where = spark.createDataFrame(
        table, "virtual_slot int, shard int, starts_at bigint, map_version int"
    )
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        placed.withColumn("rank", F.row_number().over(inside))
        .join(F.broadcast(where), "virtual_slot")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "shard",
            (F.col("starts_at") + F.col("rank") - 1).alias("slot"),
            "virtual_slot",
            "map_version",
        )
    )


def write_shards(docs: DataFrame, slot_map: SlotMap, path: str, slots: int = SLOTS) -> None:
    """Write the records with their shard as a partition column.

    Rows are dealt by virtual slot, so a shard is written by many tasks and a task
    holds few shards.
    """
    spark = docs.sparkSession
    v = F.pmod(
        F.xxhash64(F.col("doc_id"), F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))),
        F.lit(slots),
    ).cast("int")
    where = slot_map.frame(spark).select("virtual_slot", F.col("shard").alias("_shard"))
    (
        docs.withColumn("_virtual_slot", v)
        .join(F.broadcast(where), F.col("_virtual_slot") == F.col("virtual_slot"))
        .drop("virtual_slot", "_virtual_slot")
        .hint("rebalance", "_shard")
        .write.mode("errorifexists")
        .partitionBy("_shard")
        .parquet(path)
    )
