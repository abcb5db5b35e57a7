"""Exact duplicates by two passes over a Bloom filter. DataFrame functions only.

Pass one sets, for every text digest, two bits of one filter word and counts how
many rows set each bit; a second filter keeps the bits that two rows or more have
set. Pass two tests each row against that second filter. A row that finds one of
its bits missing has no copy, for copies set the same bits: it goes straight
through. Only the others are shuffled, by digest, and decided exactly.

The texts are read once. What both passes scan is a table of ids and digests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breachscope.session import settle

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# The repeated-bits filter is broadcast up to this many words (16 bytes each).
BROADCAST_WORDS = 2_000_000


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.cast("int"))


def _placed(digests: DataFrame, words: int) -> DataFrame:
    h = F.xxhash64(F.lit(17), "digest")
    one, two = h.bitwiseAND(63), F.shiftright(h, 6).bitwiseAND(63)
    return digests.select(
        "doc_id",
        "digest",
        F.pmod(F.xxhash64(F.lit(29), "digest"), F.lit(words)).alias("word"),
        _bit(one).alias("bit_one"),
        _bit(two).alias("bit_two"),
    )


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    broadcast_words: int = BROADCAST_WORDS,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty,
    so null and empty texts form one group. The row with the largest id stays.
    Rows that repeat id and text are all marked kept and all counted. A group
    without any id has the keep id null and its rows are kept. An empty input
    gives an empty result; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    digests = settle(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.unhex(F.sha2(ascii_lower(text), 256)).alias("digest"),
        )
    )
    # Eight bits a row: about one row in 25 without a copy is shuffled for nothing.
    words = max(1, digests.count() // 8)
    placed = _placed(digests, words)
    repeated = settle(
        placed.select("word", F.explode(F.array_distinct(F.array("bit_one", "bit_two"))).alias("bit"))
        .groupBy("word", "bit")
        .count()
        .where("count > 1")
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
    )
    if repeated.count() <= broadcast_words:
        repeated = F.broadcast(repeated)
    mask = F.col("bit_one").bitwiseOR(F.col("bit_two"))
    tested = placed.join(repeated, "word", "left").select(
        "doc_id",
        "digest",
        F.coalesce(F.col("bits").bitwiseAND(mask) == mask, F.lit(False)).alias("maybe"),
    )
    suspects = tested.where("maybe").select("doc_id", "digest")
    # Written, so that adaptive execution can split a large group in the join below.
    groups = settle(
        suspects.groupBy("digest")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
    )
    decided = suspects.join(groups, "digest", "left")
    single = tested.where("NOT maybe").select(
        "digest", "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size")
    )
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return decided.unionByName(single).select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
