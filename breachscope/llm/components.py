"""Connected components of an edge table, by DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breachscope.session import release, settle


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)``; a component is named by
    its smallest node.

    Alternates two steps until nothing changes. Large star: every node links its
    larger neighbours to the smallest node it knows. Small star: every node links its
    smaller neighbours, and itself, to the smallest one. Both keep the components and
    shorten every path to its smallest node in about the logarithm of the number of
    nodes, and none of them makes more edges than there were. The rows of a hub are
    grouped by a partial minimum, and joined, never gathered in one list. Each round
    is written to the shared folder, so a lost executor costs one round at most.
    """
    pairs = settle(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    before = _marks(pairs)
    while True:
        both = pairs.union(pairs.select(F.col("v"), F.col("u")).toDF("u", "v"))
        # Written, so that adaptive execution can split the rows of a hub in the join.
        least_of = settle(
            both.groupBy("u").agg(F.min("v").alias("m")).select(
                F.col("u").alias("of"), F.least("u", "m").alias("m")
            )
        )
        large = (
            both.where("v > u")
            .join(least_of, F.col("u") == F.col("of"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = settle(large)
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("of"), "m")
        linked = large.join(least, F.col("u") == F.col("of"))
        small = settle(
            linked.where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(linked.select("u", F.col("m").alias("v")))
            .distinct()
        )
        after = _marks(small)
        release(pairs, least_of, large)  # the rounds before this one are not read again
        if after == before:
            break
        pairs, before = small, after
    return small.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        small.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _marks(pairs: DataFrame) -> tuple:
    """A count and two order-free sums that tell sets of pairs apart."""
    row = pairs.agg(
        F.count(F.lit(1)),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        F.sum(F.xxhash64(F.lit(3), "u", "v").cast("decimal(38,0)")),
    ).first()
    return tuple(row)
