"""URL filter lists as of the time of each fetch. DataFrame functions only.

A list is a table of dated entries: from ``listed_at`` on, a pattern is blocked, allowed
or no longer listed. The entries of a pattern follow one another, so each is valid until
the next one: the list becomes validity intervals. A capture is expanded to the few
patterns that could name it (its host and parent domains, and its path prefixes), joined
to the intervals by pattern, and keeps those that held when it was fetched. The most
specific one decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Intervals are broadcast up to this many (some 100 bytes each).
BROADCAST_ENTRIES = 500_000

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-cased host without a leading ``www.``; null where there is none."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, _HOST, 1)), r"^www\.|\.$", "")
    return F.when(host != "", host)


def validity(entries: DataFrame) -> DataFrame:
    """``pattern, action, valid_from, valid_to`` from ``pattern, action, listed_at``.

    Entries of a pattern at one time: the last action in the alphabet holds (remove,
    block, allow from strong to weak). Rows without a pattern, an action or a time are
    not entries. The entries of one pattern are one window group: a pattern's history,
    not its captures.
    """
    known = entries.where(
        F.col("pattern").isNotNull() & F.col("action").isNotNull() & F.col("listed_at").isNotNull()
    )
    at_once = known.groupBy("pattern", "listed_at").agg(F.max("action").alias("action"))
    following = F.lead("listed_at").over(Window.partitionBy("pattern").orderBy("listed_at"))
    return (
        at_once.withColumn("valid_to", following)
        .where(F.col("action").isin("block", "allow"))
        .select("pattern", "action", F.col("listed_at").alias("valid_from"), "valid_to")
    )


def _patterns(labels_at_most: int, segments_at_most: int) -> Column:
    """The patterns that can name ``host`` and ``path``, with their specificity.

    No pattern of the list has more labels or segments than the limits, so longer
    candidates are not made."""
    labels = F.split("host", r"\.")
    n = F.size(labels)
    lowest = F.greatest(n - labels_at_most + 1, F.lit(1))
    highest = n
    parents = F.when(
        F.col("host").isNotNull() & (lowest <= highest),
        F.transform(
            F.sequence(lowest, highest),
            lambda i: F.struct(
                F.array_join(F.slice(labels, i, n), ".").alias("pattern"), (n - i + 1).alias("specific")
            ),
        ),
    )
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    depth = F.least(F.size(segments), F.lit(segments_at_most))
    prefixes = F.when(
        F.col("host").isNotNull() & (depth > 0),
        F.transform(
            F.sequence(F.lit(1), depth),
            lambda k: F.struct(
                F.concat("host", F.lit("/"), F.array_join(F.slice(segments, F.lit(1), k), "/")).alias("pattern"),
                (k + 1000).alias("specific"),
            ),
        ),
    )
    empty = F.expr("cast(array() as array<struct<pattern:string,specific:int>>)")
    return F.concat(F.coalesce(parents, empty), F.coalesce(prefixes, empty))


def filter_urls(
    captures: DataFrame,
    entries: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    time_col: str = "fetched_at",
    broadcast_entries: int = BROADCAST_ENTRIES,
) -> DataFrame:
    """``page_id, url, fetched_at, host, blocked, action, pattern, since``, a row per capture.

    A pattern is a host or domain (``b.example.com`` names its subdomains, too) or a host
    and the first segments of a path (``b.example.com/en``). Longer path prefixes are
    more specific than shorter ones, those than hosts, hosts than parent domains. A
    capture is blocked when the most specific entry valid at its time says so. Without a
    host (null or malformed URL), a time or a valid entry it is not blocked and the last
    three columns are null. Captures alike in id, URL and time are decided once and given
    as often as they occur; extra columns are ignored.
    """
    intervals = validity(entries)
    limits = intervals.agg(
        F.count(F.lit(1)),
        F.max(F.when(~F.col("pattern").contains("/"), F.size(F.split("pattern", r"\.")))),
        F.max(F.when(F.col("pattern").contains("/"), F.size(F.split("pattern", "/")) - 1)),
    ).first()
    source = captures.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(time_col).alias("fetched_at")
    )
    parsed = (
        source.where("fetched_at IS NOT NULL")
        .withColumn("host", host_of(F.col("url")))
        .where("host IS NOT NULL")
        .withColumn("path", F.regexp_extract("url", _PATH, 1))
    )
    expanded = parsed.select(
        "page_id", "url", "fetched_at", F.inline(_patterns(limits[1] or 0, limits[2] or 0))
    )
    if limits[0] <= broadcast_entries:
        intervals = F.broadcast(intervals)
    valid = (F.col("valid_from") <= F.col("fetched_at")) & (
        F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to"))
    )
    decided = (
        expanded.join(intervals.withColumnRenamed("pattern", "of"), (F.col("pattern") == F.col("of")) & valid)
        .groupBy(
            F.col("page_id").alias("_id"), F.col("url").alias("_url"), F.col("fetched_at").alias("_at")
        )
        .agg(F.max_by(F.struct("action", "pattern", "valid_from"), "specific").alias("best"))
    )
    same = (
        F.col("page_id").eqNullSafe(F.col("_id"))
        & (F.col("url") == F.col("_url"))
        & (F.col("fetched_at") == F.col("_at"))
    )
    return source.join(decided, same, "left").select(
        "page_id",
        "url",
        "fetched_at",
        host_of(F.col("url")).alias("host"),
        F.coalesce(F.col("best.action") == "block", F.lit(False)).alias("blocked"),
        F.col("best.action").alias("action"),
        F.col("best.pattern").alias("pattern"),
        F.col("best.valid_from").alias("since"),
    )
