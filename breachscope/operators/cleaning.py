"""Event log -> one row per incident.

The collapse is a single grouped aggregate. Each map task first reduces its own
events to one row per incident, so an incident that owns a large part of the
log costs one row per map task in the shuffle, not one huge reducer partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breachscope import schema as S
from breachscope.functions import expressions as E

ROW_ORDER = "_row_order"

# Derived columns and what each is made of.
_DERIVED_FROM = {
    "sla_breached": ["made_sla"],
    "reassignment_bucket": ["reassignment_count"],
    "reopened": ["reopen_count"],
    "resolution_time_hours": ["opened_at", "resolved_at"],
    "closure_time_hours": ["opened_at", "closed_at"],
    "opened_date": ["opened_at"],
    "opened_month": ["opened_at"],
    "opened_year": ["opened_at"],
}


def _is(df: DataFrame, column: str, kind: str) -> bool:
    return df.schema[column].dataType.typeName() == kind


def null_tokens(events: DataFrame) -> DataFrame:
    """Replace the "no value" texts of every text column by null.

    ``read_event_log`` has done this; it is for logs from elsewhere.
    """
    return events.select(
        *[
            E.known(F.col(c)).alias(c) if _is(events, c, "string") else F.col(c)
            for c in events.columns
        ]
    )


def parse_timestamps(events: DataFrame) -> DataFrame:
    """Day-first texts of the four lifecycle columns as timestamps, bad -> null."""
    texts = [c for c in S.EVENT_TIMES if c in events.columns and _is(events, c, "string")]
    return events.withColumns({c: E.day_first_time(F.col(c)) for c in texts})


def normalize_flags(events: DataFrame, strict: bool = True) -> DataFrame:
    """Spellings of the two lifecycle flags as booleans; typed flags stay as they are."""
    untyped = [c for c in S.EVENT_FLAGS if c in events.columns and not _is(events, c, "boolean")]
    # Two steps, so that a word that is looked at several times is computed once.
    words = events.withColumns({c: E.flag_word(F.col(c)) for c in untyped})
    return words.withColumns({c: E.flag(F.col(c), c, strict) for c in untyped})


def coerce_counters(events: DataFrame) -> DataFrame:
    """Whole numbers, bad -> null; columns that are whole numbers stay as they are."""
    untyped = [c for c in S.EVENT_COUNTERS if c in events.columns and not _is(events, c, "integer")]
    numbers = events.withColumns({c: E.number(F.col(c)) for c in untyped})
    return numbers.withColumns({c: E.whole(F.col(c)) for c in untyped})


def unexpected_flags(events: DataFrame) -> DataFrame:
    """Every unexpected flag spelling with its column and count."""
    present = [c for c in S.EVENT_FLAGS if c in events.columns]
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), E.flag_word(F.col(c)).alias("value"))
            for c in present
        ]
    )
    return (
        events.select(F.inline(pairs))
        .where(E.is_unexpected_flag(F.col("value")))
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("rows"))
    )


def type_events(events: DataFrame, strict: bool = True) -> DataFrame:
    """Log of texts, "no value" being null, to typed log; typed columns stay."""
    return coerce_counters(normalize_flags(parse_timestamps(events), strict))


def event_order(events: DataFrame) -> Column:
    """Sort key of an event within its incident.

    Later updates come later, an update without a time comes last of all, and
    equal times follow the order of the log. Without that order the event chosen
    among equal times would depend on the run, so it is required.
    """
    E.require_columns(events, [ROW_ORDER], "event log without an order of its rows")
    return F.struct(
        F.col("sys_updated_at").isNull().alias("untimed"), F.col("sys_updated_at"), F.col(ROW_ORDER)
    )


def collapse_events(events: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per incident: its last event as a whole, its first known opening
    time, and the largest value each counter ever had.

    ``columns`` limits what is carried through the shuffle; Catalyst cannot see
    into the struct that keeps the last event together.
    """
    E.require_columns(events, ["number", "sys_updated_at"], "event log")
    wanted = set(columns) if columns is not None else set(events.columns)
    carried = [c for c in events.columns if c not in ("number", ROW_ORDER) and c in wanted]
    counters = [c for c in S.EVENT_COUNTERS if c in carried]
    latest = [c for c in carried if c not in counters and c != "opened_at"]

    aggregates = [F.count("*").alias("_events"), *[F.max(c).alias(c) for c in counters]]
    source = events.where(F.col("number").isNotNull()).withColumn("_order", event_order(events))
    if "opened_at" in carried:
        # Ordering keys that are null are skipped, which skips unknown openings.
        opened_order = F.when(F.col("opened_at").isNotNull(), F.col("_order"))
        aggregates.append(F.min_by("opened_at", opened_order).alias("opened_at"))
    if latest:
        aggregates.append(F.max_by(F.struct(*latest), F.col("_order")).alias("_last"))
    # The aggregate sorts by its keys. Led by a hash, nearly every comparison is
    # settled on one long instead of on texts that all start alike.
    collapsed = source.groupBy(F.xxhash64("number").alias("_hash"), "number").agg(*aggregates)
    return collapsed.select(
        "number",
        *[F.col(f"_last.{c}").alias(c) if c in latest else F.col(c) for c in carried],
    )


def derive_columns(incidents: DataFrame) -> DataFrame:
    """Outcome flags, bucket, durations and calendar columns, as far as their
    inputs are present."""
    opened = F.col("opened_at")
    formulas = {
        "sla_breached": lambda: ~F.col("made_sla"),
        "reassignment_bucket": lambda: E.reassignment_bucket(F.col("reassignment_count")),
        "reopened": lambda: E.is_reopened(F.col("reopen_count")),
        "resolution_time_hours": lambda: E.hours_between(opened, F.col("resolved_at")),
        "closure_time_hours": lambda: E.hours_between(opened, F.col("closed_at")),
        "opened_date": lambda: F.to_date(opened),
        "opened_month": lambda: E.month_of(opened),
        "opened_year": lambda: F.year(opened),
    }
    present = set(incidents.columns)
    return incidents.withColumns(
        {
            name: formula()
            for name, formula in formulas.items()
            if present.issuperset(_DERIVED_FROM[name])
        }
    )


def order_columns(incidents: DataFrame) -> DataFrame:
    """Known columns in their fixed order, then whatever else the log carried."""
    known = [c for c in S.INCIDENT_COLUMNS if c in incidents.columns]
    return incidents.select(*known, *[c for c in incidents.columns if c not in known])


def clean_incidents(
    events: DataFrame, columns: Sequence[str] | None = None, strict: bool = True
) -> DataFrame:
    """The whole step from the log, as ``read_event_log`` returns it or already
    typed, to incidents. With ``columns``, only those columns are produced.
    """
    needed = None
    if columns is not None:
        needed = set(columns)
        for name in columns:
            needed.update(_DERIVED_FROM.get(name, []))
        kept = needed | {"number", "sys_updated_at", ROW_ORDER}
        events = events.select(*[c for c in events.columns if c in kept])
    typed = type_events(events, strict)
    incidents = order_columns(derive_columns(collapse_events(typed, needed)))
    if columns is None:
        return incidents
    chosen = set(columns) | {"number"}
    return incidents.select(*[c for c in incidents.columns if c in chosen])
