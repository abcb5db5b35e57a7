"""Service-level tables per segment, with intervals and eligibility."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breachscope import schema as S
from breachscope.functions import expressions as E
from breachscope.functions.percentiles import exact_percentiles, with_percentiles
from breachscope.session import settle

_RESOLUTION = "resolution_time_hours"
_HOURS = {
    "median_resolution_hours": (_RESOLUTION, 0.50),
    "p90_resolution_hours": (_RESOLUTION, 0.90),
}
_REQUIRED = ["number", "sla_breached", _RESOLUTION, "reassignment_count"]


def _measures() -> dict[str, Column]:
    return {
        "incident_count": F.count("number"),
        "resolved_incidents": F.count("resolved_at"),
        "missing_resolution": F.count_if(F.col("resolved_at").isNull()),
        "sla_breaches": F.count_if("sla_breached"),
        "reassigned_incidents": F.count_if(F.col("reassignment_count") > 0),
        "mean_reassignment_count": F.avg("reassignment_count"),
        "mean_resolution_hours": F.avg(_RESOLUTION),
    }


class SegmentCells:
    """All that the segment tables need, from one pass over the incidents.

    Incidents are counted by (dimension, value, hours) in a single aggregate over one
    grouping set for each dimension. The cells are stored; counts and means are their
    sums, and the percentiles of all dimensions come from one pass over them. The table
    functions below take this in the place of the incidents. Every incident must have
    one row (the collapse guarantees it and check ``v01`` verifies it).
    """

    KEYS = ("opened_month", "category", "priority", "reassignment_bucket", "assignment_group")

    def __init__(self, incidents: DataFrame):
        E.require_columns(incidents, [*_REQUIRED, "resolved_at", *self.KEYS])
        self.columns = incidents.columns
        by = [F.col(k) for k in (*self.KEYS, _RESOLUTION)]
        sums = {name: c for name, c in _measures().items() if not name.startswith("mean_")}
        sums |= {
            "_moves": F.sum("reassignment_count"),
            "_moved": F.count("reassignment_count"),
            "_timed": F.count(_RESOLUTION),
        }
        cells = incidents.groupingSets([[c, by[-1]] for c in by[:-1]], *by).agg(
            F.grouping_id().alias("_set"), *[c.alias(name) for name, c in sums.items()]
        )
        self.cells = settle(cells)
        timed = self.cells.where(F.col(_RESOLUTION).isNotNull())
        self.hours = settle(exact_percentiles(timed, ["_set", *self.KEYS], _HOURS, weight="_timed"))

    def _of(self, frame: DataFrame, key: str) -> DataFrame:
        """The rows of one dimension. The bit of a column is set where it is left out."""
        bits = len(self.KEYS) + 1
        this = (1 << bits) - 1 - (1 << (bits - 1 - self.KEYS.index(key))) - 1
        return frame.where((F.col("_set") == this) & F.col(key).isNotNull())

    def table(self, key: str, measures: Sequence[str], percentiles: bool = True) -> DataFrame:
        """What ``segment_counts`` returns for ``unique_numbers``."""
        means = {
            "mean_reassignment_count": F.sum("_moves") / F.sum("_moved"),
            "mean_resolution_hours": F.sum(F.col(_RESOLUTION) * F.col("_timed")) / F.sum("_timed"),
        }
        figures = [means.get(m, F.sum(m)).alias(m) for m in measures]
        summary = self._of(self.cells, key).groupBy(key).agg(*figures)
        if not percentiles:
            return summary.withColumns({name: F.lit(None).cast("double") for name in _HOURS})
        return summary.join(self._of(self.hours, key).select(key, *_HOURS), key, "left")


def segment_counts(
    incidents: DataFrame | SegmentCells,
    key: str,
    measures: Sequence[str],
    unique_numbers: bool = False,
    percentiles: bool = True,
) -> DataFrame:
    """The plain measures per non-null ``key``, with median and p90 hours.

    ``percentiles=False`` leaves the two columns null and saves their passes, for
    readers that show neither.

    Incidents are counted once each. ``unique_numbers`` states that the input
    has one row per incident (the collapse guarantees it and check ``v01``
    verifies it), which saves the extra shuffle on ``(key, number)``.
    """
    if isinstance(incidents, SegmentCells):
        return incidents.table(key, measures, percentiles)
    keyed = incidents.where(F.col(key).isNotNull())
    known = _measures()
    summary = keyed.groupBy(key).agg(*[known[m].alias(m) for m in measures])
    if not unique_numbers:
        distinct = (
            keyed.where(F.col("number").isNotNull())
            .select(key, "number")
            .distinct()
            .groupBy(key)
            .agg(F.count("*").alias("_distinct"))
        )
        summary = summary.join(distinct, key, "left").withColumn(
            "incident_count", F.coalesce("_distinct", F.lit(0))
        )
        summary = summary.drop("_distinct")
    if not percentiles:
        return summary.withColumns({name: F.lit(None).cast("double") for name in _HOURS})
    return with_percentiles(summary, keyed, [key], _HOURS)


def add_sla_rates(
    summary: DataFrame,
    reassigned: bool = False,
    resolved: bool = False,
    min_sample: int | None = None,
) -> DataFrame:
    """Rates in percent, Wilson bounds and, with ``min_sample``, the eligibility flag."""
    total, breaches = F.col("incident_count"), F.col("sla_breaches")
    rate = E.share(breaches, total)
    lower, upper = E.wilson_bounds(breaches, total)
    hundred = F.lit(100.0)
    columns = {
        "breach_rate": rate * hundred,
        "sla_compliance": (F.lit(1.0) - rate) * hundred,
    }
    if resolved:
        columns["resolution_coverage"] = E.percent(F.col("resolved_incidents"), total)
    if reassigned:
        columns["reassignment_rate"] = E.percent(F.col("reassigned_incidents"), total)
    columns["breach_rate_ci_lower"] = lower * hundred
    columns["breach_rate_ci_upper"] = upper * hundred
    if min_sample is not None:
        columns["eligible_for_comparison"] = total >= min_sample
    return summary.withColumns(columns)


def _worst_first(df: DataFrame, key: str) -> DataFrame:
    return df.orderBy(
        F.desc("eligible_for_comparison"),
        F.desc_nulls_last("breach_rate"),
        F.desc("incident_count"),
        key,
    )


def sla_category(
    incidents: DataFrame | SegmentCells,
    min_sample: int = S.MIN_SEGMENT_SAMPLE,
    unique_numbers: bool = False,
    percentiles: bool = True,
) -> DataFrame:
    E.require_columns(incidents, [*_REQUIRED, "category"])
    measures = ["incident_count", "sla_breaches", "reassigned_incidents", "mean_reassignment_count"]
    summary = segment_counts(incidents, "category", measures, unique_numbers, percentiles)
    summary = summary.select(
        "category", "incident_count", "sla_breaches", *_HOURS, *measures[2:]
    )
    return _worst_first(add_sla_rates(summary, reassigned=True, min_sample=min_sample), "category")


def sla_priority(
    incidents: DataFrame | SegmentCells, unique_numbers: bool = False, percentiles: bool = True
) -> DataFrame:
    E.require_columns(incidents, [*_REQUIRED, "priority"])
    measures = ["incident_count", "sla_breaches", "reassigned_incidents", "mean_reassignment_count"]
    summary = segment_counts(incidents, "priority", measures, unique_numbers, percentiles)
    summary = summary.select(
        "priority", "incident_count", "sla_breaches", *_HOURS, *measures[2:]
    )
    return add_sla_rates(summary, reassigned=True).orderBy(
        E.priority_rank(F.col("priority")), "priority"
    )


def sla_reassignment(
    incidents: DataFrame | SegmentCells, unique_numbers: bool = False, percentiles: bool = True
) -> DataFrame:
    E.require_columns(incidents, [*_REQUIRED, "reassignment_bucket"])
    measures = ["incident_count", "sla_breaches", "mean_reassignment_count"]
    summary = segment_counts(
        incidents, "reassignment_bucket", measures, unique_numbers, percentiles
    )
    summary = summary.select(
        "reassignment_bucket", "incident_count", "sla_breaches", *_HOURS, *measures[2:]
    )
    return add_sla_rates(summary).orderBy(
        E.bucket_rank(F.col("reassignment_bucket")), "reassignment_bucket"
    )


def reassignment_resolution(
    incidents: DataFrame | SegmentCells, unique_numbers: bool = False
) -> DataFrame:
    E.require_columns(incidents, ["number", "reassignment_bucket", "resolved_at", _RESOLUTION])
    measures = [
        "incident_count",
        "resolved_incidents",
        "missing_resolution",
        "mean_resolution_hours",
    ]
    summary = segment_counts(incidents, "reassignment_bucket", measures, unique_numbers)
    coverage = E.percent(F.col("resolved_incidents"), F.col("incident_count"))
    return summary.select(
        "reassignment_bucket",
        *measures[:3],
        *_HOURS,
        measures[3],
        coverage.alias("resolution_coverage"),
    ).orderBy(E.bucket_rank(F.col("reassignment_bucket")), "reassignment_bucket")


def sla_assignment_group(
    incidents: DataFrame | SegmentCells,
    min_sample: int = S.MIN_SEGMENT_SAMPLE,
    unique_numbers: bool = False,
    percentiles: bool = True,
) -> DataFrame:
    E.require_columns(incidents, [*_REQUIRED, "assignment_group", "resolved_at"])
    measures = [
        "incident_count",
        "resolved_incidents",
        "missing_resolution",
        "sla_breaches",
        "reassigned_incidents",
        "mean_reassignment_count",
    ]
    summary = segment_counts(incidents, "assignment_group", measures, unique_numbers, percentiles)
    summary = summary.select("assignment_group", *measures[:4], *_HOURS, *measures[4:])
    return _worst_first(
        add_sla_rates(summary, reassigned=True, resolved=True, min_sample=min_sample),
        "assignment_group",
    )


def sla_monthly(
    incidents: DataFrame | SegmentCells,
    min_sample: int = S.MIN_SEGMENT_SAMPLE,
    unique_numbers: bool = False,
) -> DataFrame:
    E.require_columns(incidents, [*_REQUIRED, "opened_month"])
    measures = ["incident_count", "sla_breaches", "reassigned_incidents", "mean_reassignment_count"]
    total = F.col("incident_count")
    return (
        segment_counts(incidents, "opened_month", measures, unique_numbers)
        .select(
            "opened_month",
            "incident_count",
            "sla_breaches",
            E.percent(F.col("sla_breaches"), total).alias("breach_rate"),
            *_HOURS,
            E.percent(F.col("reassigned_incidents"), total).alias("reassignment_rate"),
            "mean_reassignment_count",
            (total >= min_sample).alias("comparison_eligible"),
        )
        .orderBy("opened_month")
    )


# ---------------------------------------------------------------------- lists


def _eligible(segments: DataFrame) -> DataFrame:
    return segments.where("eligible_for_comparison")


def top_by(segments: DataFrame, measure: str, columns: Sequence[str], n: int = 10) -> DataFrame:
    """The ``n`` eligible segments with the largest ``measure``.

    Ties follow the order of the segment tables, then the name.
    """
    key = segments.columns[0]
    return (
        _eligible(segments)
        .orderBy(
            F.desc_nulls_last(measure),
            F.desc_nulls_last("breach_rate"),
            F.desc("incident_count"),
            key,
        )
        .limit(n)
        .select(key, *columns)
    )


_RATE_COLUMNS = [
    "incident_count",
    "sla_breaches",
    "breach_rate",
    "breach_rate_ci_lower",
    "breach_rate_ci_upper",
]


def top10_rate(segments: DataFrame) -> DataFrame:
    return top_by(segments, "breach_rate", _RATE_COLUMNS)


def top10_breaches(segments: DataFrame) -> DataFrame:
    return top_by(segments, "sla_breaches", ["incident_count", "sla_breaches", "breach_rate"])


def top10_median(segments: DataFrame) -> DataFrame:
    columns = ["incident_count", *_HOURS]
    if "resolution_coverage" in segments.columns:
        columns.append("resolution_coverage")
    return top_by(segments, "median_resolution_hours", columns)


def segment_totals(segments: DataFrame) -> DataFrame:
    return segments.agg(
        F.count("*").alias("segments"),
        F.count_if("eligible_for_comparison").alias("eligible_segments"),
    )


def missing_group_share(incidents: DataFrame) -> DataFrame:
    missing = F.count_if(F.col("assignment_group").isNull())
    return incidents.agg(
        missing.alias("missing_assignment_groups"),
        E.percent(missing, F.count("*")).alias("missing_assignment_group_pct"),
    )
