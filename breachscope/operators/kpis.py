"""Key figures: one-row frames and the two unfiltered segment tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breachscope.functions import expressions as E
from breachscope.functions.percentiles import exact_percentiles, with_percentiles

_RESOLUTION = "resolution_time_hours"


def _rate(count: str) -> Column:
    """Share of all incidents in percent; zero, not null, for an empty input."""
    return F.coalesce(E.percent(F.col(count), F.col("total_incidents")), F.lit(0.0))


def kpi_overall(incidents: DataFrame) -> DataFrame:
    counts = incidents.agg(
        F.count("*").alias("total_incidents"),
        F.count_if("made_sla").alias("sla_met"),
        F.count_if("sla_breached").alias("sla_breached"),
        F.count("resolved_at").alias("resolved_incidents"),
        F.count_if(F.col("reassignment_count") > 0).alias("reassigned_incidents"),
        F.count_if("reopened").alias("reopened_incidents"),
    )
    return counts.select(
        "total_incidents",
        "sla_met",
        "sla_breached",
        _rate("sla_met").alias("sla_compliance_rate"),
        _rate("sla_breached").alias("sla_breach_rate"),
        "resolved_incidents",
        (F.col("total_incidents") - F.col("resolved_incidents")).alias(
            "missing_resolution_timestamp"
        ),
        _rate("resolved_incidents").alias("resolution_coverage_rate"),
        "reassigned_incidents",
        _rate("reassigned_incidents").alias("reassignment_rate"),
        "reopened_incidents",
        _rate("reopened_incidents").alias("reopen_rate"),
    )


def _figures(
    df: DataFrame, plain: Mapping[str, tuple[str, str]], wanted: Mapping[str, tuple[str, float]]
) -> DataFrame:
    """One row of plain figures followed by exact percentiles, in one pass over ``df``.

    The largest value keeps the type of its column.
    """
    row = exact_percentiles(df, [], wanted, plain=plain)
    types = {name: df.schema[column].dataType for name, (column, kind) in plain.items() if kind == "max"}
    return row.select(
        *[F.col(name).cast(types[name]).alias(name) if name in types else name for name in plain], *wanted
    )


def kpi_resolution(incidents: DataFrame) -> DataFrame:
    return _figures(
        incidents,
        {"mean_resolution_hours": (_RESOLUTION, "mean")},
        {
            "median_resolution_hours": (_RESOLUTION, 0.50),
            "p90_resolution_hours": (_RESOLUTION, 0.90),
            "p95_resolution_hours": (_RESOLUTION, 0.95),
            "p99_resolution_hours": (_RESOLUTION, 0.99),
        },
    )


def closure_lag(incidents: DataFrame) -> DataFrame:
    """Adds the hours from technical resolution to formal closure."""
    return incidents.withColumn(
        "closure_lag_hours", E.hours_between(F.col("resolved_at"), F.col("closed_at"))
    )


def kpi_closure(incidents: DataFrame) -> DataFrame:
    return _figures(
        closure_lag(incidents),
        {"mean_closure_hours": ("closure_time_hours", "mean")},
        {
            "median_closure_hours": ("closure_time_hours", 0.50),
            "p90_closure_hours": ("closure_time_hours", 0.90),
            "p95_closure_hours": ("closure_time_hours", 0.95),
            "median_closure_lag_hours": ("closure_lag_hours", 0.50),
            "p90_closure_lag_hours": ("closure_lag_hours", 0.90),
        },
    )


def kpi_reassignment(incidents: DataFrame) -> DataFrame:
    column = "reassignment_count"
    return _figures(
        incidents,
        {"mean_reassignments": (column, "mean"), "max_reassignments": (column, "max")},
        {
            "median_reassignments": (column, 0.50),
            "p90_reassignments": (column, 0.90),
            "p95_reassignments": (column, 0.95),
        },
    )


def kpi_reopen(incidents: DataFrame) -> DataFrame:
    column = "reopen_count"
    return _figures(
        incidents,
        {"mean_reopens": (column, "mean"), "max_reopens": (column, "max")},
        {"median_reopens": (column, 0.50), "p90_reopens": (column, 0.90)},
    )


_SEGMENT_HOURS = {
    "median_resolution_hours": (_RESOLUTION, 0.50),
    "p90_resolution_hours": (_RESOLUTION, 0.90),
}


def kpi_monthly(incidents: DataFrame) -> DataFrame:
    """Per opening month, in order; incidents without a month are left out."""
    dated = incidents.where(F.col("opened_month").isNotNull())
    counts = dated.groupBy("opened_month").agg(
        F.count("number").alias("incident_count"),
        F.count_if("sla_breached").alias("sla_breached"),
        F.count_if("made_sla").alias("sla_met"),
    )
    total = F.col("incident_count")
    return (
        with_percentiles(counts, dated, ["opened_month"], _SEGMENT_HOURS)
        .withColumn("sla_compliance_rate", E.percent(F.col("sla_met"), total))
        .withColumn("sla_breach_rate", E.percent(F.col("sla_breached"), total))
        .orderBy("opened_month")
    )


def _segment_kpis(incidents: DataFrame, key: str, with_reopens: bool) -> DataFrame:
    """Per value of ``key``, null included; largest segments first."""
    total = F.col("incident_count")
    aggregates = [
        F.count("number").alias("incident_count"),
        F.count_if("sla_breached").alias("sla_breached"),
        # Rows without a count take part in the denominator.
        E.percent(F.count_if(F.col("reassignment_count") > 0), F.count("*")).alias(
            "reassignment_rate"
        ),
    ]
    if with_reopens:
        aggregates.append(
            E.percent(F.count_if("reopened"), F.count("reopened")).alias("reopen_rate")
        )
    counts = incidents.groupBy(key).agg(*aggregates)
    columns = [key, "incident_count", "sla_breached", *_SEGMENT_HOURS, "reassignment_rate"]
    return (
        with_percentiles(counts, incidents, [key], _SEGMENT_HOURS)
        .select(
            *columns,
            *(["reopen_rate"] if with_reopens else []),
            E.percent(F.col("sla_breached"), total).alias("sla_breach_rate"),
        )
        .orderBy(F.desc("incident_count"), F.asc_nulls_last(key))
    )


def kpi_category(incidents: DataFrame) -> DataFrame:
    return _segment_kpis(incidents, "category", with_reopens=True)


def kpi_assignment_group(incidents: DataFrame) -> DataFrame:
    return _segment_kpis(incidents, "assignment_group", with_reopens=False)


def kpi_top10(segments: DataFrame) -> DataFrame:
    """The ten largest segments of either table above."""
    key = segments.columns[0]
    return segments.orderBy(F.desc("incident_count"), F.asc_nulls_last(key)).limit(10)
