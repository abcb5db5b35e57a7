"""Assignment-group bottlenecks and what sets them apart.

All inputs are segment tables: one row per assignment group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breachscope import schema as S
from breachscope.functions import expressions as E
from breachscope.functions.percentiles import exact_percentiles

_FIGURES = [
    "incident_count",
    "sla_breaches",
    "breach_rate",
    "median_resolution_hours",
    "p90_resolution_hours",
]
_DRIVERS = ["reassignment_rate", "mean_reassignment_count"]


def thresholds(eligible: DataFrame) -> DataFrame:
    """One row: median incident count and median breach rate."""
    return exact_percentiles(
        eligible,
        [],
        {
            "volume_threshold": ("incident_count", 0.5),
            "breach_rate_threshold": ("breach_rate", 0.5),
        },
    )


def bottlenecks(groups: DataFrame, strict: bool = False) -> DataFrame:
    """Eligible groups classified against the medians of the eligible groups.

    ``strict`` fails when no group is eligible; otherwise the result is empty.
    """
    E.require_columns(groups, ["assignment_group", *_FIGURES, "eligible_for_comparison"])
    eligible = groups.where("eligible_for_comparison").select("assignment_group", *_FIGURES)
    if strict:
        E.require_rows(eligible, "no group is large enough to be classified")
    row = thresholds(eligible).select(F.struct("volume_threshold", "breach_rate_threshold").alias("_t"))
    count, rate = F.col("incident_count"), F.col("breach_rate")
    count_at, rate_at = F.col("_t.volume_threshold"), F.col("_t.breach_rate_threshold")
    return (
        eligible.withColumn("_t", row.scalar())
        .select(
            "assignment_group",
            *_FIGURES,
            E.volume_class(count, count_at).alias("volume_class"),
            E.breach_risk_class(rate, rate_at).alias("breach_risk_class"),
            E.bottleneck_class(count, rate, count_at, rate_at).alias("bottleneck_class"),
            count_at.alias("volume_threshold"),
            rate_at.alias("breach_rate_threshold"),
        )
        .orderBy(
            "bottleneck_class",
            F.desc_nulls_last("breach_rate"),
            F.desc("incident_count"),
            "assignment_group",
        )
    )


def drivers(groups: DataFrame, classified: DataFrame, strict: bool = False) -> DataFrame:
    """Eligible groups with their class and the segment they are compared in.

    ``strict`` fails when no group is eligible or one has no class.
    """
    E.require_columns(groups, ["assignment_group", *_FIGURES, *_DRIVERS, "eligible_for_comparison"])
    E.require_columns(classified, ["assignment_group", "bottleneck_class"])
    eligible = groups.where("eligible_for_comparison").select(
        "assignment_group", *_FIGURES, *_DRIVERS
    )
    # One class per group; the choice among repeated groups does not depend on row order.
    classes = classified.groupBy("assignment_group").agg(
        F.min("bottleneck_class").alias("bottleneck_class")
    )
    result = eligible.join(classes, "assignment_group", "left")
    if strict:
        E.require_rows(eligible, "no group is large enough to look for drivers")
        if not result.where(F.col("bottleneck_class").isNull()).isEmpty():
            raise AssertionError(
                "a group that is large enough has no class"
            )
    return result.select(
        "assignment_group",
        "bottleneck_class",
        E.driver_segment(F.col("bottleneck_class")).alias("driver_segment"),
        *_FIGURES,
        *_DRIVERS,
    ).orderBy(
        "driver_segment",
        F.desc_nulls_last("breach_rate"),
        F.desc("incident_count"),
        "assignment_group",
    )


# The compared metrics and their labels.
_COMPARED = {
    "breach_rate": "Median breach rate (%)",
    "median_resolution_hours": "Median resolution time (hours)",
    "p90_resolution_hours": "Median P90 resolution time (hours)",
    "reassignment_rate": "Median reassignment rate (%)",
    "mean_reassignment_count": "Median mean reassignment count",
}


def driver_comparison(driver_table: DataFrame) -> DataFrame:
    """Medians of the two segments side by side, and their difference.

    Empty unless both segments have groups.
    """
    medians = exact_percentiles(
        driver_table, ["driver_segment"], {column: (column, 0.5) for column in _COMPARED}
    )
    label = F.create_map(*[F.lit(x) for pair in _COMPARED.items() for x in pair])
    long = medians.unpivot("driver_segment", list(_COMPARED), "_column", "_median")
    critical = F.col("driver_segment") == "Critical Bottleneck"
    return (
        long.groupBy("_column")
        .agg(
            F.max(F.when(critical, F.col("_median"))).alias("critical_bottlenecks"),
            F.max(F.when(~critical, F.col("_median"))).alias("other_eligible_groups"),
            F.count_distinct("driver_segment").alias("_segments"),
        )
        .where(F.col("_segments") == 2)
        .select(
            label[F.col("_column")].alias("metric"),
            "critical_bottlenecks",
            "other_eligible_groups",
            (F.col("critical_bottlenecks") - F.col("other_eligible_groups")).alias("difference"),
        )
        .orderBy(E.rank_in(F.col("metric"), list(_COMPARED.values())))
    )


def class_counts(classified: DataFrame) -> DataFrame:
    """Groups per class: all four classes in fixed order, zero where empty."""
    spark = classified.sparkSession
    domain = spark.createDataFrame(
        list(enumerate(S.BOTTLENECK_CLASSES)), "_rank int, bottleneck_class string"
    )
    counts = classified.groupBy("bottleneck_class").agg(F.count("*").alias("_groups"))
    return (
        domain.join(counts, "bottleneck_class", "left")
        .orderBy("_rank")
        .select("bottleneck_class", F.coalesce("_groups", F.lit(0)).alias("groups"))
    )


def class_list(classified: DataFrame, label: str) -> DataFrame:
    """The groups of one class, worst first."""
    return (
        classified.where(F.col("bottleneck_class") == label)
        .select("assignment_group", "incident_count", "sla_breaches", "breach_rate")
        .orderBy(F.desc_nulls_last("breach_rate"), F.desc("incident_count"), "assignment_group")
    )


def driver_segment_counts(driver_table: DataFrame) -> DataFrame:
    return (
        driver_table.groupBy("driver_segment").agg(F.count("*").alias("groups")).orderBy("driver_segment")
    )
