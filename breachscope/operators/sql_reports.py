"""The nine operational reports and the dashboard frames.

Counts are taken over all rows of a group and rates are rounded to two digits.
All of them are one grouped aggregate with map-side combine; only the reports
with percentiles take more passes (see ``functions.percentiles``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breachscope import schema as S
from breachscope.functions import expressions as E
from breachscope.functions.percentiles import exact_percentiles

_RESOLUTION = "resolution_time_hours"
_MET = "sla_met_incidents"
_BREACHED = "sla_breached_incidents"
_LEVELS = [*S.PRIORITY_LEVELS.values()]


def _counts(*names: str) -> list[Column]:
    known = {
        "incident_count": F.count("*"),
        _MET: F.count_if("made_sla"),
        _BREACHED: F.count_if("sla_breached"),
        "resolved_incidents": F.count(_RESOLUTION),
        "mean_resolution_hours": E.round_2dp(F.avg(_RESOLUTION)),
    }
    return [known[name].alias(name) for name in names]


def _rate(part: str, whole: str = "incident_count") -> Column:
    return E.percent_2dp(F.col(part), F.col(whole))


def _sla_rates(df: DataFrame) -> DataFrame:
    return df.withColumn("sla_compliance_rate_pct", _rate(_MET)).withColumn(
        "sla_breach_rate_pct", _rate(_BREACHED)
    )


def q01_kpi_summary(incidents: DataFrame) -> DataFrame:
    counts = incidents.agg(
        F.count("*").alias("total_incidents"),
        F.count("resolved_at").alias("resolved_incidents"),
        F.count_if("made_sla").alias(_MET),
        F.count_if("sla_breached").alias(_BREACHED),
        F.count_if(F.col("reassignment_count") > 0).alias("reassigned_incidents"),
        F.count_if("reopened").alias("reopened_incidents"),
    )
    total = "total_incidents"
    return counts.select(
        total,
        "resolved_incidents",
        _MET,
        _BREACHED,
        _rate(_MET, total).alias("sla_compliance_rate_pct"),
        _rate(_BREACHED, total).alias("sla_breach_rate_pct"),
        "reassigned_incidents",
        _rate("reassigned_incidents", total).alias("reassignment_rate_pct"),
        "reopened_incidents",
        _rate("reopened_incidents", total).alias("reopen_rate_pct"),
    )


def _by_priority_level(incidents: DataFrame) -> DataFrame:
    return incidents.withColumn("priority_level", E.priority_level(F.col("priority")))


def q02_priority_sla(incidents: DataFrame) -> DataFrame:
    counts = (
        _by_priority_level(incidents)
        .groupBy("priority_level")
        .agg(*_counts("incident_count", _MET, _BREACHED))
    )
    return _sla_rates(counts).orderBy(E.rank_in(F.col("priority_level"), _LEVELS))


def q03_reassignment_sla(incidents: DataFrame) -> DataFrame:
    level = E.reassignment_level(F.col("reassignment_bucket")).alias("reassignment_level")
    counts = incidents.groupBy(level).agg(*_counts("incident_count", _MET, _BREACHED))
    return _sla_rates(counts).orderBy(E.bucket_rank(F.col("reassignment_level")))


def q04_resolution_distribution(incidents: DataFrame) -> DataFrame:
    wanted = {
        "median_resolution_hours": (_RESOLUTION, 0.50),
        "p90_resolution_hours": (_RESOLUTION, 0.90),
        "p95_resolution_hours": (_RESOLUTION, 0.95),
        "p99_resolution_hours": (_RESOLUTION, 0.99),
    }
    plain = {"resolved_incidents": (_RESOLUTION, "count"), "mean_resolution_hours": (_RESOLUTION, "mean")}
    row = exact_percentiles(incidents, [], wanted, plain=plain)
    return row.select(
        _whole("resolved_incidents"),
        *[E.round_2dp(F.col(name)).alias(name) for name in ("mean_resolution_hours", *wanted)],
    )


def _whole(count: str) -> Column:
    """A count of values that may be missing altogether."""
    return F.coalesce(F.col(count).cast("bigint"), F.lit(0).cast("bigint")).alias(count)


def q05_resolution_by_priority(incidents: DataFrame) -> DataFrame:
    wanted = {
        "median_resolution_hours": (_RESOLUTION, 0.50),
        "p90_resolution_hours": (_RESOLUTION, 0.90),
    }
    # Every incident has the second value, so that its count is that of incidents.
    plain = {"incident_count": ("_any", "count"), "resolved_incidents": (_RESOLUTION, "count")}
    leveled = _by_priority_level(incidents).withColumn("_any", F.lit(0.0))
    return (
        exact_percentiles(leveled, ["priority_level"], wanted, plain=plain)
        .select("priority_level", *[_whole(name) for name in plain], *wanted)
        .withColumn("unresolved_incidents", F.col("incident_count") - F.col("resolved_incidents"))
        .select(
            "priority_level",
            *plain,
            "unresolved_incidents",
            _rate("unresolved_incidents").alias("unresolved_rate_pct"),
            *[E.round_2dp(F.col(name)).alias(name) for name in wanted],
        )
        .orderBy(E.rank_in(F.col("priority_level"), _LEVELS))
    )


def _breach_exposure(grouped, min_sample: int) -> DataFrame:
    counts = grouped.agg(*_counts("incident_count", _BREACHED, "mean_resolution_hours"))
    key = counts.columns[0]
    return (
        counts.where(F.col("incident_count") >= min_sample)
        .select(
            key,
            "incident_count",
            _BREACHED,
            _rate(_BREACHED).alias("sla_breach_rate_pct"),
            "mean_resolution_hours",
        )
        .orderBy(F.desc_nulls_first("sla_breach_rate_pct"), F.desc("incident_count"), key)
    )


def q06_category_sla(
    incidents: DataFrame, min_sample: int = S.MIN_SEGMENT_SAMPLE
) -> DataFrame:
    return _breach_exposure(incidents.groupBy("category"), min_sample)


def q07_assignment_group(
    incidents: DataFrame, min_sample: int = S.MIN_SEGMENT_SAMPLE
) -> DataFrame:
    group = F.coalesce("assignment_group", F.lit(S.UNKNOWN)).alias("assignment_group")
    return _breach_exposure(incidents.groupBy(group), min_sample)


def q08_monthly(incidents: DataFrame) -> DataFrame:
    counts = incidents.groupBy("opened_month").agg(
        *_counts("incident_count", _MET, _BREACHED, "resolved_incidents", "mean_resolution_hours")
    )
    return (
        _sla_rates(counts)
        .select(
            "opened_month",
            "incident_count",
            _BREACHED,
            "sla_compliance_rate_pct",
            "sla_breach_rate_pct",
            "resolved_incidents",
            "mean_resolution_hours",
        )
        .orderBy(F.asc_nulls_last("opened_month"))
    )


def q09_breach_concentration(
    incidents: DataFrame, min_sample: int = S.MIN_PAIR_SAMPLE
) -> DataFrame:
    counts = (
        incidents.groupBy("priority", "reassignment_bucket")
        .agg(*_counts("incident_count", _BREACHED))
        .where(F.col("incident_count") >= min_sample)
    )
    # The total is of surviving pairs only. It reads the same shuffle as the rows.
    all_breaches = counts.agg(F.sum(_BREACHED).alias("n"))
    return (
        counts.withColumn("sla_breach_rate_pct", _rate(_BREACHED))
        .withColumn("_all", all_breaches.scalar())
        .withColumn("share_of_all_breaches_pct", _rate(_BREACHED, "_all"))
        .drop("_all")
        .orderBy(
            F.desc(_BREACHED),
            F.desc_nulls_first("sla_breach_rate_pct"),
            F.asc_nulls_last("priority"),
            F.asc_nulls_last("reassignment_bucket"),
        )
    )


# ------------------------------------------------------------------ dashboard


def dash_priority_sla(incidents: DataFrame) -> DataFrame:
    return q02_priority_sla(incidents).drop(_MET, _BREACHED)


def dash_reassignment_sla(incidents: DataFrame) -> DataFrame:
    """By the bucket as stored: an unknown bucket stays null."""
    level = F.col("reassignment_bucket").alias("reassignment_level")
    counts = incidents.groupBy(level).agg(*_counts("incident_count", _MET, _BREACHED))
    return _sla_rates(counts).drop(_MET).orderBy(E.bucket_rank(F.col("reassignment_level")))


def dash_monthly(incidents: DataFrame) -> DataFrame:
    return q08_monthly(incidents).drop(_BREACHED)


def _highest(df: DataFrame, rank: Column) -> DataFrame:
    return df.orderBy(F.desc_nulls_last("sla_breach_rate_pct"), rank).limit(1)


def dash_highest_priority_risk(incidents: DataFrame) -> DataFrame:
    """The priority with the highest breach rate, the more urgent one on a tie."""
    return _highest(
        dash_priority_sla(incidents), E.rank_in(F.col("priority_level"), _LEVELS)
    )


def dash_highest_reassignment_risk(incidents: DataFrame) -> DataFrame:
    return _highest(
        dash_reassignment_sla(incidents), E.bucket_rank(F.col("reassignment_level"))
    )
