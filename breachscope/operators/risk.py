"""Historical risk: reference rates, incident scores and their summaries.

A score depends on nothing but the four factor values of an incident. The
summaries therefore start by counting incidents per combination of factors
(``factor_profile``): one pass with map-side combine, after which all further
work is on combinations instead of incidents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breachscope import schema as S
from breachscope.functions import expressions as E
from breachscope.functions.percentiles import with_percentiles
from breachscope.operators.segments import add_sla_rates

_REFERENCE = [
    "factor_type",
    "factor_value",
    "incident_count",
    "sla_breaches",
    "breach_rate",
    "breach_rate_ci_lower",
    "breach_rate_ci_upper",
]
# A lookup is broadcast only when it is measured to be smaller than this.
BROADCAST_BYTES = 32 * 1024 * 1024


def rate_column(prefix: str) -> str:
    return f"{prefix}_historical_breach_rate"


def contribution_column(prefix: str) -> str:
    return f"{prefix}_risk_contribution"


RATE_COLUMNS = [rate_column(prefix) for _, _, prefix in S.RISK_FACTORS]
CONTRIBUTION_COLUMNS = [contribution_column(prefix) for _, _, prefix in S.RISK_FACTORS]
SCORE_COLUMNS = [
    "number",
    *S.FACTOR_COLUMNS,
    *[name for pair in zip(RATE_COLUMNS, CONTRIBUTION_COLUMNS) for name in pair],
    "risk_factor_count",
    "sla_risk_score",
    "sla_risk_band",
]


def _factor_rows(*extra: str) -> Column:
    """One (factor_type, factor_value, ...) entry per factor of a row."""
    return F.array(
        *[
            F.struct(
                F.lit(label).alias("factor_type"),
                F.col(column).alias("factor_value"),
                *[F.col(name) for name in extra],
            )
            for column, label, _ in S.RISK_FACTORS
        ]
    )


# ------------------------------------------------------------------ reference


def _order_reference(df: DataFrame) -> DataFrame:
    return df.select(*_REFERENCE).orderBy(
        "factor_type", F.desc_nulls_last("breach_rate"), F.desc("incident_count"), "factor_value"
    )


def risk_reference(
    category: DataFrame, priority: DataFrame, reassignment: DataFrame, group: DataFrame
) -> DataFrame:
    """Historical rates in long form, from the four segment tables.

    Only eligible categories and assignment groups are taken.
    """
    tables = {
        "Priority": priority,
        "Reassignment Bucket": reassignment,
        "Category": category,
        "Assignment Group": group,
    }
    merged = None
    for column, label, _ in S.RISK_FACTORS:
        table = tables[label]
        needed = [column, *_REFERENCE[2:]]
        if label in S.SAMPLED_FACTORS:
            E.require_columns(table, [*needed, "eligible_for_comparison"], f"{label} table")
            table = table.where("eligible_for_comparison")
        E.require_columns(table, needed, f"{label} table")
        part = table.select(
            F.lit(label).alias("factor_type"), F.col(column).alias("factor_value"), *needed[1:]
        )
        merged = part if merged is None else merged.unionByName(part)
    return _order_reference(merged)


def factor_profile(incidents: DataFrame) -> DataFrame:
    """Incidents and breaches per combination of the four factors."""
    return incidents.groupBy(*S.FACTOR_COLUMNS).agg(
        F.count("number").alias("incident_count"),
        F.count_if("sla_breached").alias("sla_breaches"),
    )


def reference_from_profile(
    profile: DataFrame, min_sample: int = S.MIN_SEGMENT_SAMPLE
) -> DataFrame:
    """The same reference as ``risk_reference``, from the combination counts."""
    counts = (
        profile.select(F.inline(_factor_rows("incident_count", "sla_breaches")))
        .where(F.col("factor_value").isNotNull())
        .groupBy("factor_type", "factor_value")
        .agg(
            F.sum("incident_count").alias("incident_count"),
            F.sum("sla_breaches").alias("sla_breaches"),
        )
    )
    sampled = F.col("factor_type").isin(S.SAMPLED_FACTORS)
    trusted = ~sampled | (F.col("incident_count") >= min_sample)
    return _order_reference(add_sla_rates(counts.where(trusted)))


# --------------------------------------------------------------------- scores


def check_reference(reference: DataFrame) -> int:
    """Fail on a reference that cannot be used; return its size in bytes.

    One small aggregate: the reference has one row per factor value.
    """
    E.require_columns(
        reference,
        ["factor_type", "factor_value", "breach_rate"],
        "risk reference",
    )
    rate = F.col("breach_rate")
    pairs = reference.groupBy("factor_type", "factor_value").agg(
        F.count("*").alias("rows"),
        F.count_if(rate.isNull()).alias("missing"),
        F.count_if((rate < 0) | (rate > 100)).alias("outside"),
        F.max(F.coalesce(F.octet_length("factor_value"), F.lit(0))).alias("bytes"),
    )
    facts = pairs.agg(
        F.count("*").alias("pairs"),
        F.count_if(F.col("rows") > 1).alias("duplicates"),
        F.sum("missing").alias("missing"),
        F.sum("outside").alias("outside"),
        F.sum(F.col("bytes") + 64).alias("bytes"),
    ).first()
    if facts["pairs"] == 0:
        raise ValueError("there is no risk reference to look rates up in")
    if facts["duplicates"]:
        raise ValueError("a factor value stands in the risk reference more than once")
    if facts["missing"]:
        raise ValueError("a factor value of the risk reference has no breach rate")
    if facts["outside"]:
        raise ValueError("a breach rate of the risk reference is not a percentage")
    return facts["bytes"]


def _joined_rates(df: DataFrame, reference: DataFrame, small: bool) -> DataFrame:
    for column, label, prefix in S.RISK_FACTORS:
        rates = reference.where(F.col("factor_type") == label).select(
            F.col("factor_value").alias(column), F.col("breach_rate").alias(rate_column(prefix))
        )
        df = df.join(F.broadcast(rates) if small else rates, column, "left")
    return df


def lookup_rates(
    df: DataFrame, reference: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Add the four historical rates; values without a reference get null.

    The reference is measured first. While it is small each lookup is a
    broadcast join and ``df`` is never shuffled. Beyond that size the rates are looked
    up for each distinct combination of factors, and the combinations are joined once:
    ``df`` is shuffled once instead of four times, and by combinations, whose hot values
    adaptive execution splits, instead of by single factors that are often null.
    """
    if check_reference(reference) <= broadcast_bytes:
        return _joined_rates(df, reference, small=True)
    factors = F.struct(*S.FACTOR_COLUMNS)  # null equals null inside
    combinations = _joined_rates(df.select(*S.FACTOR_COLUMNS).distinct(), reference, small=False)
    looked_up = combinations.select(factors.alias("_factors"), *RATE_COLUMNS)
    return df.withColumn("_of", factors).join(looked_up, F.col("_of") == F.col("_factors")).drop("_of", "_factors")


def score(df: DataFrame, baseline: float = S.RISK_BASELINE_RATE) -> DataFrame:
    """Contributions, factor count, score and band from the four rates."""
    if S.RISK_SCORE_MAX - baseline <= 0:
        raise ValueError("the baseline rate must be below the largest score")
    scored = df.withColumns(
        {
            contribution_column(prefix): E.risk_contribution(F.col(rate_column(prefix)), baseline)
            for _, _, prefix in S.RISK_FACTORS
        }
    )
    contributions = [F.col(name) for name in CONTRIBUTION_COLUMNS]
    return scored.withColumns(
        {
            "risk_factor_count": E.factor_count(contributions),
            "sla_risk_score": E.risk_score(contributions),
        }
    ).withColumn("sla_risk_band", E.risk_band(F.col("sla_risk_score")))


def risk_scores(
    incidents: DataFrame,
    reference: DataFrame,
    baseline: float = S.RISK_BASELINE_RATE,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One scored row per incident.

    ``reference`` is read more than once; pass a stored table, not a long plan.
    """
    E.require_columns(incidents, ["number", *S.FACTOR_COLUMNS], "incidents")
    looked_up = lookup_rates(
        incidents.select("number", *S.FACTOR_COLUMNS), reference, broadcast_bytes
    )
    return score(looked_up, baseline).select(*SCORE_COLUMNS)


def profile_scores(
    profile: DataFrame,
    reference: DataFrame,
    baseline: float = S.RISK_BASELINE_RATE,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One scored row per combination of factors, with its ``incident_count``.

    The summaries below give the same result on this frame, weighted by
    ``incident_count``, as on the scores of all incidents.
    """
    small = check_reference(reference) <= broadcast_bytes
    return score(_joined_rates(profile, reference, small), baseline)


# ------------------------------------------------------------------ summaries


def _weight(weight: str | None) -> Column:
    return F.col(weight) if weight else F.lit(1)


def _weighted_mean(value: str, weight: str) -> Column:
    measured = F.when(F.col(value).isNotNull(), F.col(weight))
    total = F.sum(F.col(value).cast("double") * F.col(weight))
    return F.try_divide(total, F.sum(measured).cast("double"))


def risk_score_mean(scores: DataFrame, weight: str | None = None) -> DataFrame:
    weighted = scores.select("sla_risk_score", _weight(weight).alias("_w"))
    return weighted.agg(_weighted_mean("sla_risk_score", "_w").alias("mean_sla_risk_score"))


def _combined(scores: DataFrame, keys: list[str], weight: str | None) -> DataFrame:
    """Equal scores of equal keys put together before anything is shuffled twice."""
    return scores.groupBy(*keys, "sla_risk_band", "sla_risk_score", "risk_factor_count").agg(
        F.sum(_weight(weight)).alias("_w")
    )


def risk_portfolio(
    scores: DataFrame, weight: str | None = None, strict: bool = False
) -> DataFrame:
    """All four bands in order; an empty band has count 0 and no statistics."""
    E.require_columns(scores, ["sla_risk_band", "sla_risk_score", "risk_factor_count"])
    if strict:
        E.require_rows(scores, "there are no scored incidents to summarise")
    combined = _combined(scores, [], weight)
    total = combined.agg(F.sum("_w").alias("n")).scalar()
    grouped = combined.groupBy("sla_risk_band").agg(
        F.sum("_w").alias("_count"),
        _weighted_mean("sla_risk_score", "_w").alias("mean_sla_risk_score"),
        F.min("sla_risk_score").alias("min_sla_risk_score"),
        F.max("sla_risk_score").alias("max_sla_risk_score"),
        _weighted_mean("risk_factor_count", "_w").alias("mean_risk_factor_count"),
    )
    grouped = with_percentiles(
        grouped,
        combined,
        ["sla_risk_band"],
        {"median_sla_risk_score": ("sla_risk_score", 0.5)},
        weight="_w",
    )
    bands = scores.sparkSession.createDataFrame(
        list(enumerate(S.RISK_BANDS)), "_rank int, sla_risk_band string"
    )
    count = F.coalesce("_count", F.lit(0)).cast("bigint")
    return (
        bands.join(grouped, "sla_risk_band", "left")
        .withColumn("incident_count", count)
        .withColumn("_total", total)
        .orderBy("_rank")
        .select(
            "sla_risk_band",
            "incident_count",
            E.percent(F.col("incident_count"), F.col("_total")).alias("incident_share_pct"),
            "mean_sla_risk_score",
            "median_sla_risk_score",
            "min_sla_risk_score",
            "max_sla_risk_score",
            "mean_risk_factor_count",
        )
    )


def risk_concentration(
    scores: DataFrame,
    weight: str | None = None,
    min_sample: int = S.MIN_SEGMENT_SAMPLE,
    strict: bool = False,
) -> DataFrame:
    """Elevated (High and Critical) and critical shares per value of the four
    dimensions. Incidents are combined per factor combination before they are
    spread over the dimensions."""
    E.require_columns(
        scores, [*S.FACTOR_COLUMNS, "sla_risk_score", "sla_risk_band", "risk_factor_count"]
    )
    if strict:
        E.require_rows(scores, "there are no scored incidents to summarise")
    carried = ["sla_risk_band", "sla_risk_score", "risk_factor_count", "_w"]
    long = (
        _combined(scores, S.FACTOR_COLUMNS, weight)
        .select(F.inline(_factor_rows(*carried)))
        .where(F.col("factor_value").isNotNull())
        .withColumnsRenamed({"factor_type": "dimension", "factor_value": "dimension_value"})
    )
    keys = ["dimension", "dimension_value"]
    band, count = F.col("sla_risk_band"), F.col("_w")

    def banded(*bands: str) -> Column:
        return F.coalesce(F.sum(F.when(band.isin(*bands), count)), F.lit(0)).cast("bigint")

    grouped = long.groupBy(*keys).agg(
        F.sum("_w").cast("bigint").alias("incident_count"),
        banded("High", "Critical").alias("elevated_risk_incident_count"),
        banded("Critical").alias("critical_risk_incident_count"),
        _weighted_mean("sla_risk_score", "_w").alias("mean_sla_risk_score"),
        _weighted_mean("risk_factor_count", "_w").alias("mean_risk_factor_count"),
    )
    total = F.col("incident_count")
    sampled = F.col("dimension").isin(S.SAMPLED_FACTORS)
    return (
        with_percentiles(
            grouped, long, keys, {"median_sla_risk_score": ("sla_risk_score", 0.5)}, weight="_w"
        )
        .select(
            *keys,
            "incident_count",
            "elevated_risk_incident_count",
            E.percent(F.col("elevated_risk_incident_count"), total).alias(
                "elevated_risk_share_pct"
            ),
            "critical_risk_incident_count",
            E.percent(F.col("critical_risk_incident_count"), total).alias(
                "critical_risk_share_pct"
            ),
            "mean_sla_risk_score",
            "median_sla_risk_score",
            "mean_risk_factor_count",
            (~sampled | (total >= min_sample)).alias("comparison_eligible"),
        )
        .orderBy(
            E.rank_in(
                F.col("dimension"),
                ["Category", "Priority", "Reassignment Bucket", "Assignment Group"],
            ),
            "dimension_value",
        )
    )


def concentration_top15(concentration: DataFrame) -> DataFrame:
    return concentration.orderBy(
        F.desc_nulls_last("elevated_risk_share_pct"),
        F.desc("elevated_risk_incident_count"),
        "dimension",
        "dimension_value",
    ).limit(15)
