"""Column expressions: no UDFs, everything stays inside generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breachscope import schema as S

# ---------------------------------------------------------------- raw values


def known(text: Column) -> Column:
    """Null where the raw text is one of the "no value" tokens (exact match)."""
    # "if" generates a quarter less code than "case when". With it the whole log
    # is cleaned by one method small enough for the JVM to compile (8000 bytes).
    return F.call_function("if", text.isin(S.NULL_TOKENS), F.lit(None).cast("string"), text)


def day_first_time(text: Column) -> Column:
    """Day-first or ISO text as a zone-free timestamp; anything else is null, a year or
    a month alone included.

    The text is turned into ISO order and cast to a zone-free type, so the
    session time zone (and its daylight-saving gaps) cannot shift a value.
    """
    day_first = r"^\s*(\d{1,2})[/-](\d{1,2})[/-](\d{4})"
    iso = F.regexp_replace(text, day_first, "$3-$2-$1")
    whole_date = iso.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}")
    return F.when(whole_date, iso).try_cast("timestamp_ntz")


def flag_word(value: Column) -> Column:
    return F.lower(F.trim(value.cast("string")))


def is_unexpected_flag(word: Column) -> Column:
    """True where a word is present but spells neither true nor false."""
    return F.coalesce(~word.isin(S.TRUE_WORDS + S.FALSE_WORDS), F.lit(False))


def flag(word: Column, name: str, strict: bool = True) -> Column:
    """A ``flag_word`` as a boolean.

    ``strict`` fails the job on an unexpected spelling; otherwise such values
    become null and are left to ``unexpected_flags`` to report.
    """
    result = F.when(word.isin(S.TRUE_WORDS), F.lit(True)).when(
        word.isin(S.FALSE_WORDS), F.lit(False)
    )
    if strict:
        message = F.concat(F.lit(f"column '{name}' holds a word that is neither true nor false: "), word)
        result = result.when(word.isNotNull(), F.raise_error(message).cast("boolean"))
    return result


def number(value: Column) -> Column:
    """A decimal number; spellings that only Java knows, such as ``1d``, are null."""
    text = F.trim(value.cast("string"))
    return F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text).try_cast("double")


def whole(amount: Column) -> Column:
    """A ``number`` as an integer, or null where it has a fraction."""
    return F.when(amount == F.floor(amount), amount).try_cast("int")


# ------------------------------------------------------------- derived values


def hours_between(start: Column, end: Column) -> Column:
    """Signed hours from ``start`` to ``end``, sub-seconds kept.

    Subtracting zone-free timestamps gives an interval without touching the
    session zone.
    """
    seconds = (end - start).cast("interval second").cast("decimal(20,6)")
    return seconds.cast("double") / F.lit(3600.0)


def reassignment_bucket(count: Column) -> Column:
    return (
        F.when(count <= 0, "0")
        .when(count <= 2, "1-2")
        .when(count <= 5, "3-5")
        .when(count > 5, "6+")
    )


def month_of(moment: Column) -> Column:
    """``YYYY-MM``, read off the text form so that no time zone is involved."""
    return F.substring(moment.cast("string"), 1, 7)


def is_reopened(count: Column) -> Column:
    return F.coalesce(count, F.lit(0)) > 0


# ------------------------------------------------------------ labels and ranks


def priority_level(priority: Column) -> Column:
    label = F.lit(None).cast("string")
    for raw, level in S.PRIORITY_LEVELS.items():
        label = F.when(priority == raw, level).otherwise(label)
    return F.coalesce(label, F.lit(S.UNKNOWN))


def reassignment_level(bucket: Column) -> Column:
    return F.when(bucket.isin(S.BUCKETS), bucket).otherwise(S.UNKNOWN)


def rank_in(value: Column, ordered: list[str]) -> Column:
    """1-based position in a fixed order; unknown and null values come last."""
    rank = F.lit(len(ordered) + 1)
    for position, item in enumerate(ordered, start=1):
        rank = F.when(value == item, position).otherwise(rank)
    return rank


def priority_rank(priority: Column) -> Column:
    return rank_in(priority, list(S.PRIORITY_LEVELS))


def bucket_rank(bucket: Column) -> Column:
    return rank_in(bucket, S.BUCKETS)


# --------------------------------------------------------------------- rates


def share(part: Column, whole: Column) -> Column:
    """A fraction in double; null when there is no whole."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return share(part, whole) * F.lit(100.0)


def percent_2dp(part: Column, whole: Column) -> Column:
    """A percentage rounded half up to 2 digits, decided on whole numbers.

    Two counts are rounded without going through binary fractions, so a tie
    never depends on how a double happens to be stored.
    """
    hundredths = F.when(
        whole != 0, F.call_function("div", part * 20000 + whole, F.nullif(whole * 2, F.lit(0)))
    )
    return hundredths.cast("double") / F.lit(100.0)


def round_2dp(value: Column) -> Column:
    """Two digits, half up, after dropping the noise beyond 9 digits."""
    return F.round(F.round(value, 9), 2)


def wilson_bounds(successes: Column, total: Column, z: float = S.WILSON_Z) -> tuple[Column, Column]:
    """Lower and upper Wilson score bounds as fractions, clipped to [0, 1].

    Null when there are no observations.
    """
    n = F.when(total > 0, total.cast("double"))
    p = successes.cast("double") / n
    z2 = F.lit(z**2)
    denominator = F.lit(1.0) + z2 / n
    center = (p + z2 / (F.lit(2.0) * n)) / denominator
    spread = F.sqrt(p * (F.lit(1.0) - p) / n + z2 / (F.lit(4.0) * n * n))
    margin = F.lit(z) * spread / denominator
    lower, upper = center - margin, center + margin
    # greatest/least skip nulls, hence the guard.
    return (
        F.when(lower.isNotNull(), F.greatest(F.lit(0.0), lower)),
        F.when(upper.isNotNull(), F.least(F.lit(1.0), upper)),
    )


# ---------------------------------------------------------------------- risk


def risk_contribution(rate: Column, baseline: float, top: float = S.RISK_SCORE_MAX) -> Column:
    """Position of a rate between the baseline (0) and the maximum (1).

    A missing rate stays missing: it means "no reference", not "no risk".
    """
    scaled = (rate - F.lit(baseline)) / F.lit(top - baseline)
    return F.when(rate.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), scaled)))


def factor_count(contributions: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in contributions])


def risk_score(contributions: list[Column], top: float = S.RISK_SCORE_MAX) -> Column:
    """Mean of the contributions that exist, scaled; null when none exists."""
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in contributions])
    return total / F.nullif(factor_count(contributions), F.lit(0)) * F.lit(top)


def risk_band(score: Column) -> Column:
    low, moderate, high = S.RISK_BAND_EDGES
    return (
        F.when(score < low, "Low")
        .when(score < moderate, "Moderate")
        .when(score < high, "High")
        .when(score >= high, "Critical")
    )


# ----------------------------------------------------------------- bottleneck


def volume_class(count: Column, threshold: Column) -> Column:
    return F.when(count >= threshold, "High Volume").otherwise("Lower Volume")


def breach_risk_class(rate: Column, threshold: Column) -> Column:
    return F.when(rate >= threshold, "High Breach Risk").otherwise("Lower Breach Risk")


def bottleneck_class(
    count: Column, rate: Column, count_threshold: Column, rate_threshold: Column
) -> Column:
    risky = rate >= rate_threshold
    of_busy = F.when(risky, "Critical Bottleneck").otherwise("Volume Bottleneck")
    of_quiet = F.when(risky, "SLA Risk").otherwise("Lower Priority")
    return F.when(count >= count_threshold, of_busy).otherwise(of_quiet)


def driver_segment(label: Column) -> Column:
    critical = "Critical Bottleneck"
    return F.when(label == critical, critical).otherwise("Other Eligible Groups")


# -------------------------------------------------------------------- guards


def require_columns(df: DataFrame, names: list[str], what: str = "dataset") -> None:
    """Fail, naming them, when input columns are missing. Looks at the schema only."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns: " + ", ".join(missing))


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(message)
    return df
