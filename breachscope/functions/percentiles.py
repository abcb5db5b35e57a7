"""Exact interpolated percentiles that no single task has to hold a group for.

The built-in ``percentile`` merges every distinct value of a group into one
in-memory map on one reducer. Where one group may hold a third of all rows that
reducer is the limit of the whole job, so the reports use this form:

1. count equal values per group (map-side combine; equal values collapse);
2. add those counts up per coarse value range, and find by a running sum over
   the ranges which of them hold the wanted ranks;
3. cut those ranges again, into equal steps between their smallest and largest value,
   and find the steps that hold the wanted ranks in the same way;
4. rank only the values inside those steps.

A range is a function of the value alone and grows with it, so the running sum
is exact whatever the data looks like. A group spreads over as many tasks as it
has ranges, and only one or two steps per percentile are ever sorted: a range into
which a million different values crowd is ranked by some hundreds of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Ranges per factor e of the value: each is under 1 % wide, and values below one
# (an hour, a score point) are cut into 1/128 steps.
_RANGES_PER_E = 128
# Steps of a range that holds a wanted rank.
_STEPS = 4096


def _value_range(value: Column) -> Column:
    return F.floor(F.signum(value) * F.log1p(F.abs(value)) * F.lit(float(_RANGES_PER_E)))


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    wanted: Mapping[str, tuple[str, float]],
    weight: str | None = None,
    plain: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """One row per key with each ``output -> (value column, fraction)`` of ``wanted``.

    ``plain`` adds figures of the same counted values, ``output -> (value column,
    "count", "mean", "min" or "max")``, so that ``df`` is read once for both; they are
    doubles, and null where a key has no value in that column.

    Linear interpolation between the two neighbouring ranks; null values are
    skipped; null keys form a group of their own. Groups without any value do
    not appear. ``weight`` names a column of whole row counts for inputs that
    are already aggregated. Without keys the result is a single row, which is
    null throughout for an empty input.
    """
    plain = plain or {}
    values = list(dict.fromkeys(column for column, _ in [*wanted.values(), *plain.values()]))
    group = F.struct(*keys) if keys else F.lit(0)
    times = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    if len(values) == 1:
        measured = df.select(
            group.alias("_g"),
            F.lit(0).alias("_m"),
            F.col(values[0]).cast("double").alias("_v"),
            times.alias("_w"),
        )
    else:
        entries = [
            F.struct(F.lit(i).alias("_m"), F.col(c).cast("double").alias("_v"))
            for i, c in enumerate(values)
        ]
        measured = df.select(
            group.alias("_g"), times.alias("_w"), F.inline(F.array(*entries))
        )

    cells = (
        # Both readers of the cells must see the same filters, else nothing is reused:
        # the join on the range adds "the range is not null" to one of them.
        measured.where(F.col("_v").isNotNull() & _value_range(F.col("_v")).isNotNull())
        .groupBy("_g", "_m", "_v")
        .agg(F.sum("_w").alias("_n"))
        .withColumn("_r", _value_range(F.col("_v")))
    )

    whole = Window.partitionBy("_g", "_m")
    earlier = whole.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    kinds = {kind for _, kind in plain.values()}
    sums = [F.sum(F.col("_v") * F.col("_n")).alias("_sum")] if "mean" in kinds else []
    ranges = (
        cells.groupBy("_g", "_m", "_r")
        .agg(F.sum("_n").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), *sums)
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("_total", F.sum("_n").over(whole))
    )
    figures = {
        "count": lambda: F.col("_total").cast("double"),
        "mean": lambda: F.sum("_sum").over(whole) / F.col("_total"),
        "min": lambda: F.min("_low").over(whole),
        "max": lambda: F.max("_high").over(whole),
    }
    ranges = ranges.withColumns({f"_{kind}": figures[kind]() for kind in sorted(kinds)})
    carried = ["_total", *(f"_{kind}" for kind in sorted(kinds))]

    def position(fraction: float) -> Column:
        return F.lit(fraction) * (F.col("_total") - 1).cast("double")

    def holds(fraction: float, start: Column) -> tuple[Column, Column]:
        """Whether [start, start + _n) covers the rank below / above the position."""
        end = start + F.col("_n")
        low, high = F.floor(position(fraction)), F.ceil(position(fraction))
        return (start <= low) & (end > low), (start <= high) & (end > high)

    requests = {
        output: (values.index(column), fraction) for output, (column, fraction) in wanted.items()
    }
    by_metric: dict[int, set[float]] = {}
    for metric, fraction in requests.values():
        by_metric.setdefault(metric, set()).add(fraction)
    for column, _ in plain.values():  # some row of each group must reach the end
        by_metric.setdefault(values.index(column), {0.0})

    def any_rank(start: Column) -> Column:
        tests = []
        for metric, fractions in by_metric.items():
            hits = [test for f in sorted(fractions) for test in holds(f, start)]
            tests.append((F.col("_m") == metric) & reduce(lambda a, b: a | b, hits))
        return reduce(lambda a, b: a | b, tests)

    needed = ranges.where(any_rank(F.col("_before"))).select(
        "_g", "_m", "_r", "_before", *carried, "_low", "_high"
    )

    def start_in(window) -> Column:
        before = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.col("_before") + F.coalesce(F.sum("_n").over(before), F.lit(0))

    share = (F.col("_v") - F.col("_low")) / (F.col("_high") - F.col("_low"))
    step = F.when(F.col("_high") > F.col("_low"), F.floor(share * F.lit(float(_STEPS))))
    stepped = cells.join(needed, ["_g", "_m", "_r"]).withColumn("_s", F.coalesce(step, F.lit(0)))
    steps = stepped.groupBy("_g", "_m", "_r", "_s").agg(
        F.sum("_n").alias("_n"), *[F.first(c).alias(c) for c in ("_before", *carried)]
    )
    needed_steps = (
        steps.withColumn("_first", start_in(Window.partitionBy("_g", "_m", "_r").orderBy("_s")))
        .where(any_rank(F.col("_first")))
        .select("_g", "_m", "_r", "_s", F.col("_first").alias("_before"), *carried)
    )
    ranked = (
        stepped.select("_g", "_m", "_r", "_s", "_v", "_n")
        .join(needed_steps, ["_g", "_m", "_r", "_s"])
        .withColumn("_start", start_in(Window.partitionBy("_g", "_m", "_r", "_s").orderBy("_v")))
        .where(any_rank(F.col("_start")))
    )

    picks = []
    for output, (metric, fraction) in requests.items():
        low, high = holds(fraction, F.col("_start"))
        here = F.col("_m") == metric
        where = position(fraction)
        picks += [
            F.max(F.when(here & low, F.col("_v"))).alias(f"{output}_low"),
            F.max(F.when(here & high, F.col("_v"))).alias(f"{output}_high"),
            F.max(F.when(here, where - F.floor(where))).alias(f"{output}_part"),
        ]
    for output, (column, kind) in plain.items():
        here = F.col("_m") == values.index(column)
        picks.append(F.max(F.when(here, F.col(f"_{kind}"))).alias(output))
    grouped = ranked.groupBy("_g").agg(*picks) if keys else ranked.agg(*picks)
    results = [
        (
            F.col(f"{output}_low")
            + (F.col(f"{output}_high") - F.col(f"{output}_low")) * F.col(f"{output}_part")
        ).alias(output)
        for output in requests
    ]
    labels = [F.col("_g").getField(key).alias(key) for key in keys]
    return grouped.select(*labels, *results, *plain)


def with_percentiles(
    summary: DataFrame,
    df: DataFrame,
    keys: Sequence[str],
    wanted: Mapping[str, tuple[str, float]],
    weight: str | None = None,
) -> DataFrame:
    """Add exact percentiles of ``df`` to ``summary``, one row per ``keys`` in both.

    Both sides hold one row per group; the join strategy is left to the sizes
    seen at run time. The group travels as a struct, in which null equals null.
    """
    figures = exact_percentiles(df, keys, wanted, weight)
    left = summary.withColumn("_g", F.struct(*keys))
    right = figures.select(F.struct(*keys).alias("_g"), *wanted)
    return left.join(right, "_g", "left").drop("_g")
