import numpy as np
import pytest
from pyspark.sql import functions as F

from breachscope.functions import percentiles as P
from breachscope.functions.percentiles import exact_percentiles, with_percentiles


def _frame(spark, rows, schema="k string, v double"):
    return spark.createDataFrame(rows, schema)


def _check(spark, rows, fractions=(0.0, 0.25, 0.5, 0.9, 0.99, 1.0)):
    wanted = {f"p{i}": ("v", f) for i, f in enumerate(fractions)}
    found = exact_percentiles(_frame(spark, rows), ["k"], wanted).collect()
    groups = {}
    for key, value in rows:
        if value is not None:
            groups.setdefault(key, []).append(value)
    assert {r["k"] for r in found} == set(groups)
    for row in found:
        expected = np.percentile(groups[row["k"]], [100 * f for f in fractions])
        assert [row[name] for name in wanted] == pytest.approx(list(expected), abs=1e-9)


@pytest.mark.parametrize("scale", [1e-3, 1.0, 1e4, 1e9])
def test_agrees_with_numpy(spark, scale):
    rng = np.random.default_rng(7)
    values = rng.lognormal(0, 2, 3000) * scale * rng.choice([-1, 1], 3000)
    keys = rng.choice(["hot", "hot", "a", "b", None], 3000)
    _check(spark, [(k, float(v)) for k, v in zip(keys, values)])


def test_repeated_and_tied_values(spark):
    _check(spark, [("a", float(i % 3)) for i in range(50)] + [("b", 5.0)] * 7 + [("c", 1.0), ("c", 2.0)])


def test_values_packed_into_one_range(spark):
    _check(spark, [("a", 1000.0 + i * 1e-7) for i in range(500)])


def test_nulls_are_skipped_and_empty_groups_left_out(spark):
    rows = [("a", None), ("a", 2.0), ("a", 4.0), ("b", None)]
    _check(spark, rows)
    frame = _frame(spark, rows)
    summary = frame.groupBy("k").agg(F.count("*").alias("n"))
    joined = with_percentiles(summary, frame, ["k"], {"m": ("v", 0.5)})
    assert {(r["k"], r["n"], r["m"]) for r in joined.collect()} == {("a", 3, 3.0), ("b", 1, None)}


def test_empty_input_without_keys_is_one_null_row(spark):
    found = exact_percentiles(_frame(spark, []), [], {"m": ("v", 0.5)}).collect()
    assert [tuple(r) for r in found] == [(None,)]


def test_weights_stand_for_repeated_rows(spark):
    plain = _frame(spark, [("a", 1.0)] * 5 + [("a", 2.0)] * 2 + [("a", 9.0)])
    counted = _frame(spark, [("a", 1.0, 3), ("a", 1.0, 2), ("a", 2.0, 2), ("a", 9.0, 1)], "k string, v double, n int")
    wanted = {"m": ("v", 0.5), "p": ("v", 0.8), "q": ("v", 0.95)}
    assert (
        exact_percentiles(plain, ["k"], wanted).collect()
        == exact_percentiles(counted, ["k"], wanted, weight="n").collect()
    )


def test_several_columns_and_keys(spark):
    rng = np.random.default_rng(3)
    rows = [("x" if i % 2 else None, i % 3, float(rng.normal()), float(i)) for i in range(600)]
    frame = _frame(spark, rows, "a string, b int, v double, w double")
    wanted = {"mv": ("v", 0.5), "mw": ("w", 0.5), "pw": ("w", 0.9)}
    found = exact_percentiles(frame, ["a", "b"], wanted).collect()
    assert len(found) == 6
    for row in found:
        v = [r[2] for r in rows if r[:2] == (row["a"], row["b"])]
        w = [r[3] for r in rows if r[:2] == (row["a"], row["b"])]
        assert row["mv"] == pytest.approx(np.median(v))
        assert (row["mw"], row["pw"]) == pytest.approx((np.median(w), np.percentile(w, 90)))


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_input_is_read_once_and_the_cells_are_reused(spark, tmp_path, threshold):
    path = str(tmp_path / "v")
    spark.range(20_000).selectExpr("id % 7 AS k", "cast(id * 37 % 1009 AS double) AS v").write.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = exact_percentiles(spark.read.parquet(path), ["k"], {"m": ("v", 0.5), "p": ("v", 0.9)})
        assert found.count() == 7
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan


def test_a_crowded_minute_is_not_ranked_by_one_task(spark):
    # A million different values between 24 h and 24 h and a minute, in one group.
    crowded = spark.range(1_000_000).selectExpr("'a' AS k", "24 + id / 6.0e7 AS v")
    found = exact_percentiles(crowded, ["k"], {"m": ("v", 0.5), "p": ("v", 0.9)})
    row = found.collect()[0]
    assert row["m"] == pytest.approx(24 + 499_999.5 / 6e7, abs=1e-12)
    assert row["p"] == pytest.approx(24 + 899_999.1 / 6e7, abs=1e-12)
    # What the last ranking sorts together: the values of one step of one range.
    ranged = crowded.withColumn("r", P._value_range(F.col("v")))
    limits = ranged.groupBy("r").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    share = (F.col("v") - F.col("low")) / (F.col("high") - F.col("low"))
    steps = ranged.join(limits, "r").groupBy("r", F.floor(share * P._STEPS).alias("s")).count()
    assert steps.agg(F.max("count")).first()[0] <= 300
