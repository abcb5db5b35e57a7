import pytest
from pyspark.sql import functions as F

from breachscope.functions import expressions as E
from breachscope.operators import kpis as K
from breachscope.operators import sql_reports as Q
from tests.fixtures import incidents, sample_rows


def _values(spark, rows, schema, **columns):
    frame = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in frame.select(*[c.alias(n) for n, c in columns.items()]).collect()]


def test_wilson_bounds(spark):
    lower, upper = E.wilson_bounds(F.col("s"), F.col("n"))
    found = _values(spark, [(265, 270), (0, 5), (5, 5), (0, 0)], "s int, n int", lower=lower, upper=upper)
    assert found[0] == pytest.approx((0.9573891721, 0.9920648188), abs=1e-9)
    assert found[1][0] == 0.0 and 0 < found[1][1] < 1
    assert found[2][1] == 1.0 and 0 < found[2][0] < 1
    assert found[3] == (None, None)


def test_band_edges_are_closed_on_the_left(spark):
    scores = [0.0, 24.999, 25.0, 50.0, 75.0, 100.0, None]
    found = _values(spark, [(s,) for s in scores], "s double", band=E.risk_band(F.col("s")))
    assert [b for (b,) in found] == ["Low", "Low", "Moderate", "High", "Critical", "Critical", None]


def test_bucket_edges_are_closed_on_the_right(spark):
    counts = [-1, 0, 1, 2, 3, 5, 6, None]
    found = _values(spark, [(c,) for c in counts], "c int", bucket=E.reassignment_bucket(F.col("c")))
    assert [b for (b,) in found] == ["0", "0", "1-2", "1-2", "3-5", "3-5", "6+", None]


def test_unknown_rate_is_not_zero_risk(spark):
    rates = [None, 10.0, 36.58, 100.0]
    found = _values(spark, [(r,) for r in rates], "r double", c=E.risk_contribution(F.col("r"), 36.58))
    assert [c for (c,) in found] == [None, 0.0, 0.0, 1.0]


def test_score_is_the_mean_of_known_contributions(spark):
    parts = [F.col(c) for c in "abcd"]
    rows = [(0.5, None, 1.0, None), (None,) * 4, (0.25,) * 4]
    schema = "a double, b double, c double, d double"
    found = _values(spark, rows, schema, n=E.factor_count(parts), s=E.risk_score(parts))
    assert found == [(2, 75.0), (0, None), (4, 25.0)]


def test_two_digit_rates_round_ties_up(spark):
    rows = [(1, 8), (1, 800), (3, 800), (0, 7), (5, 0)]
    found = _values(spark, rows, "a bigint, b bigint", p=E.percent_2dp(F.col("a"), F.col("b")))
    assert [p for (p,) in found] == [12.5, 0.13, 0.38, 0.0, None]
    assert _values(spark, [(1.005,)], "v double", r=E.round_2dp(F.col("v"))) == [(1.01,)]


def test_ranks_and_levels(spark):
    rows = [("1 - Critical",), ("4 - Low",), ("5 - Odd",), (None,)]
    found = _values(spark, rows, "p string", level=E.priority_level(F.col("p")), rank=E.priority_rank(F.col("p")))
    assert found == [("Critical", 1), ("Low", 4), ("Unknown", 5), ("Unknown", 5)]


def test_equal_to_a_threshold_is_high(spark):
    count, rate = F.col("n"), F.col("r")
    label = E.bottleneck_class(count, rate, F.lit(10.0), F.lit(50.0))
    found = _values(spark, [(10, 50.0), (10, 49.9), (9, 50.0), (9, 1.0)], "n int, r double", c=label)
    assert [c for (c,) in found] == ["Critical Bottleneck", "Volume Bottleneck", "SLA Risk", "Lower Priority"]


def test_key_figures_of_an_empty_table(spark):
    nothing = incidents(spark, [])
    row = K.kpi_overall(nothing).first()
    assert row["total_incidents"] == 0 and row["sla_breach_rate"] == 0.0
    assert set(K.kpi_resolution(nothing).first()) == {None}
    assert set(K.kpi_closure(nothing).first()) == {None}
    assert Q.q01_kpi_summary(nothing).first()["sla_breach_rate_pct"] is None


def test_required_columns_are_named(spark):
    with pytest.raises(ValueError, match="category, priority"):
        E.require_columns(spark.range(1), ["id", "category", "priority"])
    with pytest.raises(ValueError, match="nothing here"):
        E.require_rows(spark.range(0), "nothing here")


def test_null_segments_are_kept_or_named(spark):
    frame = incidents(spark, sample_rows())
    categories = {r["category"] for r in K.kpi_category(frame).collect()}
    assert None in categories and len(categories) == 5
    assert {r["assignment_group"] for r in Q.q07_assignment_group(frame, 1).collect()} >= {"Unknown"}
    assert None in {r["category"] for r in Q.q06_category_sla(frame, 1).collect()}


def test_concentration_shares_are_of_surviving_pairs(spark):
    frame = incidents(spark, sample_rows())
    rows = Q.q09_breach_concentration(frame, 80).collect()
    assert 0 < len(rows) < 20
    total = sum(r["sla_breached_incidents"] for r in rows)
    for row in rows:
        assert row["share_of_all_breaches_pct"] == pytest.approx(100 * row["sla_breached_incidents"] / total, abs=0.0051)


def test_numbers_and_dates_take_no_spelling_of_other_languages(spark):
    texts = ["1", " 2.5 ", "1d", "1f", "0x1", "1e3", ".5", "NaN", ""]
    row = spark.createDataFrame([(t,) for t in texts], "t string").select(E.number(F.col("t")).alias("n"))
    assert [r["n"] for r in row.collect()] == [1.0, 2.5, None, None, None, 1000.0, 0.5, None, None]
    days = ["2016", "2016-03", "3/2/2016 04:05", "2016-02-03 04:05:00"]
    row = spark.createDataFrame([(t,) for t in days], "t string").select(E.day_first_time(F.col("t")).alias("d"))
    first, second, third, fourth = [r["d"] for r in row.collect()]
    assert first is None and second is None and third == fourth is not None
