import pytest
from pyspark.sql import functions as F

from breachscope import schema as S
from breachscope.operators import bottlenecks as B
from breachscope.operators import risk as R
from breachscope.operators import segments as G
from tests.fixtures import incidents, sample_rows

_REFERENCE = "factor_type string, factor_value string, breach_rate double"


@pytest.fixture(scope="module")
def frame(spark):
    return incidents(spark, sample_rows()).cache()


@pytest.fixture(scope="module")
def reference(frame):
    return R.reference_from_profile(R.factor_profile(frame)).cache()


def _same(a, b, digits=9):
    def rows(df):
        return sorted(
            (
                tuple(round(v, digits) if isinstance(v, float) else v for v in row)
                for row in df.collect()
            ),
            key=str,
        )

    assert a.columns == b.columns and rows(a) == rows(b)


def test_both_ways_to_the_reference_agree(frame, reference):
    tables = [
        G.sla_category(frame),
        G.sla_priority(frame),
        G.sla_reassignment(frame),
        G.sla_assignment_group(frame),
    ]
    _same(R.risk_reference(*tables), reference)


def test_repeated_numbers_are_counted_once(spark):
    rows = sample_rows(300)
    doubled = incidents(spark, rows + rows[:120])
    counted = {r["priority"]: r["incident_count"] for r in G.sla_priority(doubled).collect()}
    expected = {r["priority"]: r["incident_count"] for r in G.sla_priority(incidents(spark, rows)).collect()}
    assert counted == expected


def test_assumed_uniqueness_gives_the_same_tables(frame):
    _same(G.sla_category(frame), G.sla_category(frame, unique_numbers=True))
    _same(G.sla_assignment_group(frame), G.sla_assignment_group(frame, unique_numbers=True))


def test_large_reference_is_joined_without_broadcast(frame, reference):
    small = R.risk_scores(frame, reference)
    large = R.risk_scores(frame, reference, broadcast_bytes=0)
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    _same(small, large)
    assert small.columns == R.SCORE_COLUMNS


def test_unlisted_factor_values_have_no_contribution(spark):
    rows = [
        {"number": "A", "priority": "1 - Critical", "category": "new"},
        {"number": "B", "priority": "odd", "category": "new"},
    ]
    reference = spark.createDataFrame([("Priority", "1 - Critical", 90.0)], _REFERENCE)
    a, b = R.risk_scores(incidents(spark, rows), reference).orderBy("number").collect()
    assert a["risk_factor_count"] == 1 and a["category_risk_contribution"] is None
    assert a["sla_risk_score"] == pytest.approx(100 * (90 - 36.58) / (100 - 36.58))
    assert (b["risk_factor_count"], b["sla_risk_score"], b["sla_risk_band"]) == (0, None, None)


@pytest.mark.parametrize(
    "rows, message",
    [
        ([], "no risk reference"),
        ([("Priority", "x", 1.0), ("Priority", "x", 2.0)], "more than once"),
        ([("Priority", "x", None)], "has no breach rate"),
        ([("Priority", "x", 100.5)], "not a percentage"),
    ],
)
def test_unusable_references_are_refused(spark, frame, rows, message):
    with pytest.raises(ValueError, match=message):
        R.risk_scores(frame, spark.createDataFrame(rows, _REFERENCE))


def test_baseline_must_leave_room(frame, reference):
    with pytest.raises(ValueError, match="baseline"):
        R.risk_scores(frame, reference, baseline=100.0)


def test_summaries_of_combinations_equal_those_of_incidents(frame, reference):
    scores = R.risk_scores(frame, reference).cache()
    combined = R.profile_scores(R.factor_profile(frame), reference).cache()
    weight = "incident_count"
    _same(R.risk_portfolio(scores), R.risk_portfolio(combined, weight), 8)
    _same(R.risk_concentration(scores), R.risk_concentration(combined, weight), 8)
    _same(R.risk_score_mean(scores), R.risk_score_mean(combined, weight), 8)


def test_empty_band_is_listed_with_count_zero(spark):
    scores = spark.createDataFrame(
        [("Low", 10.0, 2), ("Low", 20.0, 4), ("High", 60.0, 3), (None, None, 0)],
        "sla_risk_band string, sla_risk_score double, risk_factor_count int",
    )
    rows = R.risk_portfolio(scores).collect()
    assert [r["sla_risk_band"] for r in rows] == S.RISK_BANDS
    assert [r["incident_count"] for r in rows] == [2, 0, 1, 0]
    assert [r["incident_share_pct"] for r in rows] == [50.0, 0.0, 25.0, 0.0]
    assert rows[0]["median_sla_risk_score"] == 15.0 and rows[1]["mean_sla_risk_score"] is None


def test_strict_summaries_refuse_empty_input(spark, frame, reference):
    nothing = R.risk_scores(frame, reference).limit(0)
    with pytest.raises(ValueError, match="no scored"):
        R.risk_portfolio(nothing, strict=True)
    with pytest.raises(ValueError, match="no scored"):
        R.risk_concentration(nothing, strict=True)


def test_concentration_against_counting_by_hand(frame, reference):
    scores = R.risk_scores(frame, reference)
    rows = scores.collect()
    for found in R.risk_concentration(scores).collect():
        column = {label: column for column, label, _ in S.RISK_FACTORS}[found["dimension"]]
        own = [r for r in rows if r[column] == found["dimension_value"]]
        assert found["incident_count"] == len(own)
        assert found["elevated_risk_incident_count"] == sum(
            r["sla_risk_band"] in ("High", "Critical") for r in own
        )
        assert found["mean_sla_risk_score"] == pytest.approx(
            sum(r["sla_risk_score"] for r in own) / len(own)
        )


def test_no_eligible_group(spark):
    groups = G.sla_assignment_group(incidents(spark, sample_rows(60))).cache()
    assert B.bottlenecks(groups).isEmpty() and B.driver_comparison(
        B.drivers(groups, B.bottlenecks(groups))
    ).isEmpty()
    assert [r["groups"] for r in B.class_counts(B.bottlenecks(groups)).collect()] == [0, 0, 0, 0]
    with pytest.raises(ValueError, match="to be classified"):
        B.bottlenecks(groups, strict=True)
    with pytest.raises(ValueError, match="look for drivers"):
        B.drivers(groups, B.bottlenecks(groups), strict=True)


def test_group_without_class_is_refused(frame):
    groups = G.sla_assignment_group(frame).cache()
    partial = B.bottlenecks(groups).where(F.col("assignment_group") != "G0")
    with pytest.raises(AssertionError, match="has no class"):
        B.drivers(groups, partial, strict=True)
