"""Plans that read or shuffle the incidents once, with the results of the longer way."""

import re

import pytest
from pyspark.sql import functions as F

from breachscope.functions.percentiles import exact_percentiles
from breachscope.operators import checks as C
from breachscope.operators import kpis as K
from breachscope.operators import risk as R
from breachscope.operators import segments as G
from breachscope.operators import sql_reports as Q
from breachscope.session import settle, shared_folder
from tests.fixtures import incidents, sample_rows


@pytest.fixture(scope="module")
def frame(spark):
    return settle(incidents(spark, sample_rows()))


@pytest.fixture
def by_plan(spark):
    """The text of the plan that ran."""

    def ran(df):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        # The last plan of an adaptive one only, without what it began with.
        return re.split(r"\n.*== Initial Plan ==", plan)[0]

    return ran


def _rounded(df):
    return sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str
    )


TABLES = [
    G.sla_monthly, G.sla_category, G.sla_priority, G.sla_reassignment, G.reassignment_resolution, G.sla_assignment_group,
]


def test_six_tables_from_one_scan(spark, frame, by_plan):
    cells = G.SegmentCells(frame)
    source = set(frame.inputFiles())
    for table in TABLES:
        from_cells, direct = table(cells), table(frame, unique_numbers=True)
        assert from_cells.dtypes == direct.dtypes
        assert _rounded(from_cells) == _rounded(direct)
        files = set(from_cells.inputFiles())
        assert files and not files & source
    assert by_plan(G.sla_category(cells, percentiles=False)).count("FileScan") == 1
    one = G.SegmentCells(frame.limit(0))
    assert all(table(one).count() == 0 for table in TABLES)


def test_the_cells_are_one_aggregate(spark, frame, monkeypatch):
    made = []
    monkeypatch.setattr(G, "settle", lambda df: made.append(df) or settle(df))
    G.SegmentCells(frame)
    plan = made[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "Expand" in plan
    assert not set(made[1].inputFiles()) & set(frame.inputFiles())


@pytest.mark.parametrize("report", [K.kpi_resolution, K.kpi_closure, K.kpi_reassignment, Q.q04_resolution_distribution])
def test_figures_and_percentiles_read_once(frame, by_plan, report):
    plan = by_plan(report(frame))
    # Readers of the counted cells reuse them; only the first of them scans.
    assert plan.count("FileScan") - plan.count("ReusedExchange") <= 1 or len(re.findall("FileScan", plan)) == 1


def test_plain_figures_are_those_of_all_values(spark):
    rows = [("a", 1.0), ("a", None), ("a", 4.0), ("a", 4.0), ("b", None), (None, -2.5)]
    df = spark.createDataFrame(rows, "k string, v double").withColumn("one", F.lit(0.0))
    plain = {"n": ("v", "count"), "mean": ("v", "mean"), "low": ("v", "min"), "high": ("v", "max"), "all": ("one", "count")}
    found = exact_percentiles(df, ["k"], {"m": ("v", 0.5)}, plain=plain)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [("a", 4.0, 3.0, 3.0, 1.0, 4.0, 4.0), ("b", None, None, None, None, None, 1.0), (None, -2.5, 1.0, -2.5, -2.5, -2.5, 1.0)],
        key=str,
    )
    weighted = exact_percentiles(df.withColumn("w", F.lit(3)), [], {}, "w", {"n": ("v", "count"), "mean": ("v", "mean")})
    assert [tuple(r) for r in weighted.collect()] == [(12.0, 1.625)]
    nothing = Q.q04_resolution_distribution(incidents(spark, [])).collect()
    assert [tuple(r) for r in nothing] == [(0, None, None, None, None, None)]


def test_largest_values_keep_their_type(frame):
    assert K.kpi_reassignment(frame).schema["max_reassignments"].dataType == frame.schema["reassignment_count"].dataType


def _reference(frame):
    return settle(R.reference_from_profile(R.factor_profile(frame), min_sample=5))


def test_rates_beyond_the_bound_shuffle_incidents_once(spark, frame, by_plan):
    reference = _reference(frame)
    small = R.risk_scores(frame, reference)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = R.risk_scores(frame, reference, broadcast_bytes=0)
        plan = large._jdf.queryExecution().executedPlan().toString()
        # Exchanges whose rows carry the number are those of whole incidents.
        assert len(re.findall(r"Exchange hashpartitioning\(_of", plan)) == 1
        assert len(re.findall("number#", "".join(x for x in plan.splitlines() if "Exchange" in x))) == 0
        assert _rounded(large) == _rounded(small) and large.count() == frame.count()
        text = large._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("number#") and text.count("Join LeftOuter") == 4 and text.count("Join Inner") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_identities_take_one_exchange(spark, frame):
    reference = _reference(frame)
    scores = settle(R.risk_scores(frame, reference))
    checked = C.v02_risk_scores(scores, frame, reference)
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(number", plan)) == 1
    twice = scores.unionByName(scores.limit(3)).unionByName(scores.limit(2).withColumn("number", F.lit(None).cast("string")))
    found = {r["check_name"]: r["violations"] for r in C.v02_risk_scores(twice, frame, reference).collect()}
    assert found["duplicate_numbers"] == 5 and found["row_count"] == 5 and found["number_count"] == 0
    fewer = {r["check_name"]: r["violations"] for r in C.v02_risk_scores(scores.limit(100), frame, reference).collect()}
    assert fewer["number_count"] == fewer["row_count"] == frame.count() - 100
    v01 = C.v01_incidents(frame, 1200)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(number", v01)) == 1
    assert shared_folder(spark)
