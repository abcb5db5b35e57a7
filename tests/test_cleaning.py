from datetime import datetime

import pytest
from pyspark.sql import functions as F

from breachscope import schema as S
from breachscope.operators import cleaning as L
from breachscope.operators.checks import v01_incidents
from breachscope.sources import mapping as M
from breachscope.sources.events import read_event_log
from tests.fixtures import write_log


@pytest.fixture(scope="module")
def cleaned(spark, tmp_path_factory):
    path = write_log(tmp_path_factory.mktemp("log") / "events.csv")
    return {r["number"]: r for r in L.clean_incidents(read_event_log(spark, path)).collect()}


def test_one_row_per_known_number(cleaned):
    assert sorted(cleaned) == ["I1", "I2", "I3", "I4", "I5", "I6", "I7"]


def test_columns_in_fixed_order(spark, tmp_path):
    log = read_event_log(spark, write_log(tmp_path / "e.csv"))
    assert L.clean_incidents(log).columns == S.INCIDENT_COLUMNS


def test_latest_event_and_first_opening(cleaned):
    row = cleaned["I1"]
    assert row["sla_breached"] is True and row["reassignment_bucket"] == "3-5"
    assert row["opened_at"] == datetime(2016, 2, 29, 1, 16)
    assert row["resolution_time_hours"] == pytest.approx(10 + 13 / 60)
    assert (row["opened_month"], row["opened_year"]) == ("2016-02", 2016)


def test_counter_keeps_its_maximum(cleaned):
    row = cleaned["I2"]
    assert row["reassignment_count"] == 6 and row["reassignment_bucket"] == "6+"
    assert row["resolved_at"] is None and row["sla_breached"] is True


def test_tie_is_settled_by_row_order(cleaned):
    assert cleaned["I3"]["sla_breached"] is True


def test_event_without_time_is_last(cleaned):
    row = cleaned["I4"]
    assert row["sla_breached"] is False and row["reassignment_count"] == 2


def test_unknown_outcome_stays_unknown(cleaned):
    row = cleaned["I5"]
    assert row["sla_breached"] is None and row["reassignment_bucket"] is None
    assert row["reopened"] is False


def test_bad_date_is_null(cleaned):
    assert cleaned["I6"]["resolved_at"] is None


def test_negative_duration_and_count(cleaned):
    row = cleaned["I7"]
    assert row["resolution_time_hours"] == -24.0 and row["reassignment_bucket"] == "0"


def test_unexpected_flag_fails_naming_column_and_value(spark, tmp_path):
    bad = [("I8", "8/3/2016 10:00", "8/3/2016 09:00", "?", "maybe", "0")]
    log = read_event_log(spark, write_log(tmp_path / "bad.csv", bad))
    with pytest.raises(Exception, match="made_sla.*neither true nor false: maybe"):
        L.clean_incidents(log).collect()
    assert L.clean_incidents(log, strict=False).first()["made_sla"] is None
    assert [tuple(r) for r in L.unexpected_flags(log).collect()] == [("made_sla", "maybe", 1)]


def test_counters_accept_whole_numbers_only(spark):
    values = ["3", " 4 ", "5.0", "2.5", "x", "nan", None, "99999999999"]
    events = spark.createDataFrame([(v, v, v) for v in values], ", ".join(f"{c} string" for c in S.EVENT_COUNTERS))
    found = [r["reopen_count"] for r in L.coerce_counters(events).collect()]
    assert found == [3, 4, 5, None, None, None, None, None]


def test_null_tokens_match_exactly(spark):
    values = [*S.NULL_TOKENS, " ?", "n.a.", "nAn"]
    frame = spark.createDataFrame([(v,) for v in values], "t string")
    kept = [r["t"] for r in L.null_tokens(frame).collect() if r["t"] is not None]
    assert kept == [" ?", "n.a.", "nAn"]


def test_days_come_first_in_any_session_zone(spark):
    frame = spark.createDataFrame(
        [("1/2/2016 3:04",), ("13/14/2016 1:00",), ("13/3/2016 02:30",), ("2016-02-01 03:04:05",)],
        "opened_at string",
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = [r["opened_at"] for r in L.parse_timestamps(frame).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == [
        datetime(2016, 2, 1, 3, 4),
        None,
        datetime(2016, 3, 13, 2, 30),
        datetime(2016, 2, 1, 3, 4, 5),
    ]


def test_text_log_equals_typed_log(spark, sf_dir):
    typed = M.event_log(spark, sf_dir)
    parsed = L.type_events(L.null_tokens(M.raw_event_log(spark, sf_dir))).select(*typed.columns)
    assert parsed.exceptAll(typed).isEmpty() and typed.exceptAll(parsed).isEmpty()


def test_pruned_collapse_equals_full(spark, sf_dir):
    events = M.event_log(spark, sf_dir)
    columns = ["priority", "sla_breached", "resolution_time_hours"]
    some = L.clean_incidents(events, columns)
    assert set(some.columns) == {"number", *columns}
    full = L.clean_incidents(events).select(*some.columns)
    assert some.exceptAll(full).isEmpty() and full.exceptAll(some).isEmpty()


def test_collapse_combines_before_its_only_shuffle(spark, tmp_path):
    log = read_event_log(spark, write_log(tmp_path / "e.csv"))
    plan = L.clean_incidents(log)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_max_by" in plan.split("Exchange hashpartitioning")[1]


def test_incident_checks_report_the_edge_rows(spark, tmp_path):
    log = read_event_log(spark, write_log(tmp_path / "e.csv"))
    found = {r["check_name"]: r["violations"] for r in v01_incidents(L.clean_incidents(log), 8).collect()}
    assert found["negative_resolution"] == 1 and found["row_count"] == 1
    assert found["duplicate_numbers"] == 0 and found["opened_at_missing"] == 0


def test_one_number_with_most_events(spark):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("N"), F.col("id"))).alias("number"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("sys_updated_at"),
        F.lit(True).alias("made_sla"),
        (F.col("id") % 1000).cast("int").alias("reassignment_count"),
        F.lit(0).alias("reopen_count"),
        F.col("id").cast("int").alias("sys_mod_count"),
        F.col("id").alias(L.ROW_ORDER),
    )
    hot = L.clean_incidents(rows).where("number = 'HOT'").collect()
    assert len(hot) == 1 and hot[0]["sys_mod_count"] == 29997 and hot[0]["reassignment_count"] == 999




def test_events_without_an_order_of_rows_are_refused(spark):
    events = spark.createDataFrame([("I1", None)], "number string, sys_updated_at timestamp_ntz")
    with pytest.raises(ValueError, match="order of its rows"):
        L.collapse_events(events)
