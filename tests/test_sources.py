import csv

import pytest

from breachscope import schema as S
from breachscope.operators import cleaning as L
from breachscope.operators import segments as G
from breachscope.operators.checks import raise_on_violations, v14_load
from breachscope.session import settle, shared_folder
from breachscope.sources import incidents as I
from breachscope.sources.events import read_event_log
from breachscope.sources.reports import REPORTS, read_report, write_report
from tests.fixtures import incidents, sample_rows, write_log


@pytest.fixture(scope="module")
def frame(spark):
    return incidents(spark, sample_rows(200))


def _rows(df):
    return sorted(df.collect(), key=str)


def test_log_columns_follow_the_file_and_must_exist(spark, tmp_path):
    names = list(reversed(S.RAW_COLUMNS))
    log = read_event_log(spark, write_log(tmp_path / "r.csv", names=names))
    assert log.columns == [*names, L.ROW_ORDER]
    assert L.clean_incidents(log).columns == S.INCIDENT_COLUMNS
    partial = write_log(tmp_path / "p.csv", names=[n for n in names if n != "reopen_count"])
    with pytest.raises(ValueError, match="reopen_count"):
        read_event_log(spark, partial)


def test_parquet_round_trip(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    assert I.write_incidents(frame, path, partition_by=("opened_year",)) == 200
    table = I.read_incidents(spark, path)
    assert table.schema == S.INCIDENT_SCHEMA and _rows(table) == _rows(frame)
    numbers = [r["number"] for r in I.read_incidents(spark, path, ordered=True).collect()]
    assert numbers == sorted(numbers)


def test_csv_load_and_row_count(spark, frame, tmp_path):
    source, table = str(tmp_path / "c"), str(tmp_path / "t")
    I.write_incidents(frame, source, "csv")
    assert I.load_incidents_table(spark, source, table, expected_rows=200) == 200
    assert _rows(I.read_incidents(spark, table)) == _rows(frame)
    with pytest.raises(ValueError, match="holds 200 incidents instead of 24,918"):
        I.load_incidents_table(spark, source, table, expected_rows=24_918)
    stored = I.read_incidents(spark, table)
    raise_on_violations(v14_load(stored, S.INCIDENT_COLUMNS, 200))
    with pytest.raises(AssertionError, match="header: 2.*row_count: 1"):
        swapped = [S.INCIDENT_COLUMNS[1], S.INCIDENT_COLUMNS[0], *S.INCIDENT_COLUMNS[2:]]
        raise_on_violations(v14_load(stored, swapped, 199))


def _write_csv(path, header, rows):
    with open(path, "w", newline="") as file:
        csv.writer(file).writerows([header, *rows])
    return str(path)


def _row(**values):
    return [values.get(name, "") for name in S.INCIDENT_COLUMNS]


def test_header_must_match_in_order(spark, tmp_path):
    header = [S.INCIDENT_COLUMNS[1], S.INCIDENT_COLUMNS[0], *S.INCIDENT_COLUMNS[2:]]
    path = _write_csv(tmp_path / "h.csv", header, [_row(number="A")])
    with pytest.raises(ValueError, match="not an incident table"):
        I.load_incidents_table(spark, path, str(tmp_path / "t"))


def test_load_reads_both_date_orders_and_empty_as_null(spark, tmp_path):
    rows = [_row(number="A", opened_at="2016-02-03 04:05:00", sys_created_at="3/2/2016 04:05", made_sla="True")]
    path = _write_csv(tmp_path / "d.csv", S.INCIDENT_COLUMNS, rows)
    loaded = I.read_incidents_csv(spark, path).first()
    assert loaded["opened_at"] == loaded["sys_created_at"] and loaded["made_sla"] is True
    assert loaded["category"] is None and loaded["reopen_count"] is None


@pytest.mark.parametrize("column, value", [("opened_at", "soon"), ("reopen_count", "two")])
def test_load_refuses_values_of_the_wrong_type(spark, tmp_path, column, value):
    path = _write_csv(tmp_path / "w.csv", S.INCIDENT_COLUMNS, [_row(number="A", **{column: value})])
    with pytest.raises(Exception, match=value):
        I.load_incidents_table(spark, path, str(tmp_path / "t"))


def test_report_input_must_have_its_columns(spark, tmp_path):
    path = _write_csv(tmp_path / "m.csv", ["number", "category"], [["A", "C"]])
    with pytest.raises(ValueError, match="priority, assignment_group, made_sla"):
        I.read_incidents_csv(spark, path)


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_report_round_trip(spark, frame, tmp_path, file_format):
    table = G.sla_priority(frame)
    kept = write_report(table, str(tmp_path), "priority_sla_performance", file_format)
    assert _rows(kept) == _rows(table)
    again = read_report(spark, str(tmp_path), "priority_sla_performance", table.schema, file_format)
    assert _rows(again) == _rows(table)


def test_reports_have_known_names(frame, tmp_path):
    assert len(REPORTS) == 12
    with pytest.raises(ValueError, match="unknown report"):
        write_report(frame, str(tmp_path), "something_else")


def test_intermediate_tables_go_to_the_named_folder(spark, frame):
    settled = settle(frame.select("number"))
    assert shared_folder(spark) in settled.inputFiles()[0]
    assert settled.count() == 200


AWKWARD = [
    'say "hi", you',
    "two\nlines, and a third\n",
    " padded ",
    "back\\slash \\\" end\\",
    '"',
    ",,",
    "tab\tand\rreturn",
]


def test_awkward_text_survives_every_csv(spark, tmp_path):
    rows = [{"number": f"I{i}", "category": text} for i, text in enumerate(AWKWARD)]
    frame = incidents(spark, rows)
    source, table = str(tmp_path / "c"), str(tmp_path / "t")
    I.write_incidents(frame, source, "csv")
    assert I.load_incidents_table(spark, source, table, expected_rows=len(rows)) == len(rows)
    loaded = I.read_incidents(spark, table).select("number", "category")
    assert {tuple(r) for r in loaded.collect()} == {(r["number"], r["category"]) for r in rows}
    report = frame.select("number", "category")
    kept = write_report(report, str(tmp_path), "priority_sla_performance", "csv")
    assert _rows(kept) == _rows(report)


def test_log_written_by_another_program(spark, tmp_path):
    names = [*S.EVENT_COUNTERS, "number", "sys_updated_at", "u_symptom"]
    path = tmp_path / "log.csv"
    with open(path, "w", newline="") as file:
        writer = csv.writer(file)
        writer.writerow(names)
        writer.writerows([*["1"] * len(S.EVENT_COUNTERS), f"I{i}", "1/2/2016 10:00", text] for i, text in enumerate(AWKWARD))
    log = read_event_log(spark, str(path))
    assert {tuple(r) for r in log.select("number", "u_symptom").collect()} == {
        (f"I{i}", text) for i, text in enumerate(AWKWARD)
    }


@pytest.mark.parametrize("extra", [["too", "many"], []])
def test_rows_with_a_wrong_number_of_fields_fail(spark, tmp_path, extra):
    names = ["number", "sys_updated_at", *S.EVENT_COUNTERS]
    rows = [["I1", "1/2/2016 10:00", *["1"] * len(S.EVENT_COUNTERS)]]
    odd = [*rows[0], *extra] if extra else rows[0][:-1]
    path = _write_csv(tmp_path / "odd.csv", names, [*rows, odd])
    with pytest.raises(Exception, match="(?i)malformed"):
        read_event_log(spark, path).collect()


def test_files_of_a_log_may_order_their_columns_differently(spark, tmp_path):
    names = ["number", "sys_updated_at", *S.EVENT_COUNTERS, "category"]
    row = {"sys_updated_at": "1/2/2016 10:00", **dict.fromkeys(S.EVENT_COUNTERS, "1")}
    for i, columns in enumerate((names, names[::-1])):
        values = {**row, "number": f"I{i}", "category": f"c{i}"}
        _write_csv(tmp_path / f"{i}.csv", columns, [[values[c] for c in columns]])
    log = read_event_log(spark, str(tmp_path))
    assert {tuple(r) for r in log.select("number", "category", "sys_updated_at").collect()} == {
        ("I0", "c0", "1/2/2016 10:00"), ("I1", "c1", "1/2/2016 10:00")
    }
    _write_csv(tmp_path / "2.csv", [*names, "more"], [["x"] * (len(names) + 1)])
    with pytest.raises(ValueError, match="more"):
        read_event_log(spark, str(tmp_path))


@pytest.mark.parametrize(
    "rows, expected, message",
    [
        ([_row(number="A")], 2, "instead of 2"),
        ([_row(number="A"), _row(number="A")], None, "1 repeated and 0 missing"),
        ([_row(number="A"), _row(category="x")], None, "0 repeated and 1 missing"),
        ([_row(number="A", reopen_count="two")], None, "two"),
    ],
)
def test_a_failed_load_leaves_the_old_table(spark, frame, tmp_path, rows, expected, message):
    table = str(tmp_path / "t")
    I.write_incidents(frame, table)
    path = _write_csv(tmp_path / "new.csv", S.INCIDENT_COLUMNS, rows)
    with pytest.raises(Exception, match=message):
        I.load_incidents_table(spark, path, table, expected_rows=expected)
    assert _rows(I.read_incidents(spark, table)) == _rows(frame)
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["new.csv", "t"]


def test_key_rules_see_repeated_and_missing_numbers(spark, frame):
    faulty = frame.unionByName(frame.limit(3)).unionByName(
        frame.limit(2).withColumn("number", frame["number"].substr(99, 1)).replace("", None, ["number"])
    )
    found = {r["check_name"]: r["violations"] for r in v14_load(faulty, S.INCIDENT_COLUMNS).collect()}
    assert found["duplicate_numbers"] == 3 and found["missing_numbers"] == 2
