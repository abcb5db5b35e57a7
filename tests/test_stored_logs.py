"""Logs that queries store as CSV: their size, and that the rows are whole."""

import datetime as dt
import random
from pathlib import Path

import pytest

from breachscope.plans import queries
from breachscope.schema import RAW_COLUMNS

ORDERS, DOCUMENTS = 60, 4


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Orders of one to three lines at one time, and documents of random words, one null."""
    folder = tmp_path_factory.mktemp("tables")
    word = random.Random(3).choices("abcdefghijklmnopqrstuvwxyz ,\"\n", k=8000)
    texts = ["".join(word[i * 2000 : (i + 1) * 2000]) for i in range(DOCUMENTS - 1)] + [None]
    day = dt.datetime(2024, 5, 6)
    orders = [(i, i % 7, day, "2-HIGH") for i in range(ORDERS)]
    lines = [
        (i, 10 + n, 20 + n, n, 0.0, 100.0, 0.05, 0.01, "RAN"[n - 1], "F")
        for i in range(ORDERS)
        for n in range(1, 2 + i % 3)
    ]
    frames = {
        "documents": (list(enumerate(texts)), "doc_id long, text string"),
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": (
            lines,
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
            "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string",
        ),
    }
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder), texts, len(lines)


@pytest.fixture
def stored(monkeypatch, tmp_path):
    monkeypatch.setattr(queries, "work_path", lambda spark: f"{tmp_path}/log")
    return lambda: [file for file in Path(tmp_path, "log").iterdir() if file.name.startswith("part-")]


def test_a_log_with_free_text_takes_less_than_its_texts(spark, tables, stored):
    folder, texts, _ = tables
    rows = queries.registry()["several_log_files"](spark, folder).collect()
    # Lines of one order have one time: the one that comes last stands for it.
    assert len(rows) == ORDERS
    for r in rows:
        order = int(r["number"][3:])
        only = order % 3 == 0
        assert r["u_symptom"] == (texts[order % DOCUMENTS] if only else None)
        assert r["reassignment_count"] == 0
    written = sum(len(texts[i % DOCUMENTS] or "") for i in range(ORDERS))
    assert sum(file.stat().st_size for file in stored()) < written / 3


def test_guards_packs_the_log_it_stores_twice(spark, tables, stored):
    folder, _, events = tables
    rows = queries.registry()["guards"](spark, folder).collect()
    assert {r["case_name"] for r in rows if not r["error_raised"]} == {"sound input"}
    assert {r["incidents"] for r in rows} == {ORDERS}
    files = stored()
    logs = [spark.read.option("header", True).csv(str(file)) for file in files]
    assert {tuple(log.columns) for log in logs} == {tuple(RAW_COLUMNS), tuple(RAW_COLUMNS[::-1])}
    assert sum(log.count() for log in logs) == 2 * events
    plain = sum(len(",".join(str(v) for v in row)) for log in logs for row in log.collect())
    assert sum(file.stat().st_size for file in files) < plain / 2
