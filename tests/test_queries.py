"""Registered queries against their SQL in a second engine.

A few of each kind run by default; ``ALL_QUERIES=1`` runs every one.
"""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from breachscope.plans import faults
from breachscope.plans.oracle import texts
from breachscope.plans.queries import registry
from tests.compare import differences, second_engine

SOME = [
    "clean_incidents",
    "load_incidents_table",
    "several_log_files",
    "load_free_text",
    "report_free_text",
    "guards",
    "v01_faults",
    "v02_faults",
    "v07_faults",
    "order_drivers",
    "v14_faults",
    "q04_resolution_distribution",
    "q09_breach_concentration",
    "kpi_category",
    "sla_assignment_group",
    "bottlenecks",
    "risk_scores",
    "risk_concentration",
    "v04_concentration",
]


@pytest.fixture(scope="module")
def connection(sf_dir):
    return second_engine(sf_dir)


def test_every_query_has_its_sql():
    assert set(registry()) == set(texts())
    assert set(registry()) <= set(queries()) and set(texts()) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", texts() if os.environ.get("ALL_QUERIES") else SOME)
def test_same_result_as_sql(spark, connection, sf_dir, name):
    assert differences(spark, connection, name, sf_dir) == []


def test_flagship(spark):
    rows = entry(spark).collect()
    assert [r["priority_level"] for r in rows] == ["Critical", "High", "Moderate", "Low", "Unknown"]
    assert sum(r["incident_count"] for r in rows) == 1473


def test_faults_reach_every_rule():
    """But for the one that wants a frame without rows and the one that compares a count
    with itself."""
    second = second_engine("/root/testdata/sf0.01")
    silent = set()
    for check in faults.FAULTS:
        rows = second.execute(texts()[faults.query_name(check)]).fetchall()
        silent |= {(check, name) for name, _, violations in rows if not violations}
    assert silent == {("v05_monthly", "not_empty"), ("v13_assignment_group", "missing_group_count")}
