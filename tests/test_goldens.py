"""Published report tables, read as data from the folder ``PUBLISHED_REPORTS`` names."""

import os

import pytest
from pyspark.sql import functions as F

from breachscope.functions import expressions as E
from breachscope.operators import bottlenecks as B
from breachscope.operators import checks as C
from breachscope.operators import risk as R

FOLDER = os.environ.get("PUBLISHED_REPORTS", "")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no published reports named")

_TEXTS = {
    "priority", "category", "reassignment_bucket", "assignment_group", "factor_type",
    "factor_value", "volume_class", "breach_risk_class", "bottleneck_class", "driver_segment",
    "sla_risk_band", "dimension", "dimension_value", "opened_month",
}
_COUNTS = {
    "incident_count", "sla_breaches", "resolved_incidents", "missing_resolution",
    "reassigned_incidents", "elevated_risk_incident_count", "critical_risk_incident_count",
}
_FLAGS = {"eligible_for_comparison", "comparison_eligible"}


def _published(spark, name):
    path = f"{FOLDER}/{name}.csv"
    with open(path) as file:
        names = file.readline().strip().split(",")
    kind = lambda n: "string" if n in _TEXTS else "bigint" if n in _COUNTS else "boolean" if n in _FLAGS else "double"
    schema = ", ".join(f"{n} {kind(n)}" for n in names)
    return spark.read.schema(schema).option("header", True).csv(path)


@pytest.fixture(scope="module")
def tables(spark):
    names = {
        "category": "category_sla_performance",
        "priority": "priority_sla_performance",
        "reassignment": "reassignment_sla_performance",
        "group": "assignment_group_performance",
    }
    return {key: _published(spark, name).cache() for key, name in names.items()}


def _same(a, b):
    b = b.select(*a.columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_intervals(tables):
    lower, upper = E.wilson_bounds(F.col("sla_breaches"), F.col("incident_count"))
    seen = 0
    for table in tables.values():
        gaps = table.select(
            F.abs(lower * 100 - F.col("breach_rate_ci_lower")).alias("l"),
            F.abs(upper * 100 - F.col("breach_rate_ci_upper")).alias("u"),
        ).collect()
        seen += len(gaps)
        assert max(max(g["l"], g["u"]) for g in gaps) < 1e-12
    assert seen == 130


def test_risk_reference(spark, tables):
    _same(_published(spark, "incident_sla_risk_reference"), R.risk_reference(**tables))


def test_bottlenecks_and_drivers(spark, tables):
    classified = B.bottlenecks(tables["group"], strict=True)
    _same(_published(spark, "assignment_group_bottleneck_analysis"), classified)
    driver_table = B.drivers(tables["group"], classified, strict=True)
    _same(_published(spark, "assignment_group_driver_analysis"), driver_table)
    assert [r["groups"] for r in B.class_counts(classified).collect()] == [7, 10, 10, 6]
    assert [r["groups"] for r in B.driver_segment_counts(driver_table).collect()] == [7, 26]
    assert B.driver_comparison(driver_table).count() == 5


def test_published_tables_pass_the_rules(spark, tables):
    reference = _published(spark, "incident_sla_risk_reference")
    C.raise_on_violations(C.v08_risk_reference(reference, **tables))
    classified = _published(spark, "assignment_group_bottleneck_analysis")
    C.raise_on_violations(C.v07_bottlenecks(classified, tables["group"]))
    driver_table = _published(spark, "assignment_group_driver_analysis")
    C.raise_on_violations(C.v06_drivers(driver_table, tables["group"], classified))


def test_published_totals(spark, tables):
    def total(df, *columns):
        return tuple(df.agg(*[F.sum(c) for c in columns]).first())

    assert total(tables["priority"], "incident_count", "sla_breaches") == (24918, 9115)
    assert total(tables["category"], "incident_count", "sla_breaches") == (24911, 9112)
    assert total(tables["group"], "incident_count", "sla_breaches") == (22761, 8007)
    bands = _published(spark, "sla_risk_portfolio_summary").collect()
    assert [b["incident_count"] for b in bands] == [22875, 1946, 96, 1]
