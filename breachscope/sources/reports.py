"""Report tables: one folder per report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from breachscope.sources.csv_format import WRITE_OPTIONS, read_options

# Names of the published reports.
REPORTS = [
    "monthly_operational_performance",
    "category_sla_performance",
    "priority_sla_performance",
    "reassignment_sla_performance",
    "reassignment_resolution_performance",
    "assignment_group_performance",
    "assignment_group_bottleneck_analysis",
    "assignment_group_driver_analysis",
    "incident_sla_risk_reference",
    "incident_sla_risk_scores",
    "sla_risk_portfolio_summary",
    "sla_risk_concentration_analysis",
]


def _check_name(name: str) -> None:
    if name not in REPORTS:
        raise ValueError(f"unknown report: {name}")


def write_report(df: DataFrame, folder: str, name: str, file_format: str = "parquet") -> DataFrame:
    """Store a report and return a scan of what was stored."""
    _check_name(name)
    writer = df.write.mode("overwrite")
    path = f"{folder}/{name}"
    if file_format == "csv":
        writer.options(**WRITE_OPTIONS).csv(path)
    else:
        writer.format(file_format).save(path)
    return read_report(df.sparkSession, folder, name, df.schema, file_format)


def read_report(
    spark: SparkSession,
    folder: str,
    name: str,
    schema: T.StructType,
    file_format: str = "parquet",
) -> DataFrame:
    _check_name(name)
    reader = spark.read.schema(schema)
    if file_format == "csv":
        reader = reader.options(**read_options())
    return reader.format(file_format).load(f"{folder}/{name}")
