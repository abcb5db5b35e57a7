"""The whole analysis: event log -> incidents -> reports, each checked.

    spark-submit breachscope/plans/full_run.py EVENTS_CSV OUTPUT_FOLDER

Every stage is stored before the next one reads it. The log is shuffled once;
the reports read pruned columns of the stored incidents, and a lost executor
costs the tasks it was running.
"""

from __future__ import annotations

import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breachscope import schema as S
from breachscope.operators import bottlenecks as B
from breachscope.operators import checks as C
from breachscope.operators import risk as R
from breachscope.operators import segments as G
from breachscope.operators.cleaning import clean_incidents
from breachscope.session import CODE_SIZE_SETTING, clear_work
from breachscope.sources.events import read_event_log
from breachscope.sources.incidents import read_incidents, write_incidents
from breachscope.sources.reports import write_report


def run_all(
    events: DataFrame,
    out: str,
    min_sample: int = S.MIN_SEGMENT_SAMPLE,
    baseline: float = S.RISK_BASELINE_RATE,
    expected_rows: int | None = None,
    report_format: str = "parquet",
    partition_by: tuple[str, ...] = (),
    strict: bool = True,
) -> dict[str, DataFrame]:
    """Build, check and store everything; returns the stored frames by name.

    The checks are stored as ``checks``. ``strict`` fails on the first report
    with a violated rule, before the reports that build on it.
    """
    spark = events.sparkSession
    stored: dict[str, DataFrame] = {}
    verdicts: list[DataFrame] = []

    def verify(name: str, rows: DataFrame) -> None:
        path = f"{out}/checks/{name}"
        labelled = rows.select(F.lit(name).alias("report"), "*")
        labelled.coalesce(1).write.mode("overwrite").parquet(path)
        kept = spark.read.schema(labelled.schema).parquet(path)
        verdicts.append(kept)
        if strict:
            C.raise_on_violations(kept)

    def keep(name: str, df: DataFrame) -> DataFrame:
        stored[name] = write_report(df, out, name, report_format)
        return stored[name]

    write_incidents(clean_incidents(events), f"{out}/incidents", partition_by=partition_by)
    incidents = read_incidents(spark, f"{out}/incidents")
    stored["incidents"] = incidents
    verify("incidents", C.v01_incidents(incidents, expected_rows))

    cells = G.SegmentCells(incidents)  # the collapse leaves one row per incident
    monthly = keep("monthly_operational_performance", G.sla_monthly(cells, min_sample))
    verify("monthly", C.v05_monthly(monthly, incidents, min_sample))
    category = keep("category_sla_performance", G.sla_category(cells, min_sample))
    verify("category", C.v09_category(category, incidents, min_sample))
    priority = keep("priority_sla_performance", G.sla_priority(cells))
    verify("priority", C.v10_priority(priority, incidents))
    buckets = keep("reassignment_sla_performance", G.sla_reassignment(cells))
    verify("reassignment", C.v11_reassignment(buckets, incidents))
    resolution = keep("reassignment_resolution_performance", G.reassignment_resolution(cells))
    verify("resolution", C.v12_reassignment_resolution(resolution, incidents))
    groups = keep("assignment_group_performance", G.sla_assignment_group(cells, min_sample))
    verify("assignment_group", C.v13_assignment_group(groups, incidents, min_sample))

    classified = keep("assignment_group_bottleneck_analysis", B.bottlenecks(groups, strict))
    verify("bottlenecks", C.v07_bottlenecks(classified, groups))
    driver_table = keep("assignment_group_driver_analysis", B.drivers(groups, classified, strict))
    verify("drivers", C.v06_drivers(driver_table, groups, classified))

    reference = keep(
        "incident_sla_risk_reference", R.risk_reference(category, priority, buckets, groups)
    )
    verify(
        "risk_reference", C.v08_risk_reference(reference, category, priority, buckets, groups)
    )
    scores = keep("incident_sla_risk_scores", R.risk_scores(incidents, reference, baseline))
    verify("risk_scores", C.v02_risk_scores(scores, incidents, reference))
    portfolio = keep("sla_risk_portfolio_summary", R.risk_portfolio(scores, strict=strict))
    verify("portfolio", C.v03_portfolio(portfolio, scores))
    concentration = keep(
        "sla_risk_concentration_analysis",
        R.risk_concentration(scores, min_sample=min_sample, strict=strict),
    )
    verify("concentration", C.v04_concentration(concentration, scores, min_sample))

    stored["checks"] = reduce(DataFrame.unionByName, verdicts)
    return stored


# Bytes of the log for each shuffle partition. Adaptive execution merges small
# partitions but never splits one for an aggregate, so there must be enough at the start.
PARTITION_BYTES = 192 << 20


def shuffle_partitions(spark: SparkSession, path: str, partition_bytes: int = PARTITION_BYTES) -> int:
    """Shuffle partitions for the files under ``path``: one for so many bytes, and no
    fewer than the session has."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    size = files.getContentSummary(target).getLength()
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // partition_bytes))


def main(argv: list[str]) -> None:
    events_csv, out, *partitions = argv
    spark = SparkSession.builder.appName("breachscope").config(*CODE_SIZE_SETTING).getOrCreate()
    count = int(partitions[0]) if partitions else shuffle_partitions(spark, events_csv)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(count))
    try:
        run_all(read_event_log(spark, events_csv), out, partition_by=("opened_year",))
    finally:
        clear_work(spark)  # everything worth keeping is under ``out``


if __name__ == "__main__":
    main(sys.argv[1:])
