"""The incident table: write, load from CSV, read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from breachscope import schema as S
from breachscope.functions import expressions as E
from breachscope.sources.csv_format import WRITE_OPTIONS, read_text_columns, single_header
from breachscope.sources.replace import current, new_version, publish, remove

# Columns the service-level reports cannot do without.
REPORT_COLUMNS = [
    "number",
    "category",
    "priority",
    "assignment_group",
    "made_sla",
    "sla_breached",
    "resolution_time_hours",
    "reassignment_count",
    "reassignment_bucket",
    "resolved_at",
]


def _write_new(
    incidents: DataFrame, path: str, file_format: str, partition_by: Sequence[str]
) -> int:
    """Write to a new folder and return how many rows were written.

    The count is observed during the write. With ``partition_by`` the rows are
    rebalanced first: files get an even size, and a partition value that holds
    much of the table is split over several tasks.
    """
    observed = Observation("written")
    counted = incidents.observe(observed, F.count(F.lit(1)).alias("rows"))
    writer = counted
    if partition_by:
        writer = counted.hint("rebalance", *partition_by)
    output = writer.write.mode("errorifexists")
    if partition_by:
        output = output.partitionBy(*partition_by)
    if file_format == "csv":
        output.options(**WRITE_OPTIONS).csv(path)
    else:
        output.format(file_format).save(path)
    return observed.get["rows"]


def write_incidents(
    incidents: DataFrame,
    path: str,
    file_format: str = "parquet",
    partition_by: Sequence[str] = (),
) -> int:
    """Write the incidents and return how many rows were written.

    A table that is there already is replaced only once the new one is complete, and
    readers that have opened it finish.
    """
    spark = incidents.sparkSession
    staged = new_version(path)
    try:
        rows = _write_new(incidents, staged, file_format, partition_by)
    except Exception:
        remove(spark, staged)
        raise
    publish(spark, staged, path)
    return rows


def read_incidents(spark: SparkSession, path: str, ordered: bool = False) -> DataFrame:
    """The newest version of the stored table. Sorting is for presentation and costs a
    global sort."""
    table = spark.read.schema(S.INCIDENT_SCHEMA).parquet(current(spark, path)).select(*S.INCIDENT_COLUMNS)
    return table.orderBy("number") if ordered else table


def check_header(spark: SparkSession, path: str) -> list[str]:
    """Fail unless the CSV at ``path`` has exactly the fixed columns in order."""
    names = single_header(spark, current(spark, path))
    if names != S.INCIDENT_COLUMNS:
        raise ValueError(
            f"not an incident table: the header of {path} is {names}, but must be {S.INCIDENT_COLUMNS}"
        )
    return names


def _typed(text: Column, field: S.T.StructField) -> Column:
    """Text to the type of ``field``; a value that does not fit fails the job."""
    kind = field.dataType.typeName()
    if kind == "string":
        return text
    if kind in ("timestamp_ntz", "date"):
        moment = E.day_first_time(text)
        message = F.concat(F.lit(f"cannot read '{field.name}': "), text)
        checked = F.when(text.isNotNull() & moment.isNull(), F.raise_error(message)).otherwise(
            moment
        )
        return checked.cast(field.dataType)
    return text.cast(field.dataType)


def read_incidents_csv(
    spark: SparkSession,
    path: str,
    required: Sequence[str] = tuple(REPORT_COLUMNS),
    multiline: bool = True,
) -> DataFrame:
    """A cleaned CSV with its types. Empty fields are null; dates may be ISO or
    day-first. Columns outside the fixed list stay text."""
    files = current(spark, path)
    names = single_header(spark, files)
    missing = [name for name in required if name not in names]
    if missing:
        raise ValueError(f"{path} lacks columns: " + ", ".join(missing))
    raw = read_text_columns(spark, files, names, multiline)
    fields = {field.name: field for field in S.INCIDENT_SCHEMA}
    columns = []
    for name in names:
        value = F.nullif(F.col(name), F.lit(""))
        field = fields.get(name)
        columns.append((_typed(value, field) if field else value).alias(name))
    return raw.select(*columns)


def key_faults(table: DataFrame) -> tuple[int, int]:
    """Rows beyond the first of each number, and rows without a number."""
    per_number = table.groupBy("number").agg(F.count("*").alias("n"))
    row = per_number.agg(
        F.sum(F.when(F.col("number").isNotNull(), F.col("n") - 1)).alias("repeated"),
        F.sum(F.when(F.col("number").isNull(), F.col("n"))).alias("missing"),
    ).first()
    return row["repeated"] or 0, row["missing"] or 0


def load_incidents_table(
    spark: SparkSession,
    csv_path: str,
    table_path: str,
    expected_rows: int | None = None,
    partition_by: Sequence[str] = (),
    multiline: bool = True,
) -> int:
    """Replace the stored table by the content of a cleaned CSV, as a whole or not at all.

    The new version is written beside the old one and published only when the
    header is right, every value fits its column, every row has a number of its own
    and, where given, the number of rows is ``expected_rows``.
    """
    names = check_header(spark, csv_path)
    staged = new_version(table_path)
    try:
        rows = _write_new(
            read_incidents_csv(spark, csv_path, names, multiline), staged, "parquet", partition_by
        )
        if expected_rows is not None and rows != expected_rows:
            raise ValueError(f"{csv_path} holds {rows:,} incidents instead of {expected_rows:,}")
        repeated, missing = key_faults(spark.read.schema(S.INCIDENT_SCHEMA).parquet(staged))
        if repeated or missing:
            raise ValueError(
                f"{csv_path} is no table of incidents: {repeated:,} repeated and {missing:,} missing numbers"
            )
    except Exception:
        remove(spark, staged)
        raise
    publish(spark, staged, table_path)
    return rows
