"""The raw event log as CSV exports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breachscope import schema as S
from breachscope.operators.cleaning import ROW_ORDER, null_tokens
from breachscope.sources.csv_format import file_headers, read_text_columns


# Above this number of files their paths stay in the order key.
NUMBERED_FILES = 100_000


def _numbered(events: DataFrame, files: list[str]) -> DataFrame:
    """The path in the order key as the number of the file, in the order of the names.

    The key travels with every event, twice in the collapse: a whole number of four
    bytes does instead of a path.
    """
    spark, key = events.sparkSession, F.col(ROW_ORDER)
    if len(files) > NUMBERED_FILES:
        return events
    if len(files) == 1:
        return events.withColumn(ROW_ORDER, key.withField("file", F.lit(0)))
    # Paths in metadata are percent-encoded, those of the listing are not.
    kind = T.StructType([T.StructField("_path", T.StringType()), T.StructField("_number", T.IntegerType())])
    numbers = spark.createDataFrame(list(zip(files, range(len(files)), strict=True)), kind)
    joined = events.join(F.broadcast(numbers), F.url_decode(F.replace(key["file"], F.lit("+"), F.lit("%2B"))) == F.col("_path"), "left")
    unlisted = F.raise_error(F.concat(F.lit("not among the listed files: "), key["file"]))
    number = F.coalesce("_number", unlisted.cast("int"))
    return joined.select(*[c for c in events.columns if c != ROW_ORDER], key.withField("file", number).alias(ROW_ORDER))


def read_event_log(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """All columns as text, "no value" tokens as null, plus the order of the rows.

    Columns are taken by name from the header of each file: files of one log may order
    them differently, but all must have the same ones. The order key is the place of a
    row: the number of its file by name, the split it came from and its position there.
    ``multiline`` is explained in ``csv_format``.
    """
    headers = file_headers(spark, path)
    parts = []
    wanted = list(next(iter(headers)))
    for names, files in headers.items():
        missing = {"number", "sys_updated_at", *S.EVENT_COUNTERS} - set(names)
        if missing:
            raise ValueError("event log lacks columns: " + ", ".join(sorted(missing)))
        if set(names) != set(wanted) or len(names) != len(wanted):
            odd = sorted(set(names) ^ set(wanted)) or ["a repeated name"]
            raise ValueError(f"files of the log differ in columns ({', '.join(odd)}): {files[0]}")
        source = path if len(headers) == 1 else files
        raw = read_text_columns(spark, source, list(names), multiline)
        parts.append(
            raw.select(
                *wanted,
                F.struct(
                    F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"),
                ).alias(ROW_ORDER),
            )
        )
    listed = sorted(file for files in headers.values() for file in files)
    return null_tokens(_numbered(reduce(DataFrame.unionByName, parts), listed))
