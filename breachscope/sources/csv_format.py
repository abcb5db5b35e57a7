"""The one CSV dialect of all readers and writers, and the headers of many files.

Fields may hold separators, line breaks, backslashes and blanks at either end; a quote
inside a quoted field is doubled. A row with too many or too few fields fails the read.
"""

from __future__ import annotations

import csv
import io
import re
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

HEAD_BYTES = 1 << 16
_OPEN_FILES = 16  # at a time

WRITE_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
}

# For files that are read back by this library; fields like "?" make most of a log.
STORED_OPTIONS = {**WRITE_OPTIONS, "compression": "gzip"}


def read_options(multiline: bool = True) -> dict[str, object]:
    """Reader options. ``multiline=False`` lets Spark split files, which is right only for
    files without a line break inside a field; a record that such a break cuts short
    fails the read."""
    return {
        "header": True,
        "escape": '"',
        "multiLine": multiline,
        "enforceSchema": False,
        "mode": "FAILFAST",
    }


def list_files(spark: SparkSession, path: str) -> list[str]:
    """The files a reader of ``path`` would open, in the order of their names, written
    as in the metadata of rows but not encoded."""
    files = spark.read.text(path).inputFiles()
    return sorted(re.sub(r"^([\w+.-]+):///", r"\1:/", unquote(file)) for file in files)


def _record_end(data: bytes) -> tuple[int, int] | None:
    """Where the first record that is not blank starts and ends, if it ends in ``data``."""
    start, quoted = 0, False
    for found in re.finditer(rb'["\r\n]', data):
        if found[0] == b'"':
            quoted = not quoted
        elif not quoted:
            if data[start : found.start()].strip():
                return start, found.start()
            start = found.end()
    return None


def read_header(spark: SparkSession, file: str) -> tuple[str, ...] | None:
    """Column names of one file, from its first kilobytes; None if it holds nothing."""
    jvm, settings = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(settings).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(settings).getCodec(path)
        if codec is not None:
            stream = codec.createInputStream(stream)
        data, ended = b"", False
        while not ended and _record_end(data) is None:
            more = bytes(stream.readNBytes(HEAD_BYTES))
            data, ended = data + more, len(more) < HEAD_BYTES
    finally:
        stream.close()
    start, end = _record_end(data + b"\n" if ended else data) or (0, len(data))
    text = data[start:end].decode("utf-8").removeprefix("\ufeff")
    return tuple(next(csv.reader(io.StringIO(text, newline="")))) if text.strip() else None


def file_headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files under ``path`` by their column names, as they stand in the files.

    Only the first block of each file is opened, through the file system that Spark
    reads it with; the driver lists the files anyway. No job runs.
    """
    files = list_files(spark, path)
    with ThreadPoolExecutor(max_workers=_OPEN_FILES) as pool:
        headers = pool.map(lambda file: read_header(spark, file), files)
        found: dict[tuple[str, ...], list[str]] = {}
        for file, names in zip(files, headers, strict=True):
            if names is not None:
                found.setdefault(names, []).append(file)
    if not found:
        raise ValueError(f"no CSV header found under {path}")
    return found


def single_header(spark: SparkSession, path: str) -> list[str]:
    """The column names that all files under ``path`` have in common, order included."""
    headers = file_headers(spark, path)
    if len(headers) > 1:
        shown = "; ".join(", ".join(h) for h in headers)
        raise ValueError(f"the files under {path} differ in their headers: {shown}")
    return list(next(iter(headers)))


def read_text_columns(
    spark: SparkSession, files: str | list[str], names: list[str], multiline: bool = True
) -> DataFrame:
    """All columns as text; the names must stand in the header of each file."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).options(**read_options(multiline)).csv(files)
