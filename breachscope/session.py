"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_folder: str | None = None


# The JVM does not compile methods beyond 8000 bytes. Told so, Spark runs an over-
# sized stage (the cleaning of a 36-column log is one) in smaller generated pieces
# instead of one interpreted method; that halves the time of the collapse.
CODE_SIZE_SETTING = ("spark.sql.codegen.hugeMethodLimit", "8000")


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("breachscope")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config(*CODE_SIZE_SETTING)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder is made up only where the setting is missing and the
    session runs on this machine alone.
    """
    global _local_folder
    configured = spark.sparkContext.getConf().get(_CHECKPOINT_DIR)
    configured = configured or spark.conf.get(_CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder shared by the cluster")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="breachscope-")
    return _local_folder


def work_path(spark: SparkSession) -> str:
    """A new path for an intermediate table. All of an application lie in one
    folder, which can be removed once the application has ended."""
    folder = f"{shared_folder(spark)}/breachscope/{spark.sparkContext.applicationId}"
    return f"{folder}/{uuid.uuid4().hex}"


# Paths of the intermediate tables that exist, by application and scope.
_held: dict[tuple[str, str], set[str]] = {}
_scope: ContextVar[str] = ContextVar("scope", default="")


def _tables(spark: SparkSession, scope: str) -> set[str]:
    return _held.setdefault((spark.sparkContext.applicationId, scope), set())


def _remove(spark: SparkSession, paths: set[str]) -> None:
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    for path in paths:
        folder = to_path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    for (application, _), held in _held.items():
        if application == spark.sparkContext.applicationId:
            held -= paths


def _read_by(df: DataFrame) -> set[str]:
    """The intermediate tables among the files that ``df`` reads."""
    application = df.sparkSession.sparkContext.applicationId
    names = {path.rpartition("/")[2]: path for (a, _), held in _held.items() if a == application for path in held}
    return {names[part] for file in df.inputFiles() for part in file.split("/") if part in names}


def release(*tables: DataFrame) -> None:
    """Remove settled tables that no unread frame needs any more."""
    for df in tables:
        _remove(df.sparkSession, _read_by(df))


@contextmanager
def work(spark: SparkSession, scope: str, *needed: DataFrame) -> Iterator[None]:
    """Tables settled inside belong to ``scope``. What the scope held before is removed
    first, but for the tables that ``needed`` read.

    For steps that follow one another, each on the stored result of the one before: when
    a step begins, nothing that the last one settled is read any more."""
    _remove(spark, _tables(spark, scope) - set().union(*[_read_by(df) for df in needed]))
    outer = _scope.set(scope)
    try:
        yield
    finally:
        _scope.reset(outer)


def clear_work(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application.

    Frames that still read one fail from then on: call it once results are stored."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(
        f"{shared_folder(spark)}/breachscope/{spark.sparkContext.applicationId}"
    )
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def settle(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of what was written.

    Used where a frame is read more than once: the later readers prune columns
    on the Parquet files instead of repeating the shuffle behind ``df``, and a
    lost executor costs a re-read, not a recomputation. The table stays until it is
    released or the work is cleared. ``compression`` is for tables of text, which take
    much of the folder.
    """
    spark = df.sparkSession
    path = work_path(spark)
    _tables(spark, _scope.get()).add(path)
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
