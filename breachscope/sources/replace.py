"""Tables that stay readable while they are replaced.

A table is a folder of versions and of markers. A version is complete before its
marker, an empty file named by number and version, is made; readers take the version
of the highest marker. Nothing is renamed, so it is the same on stores whose renames
copy. The version before the newest stays, for readers that opened it.

    table/_versions/<id>/...     table/_markers/<number>.<id>
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_VERSIONS = "_versions"
_MARKERS = "_markers"
KEPT_VERSIONS = 2


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def remove(spark: SparkSession, path: str) -> None:
    files, to_path = _file_system(spark, path)
    files.delete(to_path(path), True)


def _names(spark: SparkSession, folder: str) -> list[str]:
    files, to_path = _file_system(spark, folder)
    if not files.exists(to_path(folder)):
        return []
    return [status.getPath().getName() for status in files.listStatus(to_path(folder))]


def _markers(spark: SparkSession, path: str) -> list[str]:
    """Names of the markers, oldest first; other files are none."""
    return sorted(n for n in _names(spark, f"{path.rstrip('/')}/{_MARKERS}") if n.partition(".")[0].isdigit())


def _version(path: str, marker: str) -> str:
    return f"{path.rstrip('/')}/{_VERSIONS}/{marker.partition('.')[2]}"


def new_version(path: str) -> str:
    """A folder for a version that no reader sees yet."""
    return f"{path.rstrip('/')}/{_VERSIONS}/{uuid.uuid4().hex}"


def current(spark: SparkSession, path: str) -> str:
    """The folder that holds the newest version; ``path`` itself for a plain folder."""
    markers = _markers(spark, path)
    return _version(path, markers[-1]) if markers else path


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Make the complete version ``staged`` the one that readers take from now on.

    Of earlier versions the last one stays until the next call; older ones, and what
    a plain folder held before it had versions, go. Versions that were staged and never
    published belong to a load that runs or was killed and are left alone: see ``sweep``.
    """
    files, to_path = _file_system(spark, path)
    markers = _markers(spark, path)
    number = int(markers[-1].partition(".")[0]) + 1 if markers else 1
    marker = f"{number:012d}.{staged.rstrip('/').rpartition('/')[2]}"
    files.create(to_path(f"{path.rstrip('/')}/{_MARKERS}/{marker}"), False).close()
    if markers:
        for name in _names(spark, path):
            if name not in (_VERSIONS, _MARKERS):
                remove(spark, f"{path.rstrip('/')}/{name}")
    for old in [*markers, marker][:-KEPT_VERSIONS]:
        remove(spark, f"{path.rstrip('/')}/{_MARKERS}/{old}")
        remove(spark, _version(path, old))


def sweep(spark: SparkSession, path: str) -> None:
    """Remove versions without a marker. Call it only while no load runs."""
    marked = {m.partition(".")[2] for m in _markers(spark, path)}
    for name in _names(spark, f"{path.rstrip('/')}/{_VERSIONS}"):
        if name not in marked:
            remove(spark, f"{path.rstrip('/')}/{_VERSIONS}/{name}")
