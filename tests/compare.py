"""Run registered queries next to their SQL and compare whole results.

    python -m tests.compare SF_DIR [QUERY ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

from __spark_entry__ import oracle_sql, queries


def second_engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _sortable(row):
    return tuple((value is not None, str(value)) for value in row)


def _equal(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=0, abs_tol=1e-9)
    return type(a) is type(b) and a == b


def differences(spark, connection, name: str, sf_dir: str) -> list[str]:
    """What differs between the two engines; empty when nothing does."""
    df = queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = sorted((tuple(r) for r in df.select(*columns).collect()), key=_sortable)
    result = connection.execute(oracle_sql()[name])
    their_columns = [d[0] for d in result.description]
    if sorted(their_columns) != columns:
        return [f"columns {columns} / {sorted(their_columns)}"]
    order = [their_columns.index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=_sortable)
    if len(ours) != len(theirs):
        return [f"rows {len(ours)} / {len(theirs)}"]
    return [
        f"{a} / {b}"
        for a, b in zip(ours, theirs)
        if not all(_equal(x, y) for x, y in zip(a, b))
    ]


def main(sf_dir: str, names: list[str]) -> int:
    from breachscope.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = second_engine(sf_dir)
    failed = 0
    for name in names or queries():
        start = time.time()
        try:
            found = differences(spark, connection, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:500]}"]
        failed += bool(found)
        verdict = "same" if not found else f"DIFFERENT ({len(found)}) {found[:2]}"
        print(f"{name:32s} {time.time() - start:6.2f}s {verdict}", flush=True)
    print(f"{failed} queries differ")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
