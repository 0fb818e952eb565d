"""Compare every registered query with its SQL: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime as dt
import glob
import os
import sys
import tempfile
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import oracle_sql
from checks.queries import REGISTERED


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _value(value: object) -> object:
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _rows(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both give the same columns and the same rows."""
    result = connection.execute(sql)
    names = [c[0] for c in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}"
    expected = _rows(names, result.fetchall())
    actual = _rows(df.columns, [tuple(row) for row in df.collect()])
    if expected == actual:
        return ""
    missing, extra = expected - actual, actual - expected
    return (
        f"{expected.total()} expected, {actual.total()} found; "
        f"missing {list(missing)[:2]}, extra {list(extra)[:2]}"
    )


def local_session(cpus: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("shelfcast")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="shelfcast-"))
        .getOrCreate()
    )


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(REGISTERED)
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql = duck(sf_dir), oracle_sql()
    failed = 0
    for name in chosen:
        start = time.time()
        try:
            df = REGISTERED[name](spark, sf_dir)
            n = df.count()
            problem = differences(df, connection, sql[name])
        except Exception as error:
            n, problem = -1, f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        status = "FAIL" if problem else "ok  "
        print(f"{status} {name} rows={n} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} match")
    return failed


if __name__ == "__main__":
    sys.exit(main())
