"""Replacing tables without a table format.

Overwriting a path that the same job reads destroys it, so a replaced table goes to a new run
path. Readers follow a catalog table that is pointed at it once the write has succeeded, or a path
that the caller passes on.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelfcast.session import scratch_path


def publish_table(df: DataFrame, base: str, run_id: str) -> str:
    """Write one run's version of a table and return its path. A retry takes a new run id."""
    path = f"{base.rstrip('/')}/{run_id}"
    df.write.mode("errorifexists").parquet(path)
    return path


def stage_table(df: DataFrame, base: str, run_id: str) -> DataFrame:
    """Publish a table that later steps of a run read more than once, and return it as stored.

    The stored table also ends the lineage: a lost executor costs the step it was working on.
    """
    return df.sparkSession.read.schema(df.schema).parquet(publish_table(df, base, run_id))


def point_table(spark: SparkSession, name: str, path: str, schema: StructType) -> None:
    """Let the catalog table ``name`` show the rows at path, from one moment to the next.

    The first call creates the table over the path. Later ones change its location, which the
    catalog does at once, so a query sees the rows of one run whole. Its older runs stay where they
    are for queries that are still reading them.
    """
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}'")
        return
    stored = spark.table(name).schema
    if [(f.name, f.dataType) for f in stored] != [(f.name, f.dataType) for f in schema]:
        raise ValueError(f"{name} has other columns than the run at {path}")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)


def publish_pointed(df: DataFrame, name: str, base: str, run_id: str) -> DataFrame:
    """Publish a run and point the catalog table at it once all its rows are written.

    A run that fails leaves the table with the run before.
    """
    path = publish_table(df, base, run_id)
    point_table(df.sparkSession, name, path, df.schema)
    return df.sparkSession.table(name)


def append_history(df: DataFrame, base: str, run_id: str) -> str:
    """Add one run's rows to a history table partitioned by run id.

    The run's own folder is overwritten, so a rerun replaces its earlier rows even when it now
    delivers none.
    """
    df.write.mode("overwrite").parquet(f"{base.rstrip('/')}/run_id={run_id}")
    return base


def read_history(spark: SparkSession, base: str, schema: StructType) -> DataFrame:
    with_run = StructType([*schema.fields, StructField("run_id", StringType())])
    return spark.read.schema(with_run).parquet(base)


def refresh_dates(
    rollup: DataFrame, path: str, date_column: str, first: dt.date, last: dt.date
) -> None:
    """Replace the dates from first to last of a table partitioned by date; leave the others.

    The new rows are stored first, so they are computed once. Dynamic overwrite touches only dates
    that have rows; a date in the window that lost all its rows is emptied on its own before, and
    there are at most as many of those as days in the window. A rerun after a failure ends the same.
    """
    spark = rollup.sparkSession
    window = F.col(date_column).between(F.lit(first), F.lit(last))
    fresh = stage_table(rollup.filter(window), scratch_path(spark, "refresh"), "rows")
    stored = spark.read.schema(rollup.schema).parquet(path).filter(window)
    vanished = (
        stored.select(date_column)
        .distinct()
        .join(fresh.select(date_column).distinct(), date_column, "left_anti")
        .collect()
    )
    empty = rollup.drop(date_column).limit(0)
    for row in vanished:
        empty.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{date_column}={row[0]}")
    write_by_date(fresh, path, date_column, dynamic=True)


def write_by_date(df: DataFrame, path: str, date_column: str, dynamic: bool = False) -> None:
    """Partition by date. The rebalance hint lets AQE split a date too large for one task."""
    (
        df.hint("rebalance", date_column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy(date_column)
        .parquet(path)
    )
