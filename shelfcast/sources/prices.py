"""Price files: semicolon CSV whose first column is the key, stamped with the run time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.params import SNAPSHOT_OFFSET_HOURS


def price_file_name(run_date: dt.date, prefix: str) -> str:
    """Name of the file delivered for the day before the run."""
    return f"{prefix}_{run_date - dt.timedelta(days=1):%Y%m%d}01.csv"


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, so prices are written back exactly as they were delivered."""
    return (
        spark.read.option("header", True)
        .option("sep", ";")
        .option("escape", '"')
        .option("multiLine", True)
        .csv(path)
    )


def stamp_prices(
    prices: DataFrame, run_ts: dt.datetime, offset_hours: int = SNAPSHOT_OFFSET_HOURS
) -> DataFrame:
    stamp = (run_ts - dt.timedelta(hours=offset_hours)).strftime("%Y-%m-%dT%H:%M:%S")
    return prices.withColumn("snapshot_date", F.lit(stamp))


def stamped_price_file(
    spark: SparkSession, source: str, target: str, run_ts: dt.datetime
) -> str:
    """Read one delivery, stamp it and write it under a new path."""
    (
        stamp_prices(read_prices(spark, source), run_ts)
        .write.option("header", True)
        .option("sep", ";")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .mode("errorifexists")
        .csv(target)
    )
    return target
