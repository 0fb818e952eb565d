"""Delimited feed files and the manifest that counts their rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Format of the delivered files.
STAMP_FORMAT = "%Y%m%d%H%M%S"
FEED_OPTIONS = {
    "sep": "|",
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "multiLine": True,
}
MANIFEST_SCHEMA = "filename string, count bigint"


def run_stamp(run_ts: dt.datetime) -> str:
    return run_ts.strftime(STAMP_FORMAT)


def feed_file_name(feed: str, run_ts: dt.datetime, prefix: str = "FEED") -> str:
    """Name of a feed in the manifest. It has no shard suffix, although the files do."""
    return f"{prefix}_{run_stamp(run_ts)}_{feed}.DAT"


def feed_path(root: str, feed: str, run_ts: dt.datetime) -> str:
    return f"{root.rstrip('/')}/{run_stamp(run_ts)}/{feed}"


def export_feed(
    df: DataFrame, root: str, feed: str, run_ts: dt.datetime, rows_per_file: int = 0
) -> tuple[str, int]:
    """Write one feed and return its folder and the number of rows written.

    The count is observed by the writing tasks, so the feed is computed once. Shards are the part
    files Spark writes, each with a header row.
    """
    observed = Observation(f"rows of {feed}")
    path = feed_path(root, feed, run_ts)
    (
        df.observe(observed, F.count(F.lit(1)).alias("rows"))
        .write.options(**FEED_OPTIONS)
        .option("maxRecordsPerFile", rows_per_file)
        .mode("overwrite")
        .csv(path)
    )
    return path, observed.get["rows"]


def read_feed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).options(**FEED_OPTIONS).option("mode", "FAILFAST").csv(path)


def feed_manifest(
    df: DataFrame, feed: str, run_ts: dt.datetime, prefix: str = "FEED"
) -> DataFrame:
    """One row: file name and row count."""
    name = F.lit(feed_file_name(feed, run_ts, prefix))
    return df.agg(F.count(F.lit(1)).alias("count")).select(name.alias("filename"), "count")


def combine_manifests(manifests: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, manifests)


def export_manifest(manifest: DataFrame, root: str, run_ts: dt.datetime, name: str) -> str:
    """One file per run: a manifest has a row per feed, so one task writes it."""
    path = f"{root.rstrip('/')}/{run_stamp(run_ts)}/{name}_{run_stamp(run_ts)}"
    manifest.coalesce(1).write.options(**FEED_OPTIONS).mode("overwrite").csv(path)
    return path


def export_run(
    feeds: Mapping[str, DataFrame], root: str, run_ts: dt.datetime, prefix: str = "FEED"
) -> DataFrame:
    """Export every feed of a run, then its manifest; returns the manifest."""
    spark = next(iter(feeds.values())).sparkSession
    counts = [
        (feed_file_name(feed, run_ts, prefix), export_feed(df, root, feed, run_ts)[1])
        for feed, df in feeds.items()
    ]
    manifest = spark.createDataFrame(counts, MANIFEST_SCHEMA)
    export_manifest(manifest, root, run_ts, "manifest")
    return manifest
