"""Refresh of a fact by what has arrived, however late.

A refresh of the last days loses a line that arrives later than that. Here lines carry the time of
their arrival, and a run adds those that arrived since the run before to the totals of the months
they belong to, new or old. Only these months are read and rewritten.

The state is stored twice, so that a run that breaks off can simply be run again. A high-water mark,
written last, says up to which arrival all months are complete; it bounds what is scanned. Each month
carries the mark of its own last merge (``loaded_to``), written with its rows in one step, so lines
are added once even if an earlier run got as far as this month and no further.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType, TimestampNTZType

from shelfcast.operators.facts import FACT_KEYS, fact_rollup, merge_rollups
from shelfcast.session import scratch_path
from shelfcast.sinks.publish import publish_table, stage_table, write_by_date

MONTH, MARK = "fact_month", "loaded_to"
_MARKS = StructType([StructField("mark", TimestampNTZType())])


def high_water_mark(spark: SparkSession, base: str, runs: Sequence[str]) -> dt.datetime | None:
    """The latest mark that the given completed runs have left; None before the first."""
    paths = [f"{base}/marks/{run}" for run in runs]
    return spark.read.schema(_MARKS).parquet(*paths).agg(F.max("mark")).first()[0] if paths else None


def _instant(at: dt.datetime):
    """As text: a datetime literal would be shifted by the driver's and the session's time zone."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def fact_schema(lines: DataFrame, keys: Sequence[str]) -> StructType:
    return StructType(
        [
            *fact_rollup(lines, keys).schema.fields,
            StructField(MARK, TimestampNTZType()),
            StructField(MONTH, DateType()),
        ]
    )


def load_arrivals(
    lines: DataFrame,
    base: str,
    run_id: str,
    upto: dt.datetime,
    since: dt.datetime | None,
    keys: Sequence[str] = FACT_KEYS,
) -> list[dt.date]:
    """Add the lines (keys, units, value, arrived_at) that arrived after ``since``, the high-water
    mark, and not after ``upto``, to the fact under base; return the months rewritten.

    Lines whose arrival is not known are never taken. ``since`` None is the first load. The driver
    sees months only.
    """
    spark, path = lines.sparkSession, f"{base}/fact"
    arrived = lines.where(F.col("arrived_at") <= _instant(upto))
    if since is not None:
        arrived = arrived.where(F.col("arrived_at") > _instant(since))
    arrived = arrived.withColumn(MONTH, F.trunc("fact_date", "month"))
    schema = fact_schema(lines, keys)
    names = [f.name for f in schema.fields]
    if since is None:
        whole = fact_rollup(arrived, [MONTH, *keys]).withColumn(MARK, _instant(upto)).select(*names)
        write_by_date(whole, path, MONTH)
        months = [row[0] for row in spark.read.schema(schema).parquet(path).select(MONTH).distinct().collect()]
    else:
        months = [row[0] for row in arrived.select(MONTH).distinct().collect()]
        if months:
            stored = spark.read.schema(schema).parquet(path).where(F.col(MONTH).isin(months))
            marks = stored.groupBy(MONTH).agg(F.max(MARK).alias(MARK))  # a row per month
            new = arrived.join(F.broadcast(marks), MONTH, "left").where(
                F.col(MARK).isNull() | (F.col("arrived_at") > F.col(MARK))
            )
            partial = fact_rollup(new, [MONTH, *keys])
            merged = merge_rollups(stored, partial, [MONTH, *keys])
            marked = merged.withColumn(MARK, _instant(upto))  # a sum of sums has a wider type
            fresh = marked.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
            write_by_date(stage_table(fresh, scratch_path(spark, "arrivals"), "rows"), path, MONTH, dynamic=True)
    publish_table(spark.range(1).select(_instant(upto).alias("mark")), f"{base}/marks", run_id)
    return sorted(months)


def read_fact(lines: DataFrame, base: str, keys: Sequence[str] = FACT_KEYS) -> DataFrame:
    """The fact as stored, without its bookkeeping."""
    stored = lines.sparkSession.read.schema(fact_schema(lines, keys)).parquet(f"{base}/fact")
    return stored.drop(MARK, MONTH)
