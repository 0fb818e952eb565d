"""Accepted and rejected rows of a feed, written apart in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from shelfcast.operators.quality import FeedCheck, labelled_rows

ACCEPTED, BITS = "accepted", "reject_bits"


def split_feed(feed: FeedCheck, base: str, run_id: str) -> str:
    """Write a feed's rows with their ``reject_bits`` to ``accepted=true`` and ``accepted=false``
    under the run's folder, and return that. A task writes two files at most."""
    path = f"{base.rstrip('/')}/{run_id}"
    rows = labelled_rows(feed).withColumn(ACCEPTED, F.col(BITS) == 0)
    rows.write.mode("errorifexists").partitionBy(ACCEPTED).parquet(path)
    return path


def split_rows(spark: SparkSession, path: str, schema: StructType, accepted: bool) -> DataFrame:
    """The accepted rows as the feed has them, or the rejected ones with their ``reject_bits``; only
    their own folder is read."""
    stored = StructType([*schema.fields, StructField(BITS, IntegerType()), StructField(ACCEPTED, BooleanType())])
    rows = spark.read.schema(stored).parquet(path).where(F.col(ACCEPTED) == F.lit(accepted)).drop(ACCEPTED)
    return rows.drop(BITS) if accepted else rows
