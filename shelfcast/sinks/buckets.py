"""Tables kept in buckets of their key's hash, of which a merge rewrites only those it touches.

A table is a folder partitioned by ``bucket``, the hash of the key modulo the number of buckets. A
merge finds the keys that change, rebuilds the buckets that hold them from a scan of these buckets
alone, stores the new rows and then replaces just these folders by a dynamic overwrite. All rows of
a key lie in one bucket, so rules that look at a key's rows need no others.

The bucket numbers of a run are the only thing the driver sees: at most as many as there are buckets.
A run that breaks off leaves each bucket as it was or as it becomes, and the next run finds what is
left to do. Readers that must not see a mix point at a run path (``publish.point_table``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from shelfcast.session import scratch_path
from shelfcast.sinks.publish import stage_table

BUCKET = "bucket"


@dataclass(frozen=True)
class BucketTable:
    """A table at ``path`` with the columns of ``schema``, bucketed by ``key``."""

    path: str
    schema: StructType
    key: Sequence[str]
    buckets: int

    def bucket(self) -> Column:
        """The bucket of a row with the key's columns; a NULL key has one too."""
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def read(self, spark: SparkSession, only: Sequence[int] | None = None) -> DataFrame:
        """The rows, of some buckets only if given: the folders of others are not listed as input."""
        return self._stored(spark, only).select(*[f.name for f in self.schema.fields])

    def _stored(self, spark: SparkSession, only: Sequence[int] | None) -> DataFrame:
        stored = StructType([*self.schema.fields, StructField(BUCKET, IntegerType())])
        rows = spark.read.schema(stored).parquet(self.path)
        return rows if only is None else rows.where(F.col(BUCKET).isin(list(only)))

    def filled(self, spark: SparkSession, only: Sequence[int], condition: Column) -> list[int]:
        """Which of some buckets have rows with a condition; only its columns are read."""
        rows = self._stored(spark, only).where(condition).select(BUCKET).distinct()
        return sorted(row[0] for row in rows.collect())

    def within(self, df: DataFrame, only: Sequence[int]) -> DataFrame:
        """The rows of another table with the key's columns that belong to some buckets."""
        return df.where(self.bucket().isin(list(only)))

    def _write(self, df: DataFrame, mode: str) -> None:
        """The rebalance hint lets AQE split a bucket that is too large for one task."""
        (
            df.select(*[f.name for f in self.schema.fields], self.bucket().alias(BUCKET))
            .hint("rebalance", BUCKET)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", mode)
            .partitionBy(BUCKET)
            .parquet(self.path)
        )

    def create(self, df: DataFrame) -> None:
        """Write the whole table."""
        self._write(df, "static")

    def replace(self, df: DataFrame, only: Iterable[int], filled: Iterable[int] | None = None) -> None:
        """Put df, rows of the buckets ``only``, in their place; a bucket without rows is emptied.

        df is stored first, as it may read the buckets that it replaces. A df that does not, and of
        which the buckets with rows are known (``filled``), is written at once.
        """
        spark = df.sparkSession
        if filled is None:
            df = stage_table(df, scratch_path(spark, "buckets"), "rows")
            filled = [row[0] for row in df.select(self.bucket()).distinct().collect()]
        self._write(df, "dynamic")
        for number in set(only) - set(filled):
            spark.createDataFrame([], self.schema).write.mode("overwrite").parquet(f"{self.path}/{BUCKET}={number}")


def touched_buckets(table: BucketTable, changes: DataFrame) -> list[int]:
    """The buckets of the keys in changes: at most as many numbers as the table has buckets."""
    return sorted(row[0] for row in changes.select(table.bucket()).distinct().collect())


def merge_buckets(
    table: BucketTable,
    changes: DataFrame,
    rebuilt: Callable[[DataFrame, Sequence[int]], DataFrame],
) -> list[int]:
    """Rewrite the buckets that hold keys of changes, and return them.

    ``rebuilt`` gets the stored rows of these buckets and their numbers, with which it can restrict
    its other inputs (``BucketTable.within``), and returns the rows that take their place.
    """
    only = touched_buckets(table, changes)
    if only:
        table.replace(rebuilt(table.read(changes.sparkSession, only), only), only)
    return only


def bucket_digests(table: BucketTable, spark: SparkSession) -> DataFrame:
    """A row (bucket, n_rows, digest) per filled bucket, whatever the order of its rows.

    The digest adds up 64-bit hashes of whole rows: two different buckets of as many rows have the
    same one with a chance of 1 in 2^64. It reduces map-side to a row per bucket and task.
    """
    rows = table.read(spark)
    whole = F.xxhash64(*[F.col(c) for c in rows.columns]).cast("decimal(20,0)")
    return rows.groupBy(table.bucket().alias(BUCKET)).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(whole).cast("decimal(38,0)").alias("digest")
    )


@dataclass(frozen=True)
class Snapshot:
    """A bucket table together with the digests that were stored when it was written."""

    table: BucketTable
    digests: DataFrame


def store_snapshot(
    df: DataFrame, base: str, key: Sequence[str], buckets: int
) -> Snapshot:
    """Write one delivery of a table in buckets, and its digests next to it."""
    table = BucketTable(f"{base.rstrip('/')}/rows", df.schema, tuple(key), buckets)
    table.create(df)
    digests = stage_table(bucket_digests(table, df.sparkSession), f"{base.rstrip('/')}/digests", "all")
    return Snapshot(table, digests)


def differing_buckets(previous: Snapshot, current: Snapshot) -> list[int]:
    """Buckets whose rows differ between two snapshots of the same buckets. Only digests are read."""
    if previous.table.buckets != current.table.buckets or tuple(previous.table.key) != tuple(current.table.key):
        raise ValueError("the snapshots are bucketed in different ways")
    both = previous.digests.unionByName(current.digests)
    same = both.groupBy(BUCKET, "n_rows", "digest").agg(F.count(F.lit(1)).alias("sides"))
    return sorted(row[0] for row in same.where("sides = 1").select(BUCKET).distinct().collect())


def compare_snapshots(
    previous: Snapshot, current: Snapshot, delta: Callable[[DataFrame, DataFrame], DataFrame]
) -> DataFrame:
    """``delta`` of two snapshots from the buckets that differ; the others are not scanned."""
    spark = current.digests.sparkSession
    only = differing_buckets(previous, current)
    return delta(previous.table.read(spark, only), current.table.read(spark, only))
