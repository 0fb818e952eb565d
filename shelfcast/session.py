"""Session settings the feeds rely on at scale, and the shared folder for staged data."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# A join on a hot key is often followed by an aggregate on the same key; without the forced
# setting AQE leaves such a join unsplit because splitting costs one more shuffle.
# In Spark 4.1 a union reports its inputs' common partitioning; when AQE then changes one input the
# job fails with "Can't zip RDDs with unequal numbers of partitions", so unions keep no partitioning.
# A join of a large scan with a filtered table that is too large to broadcast drops most rows in the
# scan by a Bloom filter. Its size is fixed: a byte for each of BLOOM_ITEMS keys, with which 2 in 100
# other keys pass, and each task that reads the filtered table sends one. Spark makes a filter only
# for scans over 10 GB.
# Store files have a folder each. A task that lists folders first unpacks the whole configuration, which
# takes longer than listing one, so a thousand tasks share them instead of Spark's ten thousand.
BLOOM_ITEMS = 16_000_000
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.unionOutputPartitioning": "false",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "1000",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1TB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": str(BLOOM_ITEMS),
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": str(BLOOM_ITEMS),
    "spark.sql.optimizer.runtime.bloomFilter.numBits": str(8 * BLOOM_ITEMS),
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": str(8 * BLOOM_ITEMS),
}


def apply_scale_settings(spark: SparkSession) -> SparkSession:
    for key, value in SCALE_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def held_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings for the jobs of one step; the session's own come back, also after a failure."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder path under the cluster's shared checkpoint folder.

    Where ``spark.checkpoint.dir`` is unset the folder lies in the warehouse, which Spark's own
    tables already need to be shared; it never lies in a temporary folder of one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
