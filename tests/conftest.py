from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from shelfcast.session import apply_scale_settings  # noqa: E402

SMALL = "/root/testdata/sf0.001"

# Small data treated as large: nothing is broadcast, inputs have many splits, skew is acted on.
LARGE_DATA = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.files.maxPartitionBytes": "32KB",
    "spark.sql.files.openCostInBytes": "0",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


def explained(df, mode="simple"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.fixture(scope="session")
def spark(tmp_path_factory: pytest.TempPathFactory) -> SparkSession:
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("shelfcast-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", str(shared))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield apply_scale_settings(session)
    session.stop()


@pytest.fixture
def large_data(spark: SparkSession) -> SparkSession:
    before = {key: spark.conf.get(key) for key in LARGE_DATA if spark.conf.get(key, None)}
    for key, value in LARGE_DATA.items():
        spark.conf.set(key, value)
    yield spark
    for key in LARGE_DATA:
        spark.conf.set(key, before[key]) if key in before else spark.conf.unset(key)
