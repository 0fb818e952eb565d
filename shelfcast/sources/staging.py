"""Typed staging loads: CSV with one header row and a declared schema, replacing the target."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from shelfcast.sinks.publish import stage_table


def _all_strings(*names: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


# Column order of the two delivered files.
ZIP_MAP_SCHEMA = _all_strings("zipcode", "optimal_facility", "backup")
SIZE_RULE_SCHEMA = _all_strings(
    "axis2", "group_name", "sizing_group", "optional_brand", "optional_mc", "optional_disable"
)


def read_typed_csv(spark: SparkSession, path: str, schema: StructType, sep: str = ",") -> DataFrame:
    """CSV rows under a declared schema; a row with the wrong number of columns fails the read.

    Column pruning is off so that a jagged row fails even when a query uses one column only.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("columnPruning", False)
        .csv(path)
    )


def stage_csv(
    spark: SparkSession, path: str, schema: StructType, target: str, run_id: str
) -> DataFrame:
    """Load a file into its staging table and return the table as published for this run."""
    return stage_table(read_typed_csv(spark, path, schema), target, run_id)
