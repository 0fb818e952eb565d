from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def live_rows(table: DataFrame, deleted_flag: str = "is_deleted") -> DataFrame:
    """Rows not soft-deleted. A NULL flag counts as deleted. The filter reaches the parquet scan."""
    return table.filter(F.col(deleted_flag) == F.lit(False))
