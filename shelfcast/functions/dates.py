from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def local_date(df: DataFrame, column: str, zone: str) -> Column:
    """Calendar date of an instant in a named zone.

    A timestamp without zone is taken as UTC wall time; a timestamp with zone is an instant already.
    """
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        stored_zone = F.lit("UTC")
    else:
        stored_zone = F.current_timezone()
    wall_time = F.convert_timezone(stored_zone, F.lit(zone), F.col(column).cast("timestamp_ntz"))
    return F.to_date(wall_time)
