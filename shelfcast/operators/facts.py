"""Fact refresh: full, weekly, incremental and daily runs of the sales, inventory and style facts.

The steps are known by name only; the rollups and their windows are our own definitions. The facts
differ in their keys and in the lines they sum up.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FACT_KEYS = ("fact_date", "location_id", "sku")
STYLE_KEYS = ("fact_date", "location_id", "style")
WINDOW_DAYS = {"weekly": 28, "incremental": 7, "daily": 1}


def fact_rollup(lines: DataFrame, keys: Sequence[str] = FACT_KEYS) -> DataFrame:
    return lines.groupBy(*keys).agg(
        F.sum("units").alias("units"), F.sum("value").alias("value")
    )


def merge_rollups(stored: DataFrame, fresh: DataFrame, keys: Sequence[str] = FACT_KEYS) -> DataFrame:
    """Stored totals with those of new lines added: sums of sums, one row per key."""
    columns = [*keys, "units", "value"]
    return fact_rollup(stored.select(*columns).unionByName(fresh.select(*columns)), keys)


def refresh_window(mode: str, as_of: dt.date, days: int | None = None) -> dt.date | None:
    """First date a run replaces; None for all of them."""
    if mode == "full":
        return None
    if mode not in WINDOW_DAYS:
        raise ValueError(f"unknown refresh mode {mode!r}")
    return as_of - dt.timedelta(days=(days or WINDOW_DAYS[mode]) - 1)


def refreshed_fact(
    stored: DataFrame,
    lines: DataFrame,
    mode: str,
    as_of: dt.date,
    days: int | None = None,
    keys: Sequence[str] = FACT_KEYS,
) -> DataFrame:
    """The fact table after a run: the window's dates rebuilt, the others as stored. A full run
    takes all lines.

    The date filter reaches the scan of both sides. To apply the same refresh to a stored table
    without rewriting its other dates use ``sinks.refresh_dates``.
    """
    first = refresh_window(mode, as_of, days)
    if first is None:
        return fact_rollup(lines, keys)
    rebuilt = fact_rollup(lines.filter(F.col("fact_date").between(F.lit(first), F.lit(as_of))), keys)
    kept = stored.filter(
        (F.col("fact_date") < F.lit(first)) | (F.col("fact_date") > F.lit(as_of))
    )
    return kept.unionByName(rebuilt)
