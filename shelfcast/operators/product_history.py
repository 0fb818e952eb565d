"""Product dimension changes.

The steps are known by name, order and place only; their rules here are our own definitions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VALIDITY = ("valid_from", "valid_to", "is_current")


def combine_sources(sources: Sequence[DataFrame], key: str = "sku") -> DataFrame:
    """One row per key, each field from the first source (in the order given) that has it.

    An aggregate over the union rather than a chain of full outer joins: one shuffle for any
    number of sources, merged map-side, so a key repeated within a source cannot multiply. Such a
    repeat resolves to the smallest value. A NULL key identifies nothing: those rows stay out and
    ``keyless_rows`` counts them.
    """
    fields = [c for c in sources[0].columns if c != key]
    ranked = reduce(
        DataFrame.unionByName,
        [source.withColumn("source_rank", F.lit(rank)) for rank, source in enumerate(sources)],
    )

    def first_known(field: str) -> Column:
        known = F.when(F.col(field).isNotNull(), F.struct("source_rank", field))
        return F.min(known)[field].alias(field)

    return ranked.filter(F.col(key).isNotNull()).groupBy(key).agg(*[first_known(f) for f in fields])


def keyless_rows(sources: Sequence[DataFrame], key: str = "sku") -> DataFrame:
    """One row with the number of source rows that a run leaves out for want of a key."""
    keys = reduce(DataFrame.unionByName, [source.select(key) for source in sources])
    return keys.agg(F.count(F.when(F.col(key).isNull(), 1)).alias("reject_count"))


def _instant(ts: dt.datetime) -> Column:
    """As text: a datetime literal would be shifted by the driver's and the session's time zone."""
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def start_history(products: DataFrame, since: dt.datetime) -> DataFrame:
    """A first dimension version: every row open since one time."""
    return products.select(
        "*",
        _instant(since).alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def _prefixed(source: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    return source.select(
        key, F.lit(True).alias("in_source"), *[F.col(c).alias(f"new_{c}") for c in columns]
    )


def track_changes(
    dimension: DataFrame,
    source: DataFrame,
    tracked: Sequence[str],
    run_ts: dt.datetime,
    key: str = "sku",
) -> DataFrame:
    """Type 2: close the current row of a key whose tracked columns changed and open a new one.

    One join and one pass: a changed row becomes an array of the closed and the opened version.
    The opened row takes the tracked columns from the source, which has one row per key. The key
    stays outside the array, so the rows keep their partitioning for the steps that follow.
    """
    now = _instant(run_ts)
    columns = dimension.columns
    joined = dimension.join(_prefixed(source, key, tracked), key, "left")
    same = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"new_{c}")) for c in tracked]
    )
    changed = F.col("is_current") & F.col("in_source").isNotNull() & ~same

    def version(values: dict[str, Column]) -> Column:
        return F.struct(*[values.get(c, F.col(c)).alias(c) for c in columns if c != key])

    closed = version({"valid_to": now, "is_current": F.lit(False)})
    opened = version(
        {c: F.col(f"new_{c}") for c in tracked}
        | {"valid_from": now, "valid_to": F.lit(None).cast("timestamp_ntz")}
    )
    versions = F.when(changed, F.array(closed, opened)).otherwise(F.array(version({})))
    return joined.select(key, F.inline(versions)).select(*columns)


def dimension_changes(
    dimension: DataFrame,
    source: DataFrame,
    columns: Sequence[str],
    key: str = "sku",
    flag: str = "is_deleted",
) -> DataFrame:
    """Keys of which a run over a delivery would change a row: current rows whose columns differ, new
    keys, keys that vanished and are not marked, and marked ones that came back.

    Both sides have at most one row per key (current rows, deliveries), so an aggregate over the
    union compares them; closed rows never change.
    """
    values = F.struct(*columns)
    before = dimension.filter("is_current").select(
        key, values.alias("before"), F.coalesce(flag, F.lit(False)).alias("gone")
    )
    after = source.filter(F.col(key).isNotNull()).select(key, values.alias("after"))
    both = before.unionByName(after, allowMissingColumns=True).groupBy(key).agg(
        F.max("before").alias("before"), F.max("after").alias("after"), F.max("gone").alias("gone")
    )
    marked = F.coalesce("gone", F.lit(False))
    kept = F.col("before").eqNullSafe(F.col("after")) & ~marked
    return both.where(~(kept | (F.col("after").isNull() & marked))).select(key)


def latest_events(events: DataFrame, key: str, order: str = "delivered") -> DataFrame:
    """One event per key and ``effective_at``: the one delivered last, of those the largest."""
    values = [c for c in events.columns if c not in (key, "effective_at", order)]
    return (
        events.groupBy(key, "effective_at")
        .agg(F.max(F.struct(order, *values)).alias("last"))
        .select(key, "effective_at", "last.*")
        .select(*events.columns)
    )


def history_of_events(events: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """Type 2 from events (key, effective_at, tracked columns) in any order of delivery: a version
    for each stretch of events that say the same, from its first event to the next version.

    Events are one per key and time (``latest_events``), so what a window sorts is what one key's
    history holds. Events without a time say nothing about when and are left out; a NULL value is a
    value.
    """
    by_time = Window.partitionBy(key).orderBy("effective_at")
    said = F.struct(*tracked)
    before = F.lag(said).over(by_time)
    opens = before.isNull() | ~before.eqNullSafe(said)
    stretches = events.where("effective_at IS NOT NULL").withColumn("opens", opens).where("opens")
    until = F.lead("effective_at").over(by_time)
    return stretches.select(
        key, *tracked, F.col("effective_at").alias("valid_from"), until.alias("valid_to")
    ).withColumn("is_current", F.col("valid_to").isNull())


def overwrite_current(
    dimension: DataFrame, source: DataFrame, columns: Sequence[str], key: str = "sku"
) -> DataFrame:
    """Type 1: current rows take these columns from the source, NULLs included."""
    joined = dimension.join(_prefixed(source, key, columns), key, "left")
    replace = F.col("is_current") & F.col("in_source").isNotNull()
    return joined.select(
        *[
            F.when(replace, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else c
            for c in dimension.columns
        ]
    )


def new_rows(
    dimension: DataFrame, source: DataFrame, run_ts: dt.datetime, key: str = "sku"
) -> DataFrame:
    """An open row for each source row whose key is known and has no current row."""
    current = dimension.filter("is_current").select(key)
    keyed = source.filter(F.col(key).isNotNull())
    return start_history(keyed.join(current, key, "left_anti"), run_ts)


def insert_new(
    dimension: DataFrame, source: DataFrame, run_ts: dt.datetime, key: str = "sku"
) -> DataFrame:
    """Dimension plus its new rows; columns the source lacks stay NULL."""
    return dimension.unionByName(
        new_rows(dimension, source, run_ts, key), allowMissingColumns=True
    )


def mark_deleted(
    dimension: DataFrame, source: DataFrame, key: str = "sku", flag: str = "is_deleted"
) -> DataFrame:
    """Flag current rows whose key is not in the source, and only those: a key that came back is
    not deleted any more. Closed rows keep the flag they had; nothing is removed."""
    present = source.select(key).distinct().withColumn("in_source", F.lit(True))
    before = F.coalesce(flag, F.lit(False)) if flag in dimension.columns else F.lit(False)
    gone = F.when(F.col("is_current"), F.col("in_source").isNull()).otherwise(before)
    columns = [c for c in dimension.columns if c != flag]
    return dimension.join(present, key, "left").select(*columns, gone.alias(flag))
