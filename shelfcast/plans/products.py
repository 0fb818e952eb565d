"""The product dimension run: combine, track changes, overwrite, insert, mark deleted, flag."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.eligibility import eligible_skus, flag_changes, flag_excluded
from shelfcast.operators.product_history import (
    combine_sources,
    dimension_changes,
    history_of_events,
    latest_events,
    mark_deleted,
    new_rows,
    overwrite_current,
    track_changes,
)
from shelfcast.params import EligibilityParams
from shelfcast.session import apply_scale_settings
from shelfcast.sinks import stage_table
from shelfcast.sinks.buckets import BucketTable, merge_buckets, touched_buckets
from shelfcast.sinks.feeds import run_stamp


def product_dimension_run(
    dimension: DataFrame,
    sources: Sequence[DataFrame],
    brand: DataFrame,
    tracked: Sequence[str],
    overwritten: Sequence[str],
    base: str,
    run_ts: dt.datetime,
    params: EligibilityParams,
) -> DataFrame:
    """The published dimension after one run. ``sources`` are in order of priority.

    The combined sources are read by four steps and the changed dimension by two, so both are
    stored; the steps between them are one plan. Eligibility looks at current rows and flags every
    row of the sku.
    """
    apply_scale_settings(dimension.sparkSession)
    run_id = run_stamp(run_ts)
    combined = stage_table(combine_sources(sources), f"{base}/combined", run_id)
    changed = track_changes(dimension, combined, tracked, run_ts)
    current = overwrite_current(changed, combined, overwritten)
    # Changes keep the set of current keys, so new keys are found against the stored dimension.
    with_new = current.unionByName(
        new_rows(dimension, combined, run_ts), allowMissingColumns=True
    )
    marked = stage_table(mark_deleted(with_new, combined), f"{base}/changed", run_id)
    eligible = eligible_skus(marked.filter("is_current"), brand, params)
    return stage_table(flag_excluded(marked, eligible), f"{base}/dimension", run_id)


def merge_exclusions(table: BucketTable, brand: DataFrame, params: EligibilityParams) -> list[int]:
    """Bring the exclusion flag of stored products up to date, and return the buckets rewritten.

    The rules are checked over the columns they need of all products; only buckets with a flag to
    turn are read whole and written.
    """
    spark = apply_scale_settings(brand.sparkSession)
    products = table.read(spark)
    changes = flag_changes(products, eligible_skus(products, brand, params))

    def flagged(rows: DataFrame, only: Sequence[int]) -> DataFrame:
        return flag_excluded(rows, eligible_skus(rows, brand, params))

    return merge_buckets(table, changes, flagged)


def product_dimension_merge(
    table: BucketTable,
    sources: Sequence[DataFrame],
    brand: DataFrame,
    tracked: Sequence[str],
    overwritten: Sequence[str],
    base: str,
    run_ts: dt.datetime,
    params: EligibilityParams,
) -> list[int]:
    """``product_dimension_run`` on a dimension in buckets of the sku: only buckets with a key that
    the delivery changes, or with a flag to turn, are rewritten; returns these.

    The stored dimension has the columns ``is_deleted`` and ``is_excluded``. Run again after a
    failure, a bucket that is done has no changes any more.
    """
    spark = apply_scale_settings(brand.sparkSession)
    combined = stage_table(combine_sources(sources), f"{base}/combined", run_stamp(run_ts))
    stored = table.read(spark)
    keys = dimension_changes(stored, combined, [*tracked, *overwritten])
    flags = flag_changes(stored, eligible_skus(stored.filter("is_current"), brand, params))

    def changed(rows: DataFrame, only: Sequence[int]) -> DataFrame:
        source = table.within(combined, only)
        current = overwrite_current(track_changes(rows, source, tracked, run_ts), source, overwritten)
        with_new = current.unionByName(new_rows(rows, source, run_ts), allowMissingColumns=True)
        marked = mark_deleted(with_new, source)
        return flag_excluded(marked, eligible_skus(marked.filter("is_current"), brand, params))

    return merge_buckets(table, keys.unionByName(flags), changed)


def merge_events(
    events: BucketTable, history: BucketTable, delivery: DataFrame, key: str, tracked: Sequence[str]
) -> list[int]:
    """Add a delivery of events (key, effective_at, delivered, tracked columns), in any order and
    however late, to the stored ones, and rebuild the history of the keys' buckets; returns these.

    Both tables have the same buckets. Stored events are kept, those that say nothing new too: a
    late one can make them matter. The history is derived from them, so a run that broke off between
    the two is made good by running it again. The history does not read itself, so it is written once,
    into its place.
    """
    spark = apply_scale_settings(delivery.sparkSession)
    only = touched_buckets(events, delivery)
    if only:
        events.replace(latest_events(events.read(spark, only).unionByName(delivery), key), only)
        timed = events.filled(spark, only, F.col("effective_at").isNotNull())
        history.replace(history_of_events(events.read(spark, only), key, tracked), only, timed)
    return only
