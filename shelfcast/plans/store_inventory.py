"""The store inventory run: upsert, per-store delta files, history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from shelfcast.operators.inventory import snapshot_delta, upsert_snapshot
from shelfcast.session import apply_scale_settings
from shelfcast.sinks import append_history, export_store_deltas, stage_table
from shelfcast.sinks.feeds import run_stamp


def store_inventory_run(
    inventory: DataFrame,
    previous: DataFrame,
    snapshot: DataFrame,
    base: str,
    prefix: str,
    run_ts: dt.datetime,
    sequence: int,
) -> DataFrame:
    """Publish the merged inventory and return it; write the run's delta and history.

    The delta compares the previous snapshot with the new one, so a key that left the stock is
    reported with quantity 0; the merged inventory keeps such keys. The history is written first and the store files are made from it, so the delta is computed
    once and both agree after a retry.
    """
    apply_scale_settings(inventory.sparkSession)
    run_id = run_stamp(run_ts)
    merged = stage_table(upsert_snapshot(inventory, snapshot), f"{base}/inventory", run_id)
    delta = snapshot_delta(previous, snapshot)
    history = append_history(delta, f"{base}/history", run_id)
    rows = merged.sparkSession.read.schema(delta.schema).parquet(f"{history}/run_id={run_id}")
    export_store_deltas(rows, f"{base}/files/{run_id}", prefix, run_ts, sequence)
    return merged
