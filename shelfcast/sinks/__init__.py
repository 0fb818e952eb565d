from shelfcast.sinks.arrivals import high_water_mark, load_arrivals, read_fact
from shelfcast.sinks.buckets import (
    BucketTable,
    Snapshot,
    compare_snapshots,
    differing_buckets,
    merge_buckets,
    store_snapshot,
    touched_buckets,
)
from shelfcast.sinks.compaction import PackedHistory
from shelfcast.sinks.feeds import (
    combine_manifests,
    export_feed,
    export_manifest,
    export_run,
    feed_file_name,
    feed_manifest,
    read_feed,
)
from shelfcast.sinks.publish import (
    append_history,
    point_table,
    publish_pointed,
    publish_table,
    read_history,
    refresh_dates,
    stage_table,
    write_by_date,
)
from shelfcast.sinks.quarantine import split_feed, split_rows
from shelfcast.sinks.store_delta import export_store_deltas

__all__ = [
    "BucketTable",
    "PackedHistory",
    "Snapshot",
    "append_history",
    "combine_manifests",
    "compare_snapshots",
    "differing_buckets",
    "export_feed",
    "export_manifest",
    "export_run",
    "export_store_deltas",
    "feed_file_name",
    "feed_manifest",
    "high_water_mark",
    "load_arrivals",
    "merge_buckets",
    "point_table",
    "publish_pointed",
    "publish_table",
    "read_fact",
    "read_feed",
    "read_history",
    "refresh_dates",
    "split_feed",
    "split_rows",
    "stage_table",
    "store_snapshot",
    "touched_buckets",
    "write_by_date",
]
