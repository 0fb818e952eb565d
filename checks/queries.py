"""One registered query per operator, each over whole tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import (
    BACKORDER_PARAMS,
    ELIGIBILITY_PARAMS,
    LOCATION_PARAMS,
    STOCK_DATE,
    Tables,
    money,
    part_sku,
)
from shelfcast import sinks, sources
from shelfcast.functions import sequence_label, surrogate_key
from shelfcast.operators import (
    backorder,
    eligibility,
    facts,
    inventory,
    levels,
    locations,
    network,
    product_history,
    quality,
    sizing,
)
from shelfcast.plans import (
    merge_events,
    merge_exclusions,
    planning_checks,
    product_dimension_merge,
    product_dimension_run,
    store_inventory_run,
)
from shelfcast.plans.interface import location_dimension, pending_backorders
from shelfcast.session import scratch_path

RUN_TS = dt.datetime(2021, 10, 14, 6, 45, 0)
HISTORY_START = dt.datetime(2021, 1, 1)
FIRST_RUN = dt.datetime(2021, 4, 1)
ARRIVALS = (dt.datetime(1998, 1, 1), dt.datetime(2000, 2, 15), dt.datetime(2100, 1, 1))
BUCKETS = 16
HISTORY_FILE_BYTES = 128 << 20
DIMENSION_COLUMNS = (
    "sku", "skudesc", "wholesale_price", "valid_from", "valid_to", "is_current", "is_deleted", "is_excluded"
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}


def query(name: str) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(spark, sf_dir))

        REGISTERED[name] = run
        return build

    return register


@query("q01_surrogate_key")
def surrogate_keys(t: Tables) -> DataFrame:
    return t.locations.select(
        "location_id", surrogate_key("location", F.col("name")).alias("member_id")
    )


@query("q02_live_rows")
def live_locations(t: Tables) -> DataFrame:
    return sources.live_rows(t.locations)


@query("q03_catalog_members")
def catalogs(t: Tables) -> DataFrame:
    return locations.catalog_members(t.catalog)


@query("q04_selling_channels")
def channels(t: Tables) -> DataFrame:
    return locations.selling_channels(t.catalog, t.order_source)


@query("q05_store_locations")
def stores(t: Tables) -> DataFrame:
    return locations.store_locations(
        t.catalog, t.order_source, t.locations, t.location_classes, t.store_ids, LOCATION_PARAMS
    )


@query("q06_web_locations")
def web(t: Tables) -> DataFrame:
    return locations.web_locations(t.catalog, t.order_source, LOCATION_PARAMS)


@query("q07_dc_locations")
def centres(t: Tables) -> DataFrame:
    return locations.dc_locations(t.locations, t.location_classes, t.dc_ids)


@query("q08_location_dim")
def location_dim(t: Tables) -> DataFrame:
    return location_dimension(
        t.catalog,
        t.order_source,
        t.locations,
        t.location_classes,
        t.store_ids,
        t.dc_ids,
        LOCATION_PARAMS,
    )


@query("q09_channel_groups")
def channel_groups(t: Tables) -> DataFrame:
    pairs = locations.catalog_source_pairs(t.catalog, t.order_source)
    return locations.with_channel_groups(pairs, LOCATION_PARAMS)


@query("q10_po_type")
def po_types(t: Tables) -> DataFrame:
    return locations.with_location_classes(t.locations, t.location_classes).select(
        "location_id", "location_extid", "store_po_type", "dc_po_type", "dc_flag", "vdc_flag"
    )


@query("q11_location_attributes")
def attributes(t: Tables) -> DataFrame:
    return locations.location_attributes(location_dim(t))


@query("q12_location_levels")
def location_level_list(t: Tables) -> DataFrame:
    return levels.location_levels(
        catalogs(t), channels(t), location_dim(t), LOCATION_PARAMS.company_name
    )


@query("q13_product_levels")
def product_level_list(t: Tables) -> DataFrame:
    return levels.product_levels(t.raw_products)


def _as_csv(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


@query("q14_staged_zip_csv")
def staged_zip_map(t: Tables) -> DataFrame:
    path = _as_csv(t.zip_map, "zip-map-csv")
    target = scratch_path(t.spark, "zip-map")
    return sources.stage_csv(t.spark, path, sources.ZIP_MAP_SCHEMA, target, "run-1")


@query("q15_staged_rule_csv")
def staged_size_rules(t: Tables) -> DataFrame:
    path = _as_csv(t.size_rules, "size-rules-csv")
    target = scratch_path(t.spark, "size-rules")
    return sources.stage_csv(t.spark, path, sources.SIZE_RULE_SCHEMA, target, "run-1")


@query("q16_zip_network")
def zips(t: Tables) -> DataFrame:
    return network.zip_network(t.zip_map, t.locations)


@query("q17_store_network")
def store_zips(t: Tables) -> DataFrame:
    return network.store_network(zips(t), location_dim(t))


@query("q18_rule_lookup")
def rule_tiers(t: Tables) -> DataFrame:
    none = F.lit(None).cast("string")
    brand = sizing.rule_lookup(t.size_rules, ["axis2", "optional_brand"]).select(
        F.lit("brand").alias("tier"), "axis2", F.col("optional_brand").alias("key"), "group_name"
    )
    by_class = sizing.rule_lookup(t.size_rules, ["axis2", "optional_mc"]).select(
        F.lit("class").alias("tier"), "axis2", F.col("optional_mc").alias("key"), "group_name"
    )
    axis = sizing.rule_lookup(t.size_rules, ["axis2"]).select(
        F.lit("axis").alias("tier"), "axis2", none.alias("key"), "group_name"
    )
    return brand.unionByName(by_class).unionByName(axis)


@query("q19_sku_size_group")
def sku_groups(t: Tables) -> DataFrame:
    return sizing.sku_size_groups(t.products, t.size_rules)


@query("q20_size_groups")
def group_list(t: Tables) -> DataFrame:
    return sizing.size_groups(sku_groups(t))


@query("q21_open_orders")
def open_order_rows(t: Tables) -> DataFrame:
    return backorder.open_orders(t.order_headers, BACKORDER_PARAMS)


@query("q22_backordered_units")
def owed_units(t: Tables) -> DataFrame:
    return backorder.backordered_units(
        t.units, open_order_rows(t), t.raw_products, BACKORDER_PARAMS
    )


@query("q23_flatten_details")
def details(t: Tables) -> DataFrame:
    return backorder.flatten_details(t.transactions)


@query("q24_demand_sales")
def demand(t: Tables) -> DataFrame:
    return backorder.demand_sales(details(t), owed_units(t), BACKORDER_PARAMS).select(
        "order_number",
        "sku",
        "catalog_name",
        F.col("demand_quantity").cast("decimal(38,2)").alias("demand_quantity"),
        F.col("demand_sales").cast("decimal(38,2)").alias("demand_sales"),
        "orderline_date",
    )


def pending_value_of(t: Tables) -> DataFrame:
    base = scratch_path(t.spark, "backorders")
    return pending_backorders(
        t.units, t.transactions, t.products, BACKORDER_PARAMS, base, "run", t.order_headers
    )


@query("q25_backorder_value")
def pending_value(t: Tables) -> DataFrame:
    return pending_value_of(t).select(
        "catalog",
        "order_source",
        "order_number",
        "sku",
        "orderline_date",
        F.col("demand_quantity").cast("decimal(38,2)").alias("demand_quantity"),
        F.col("item_demand_sales").cast("decimal(38,2)").alias("item_demand_sales"),
        "pending_backorder_u",
        "pending_backorder_v",
        "pending_backorder_c",
    )


@query("q26_eligible_skus")
def eligible(t: Tables) -> DataFrame:
    return eligibility.eligible_skus(t.raw_products, t.brand, ELIGIBILITY_PARAMS)


@query("q27_exclusion_flag")
def flagged(t: Tables) -> DataFrame:
    return eligibility.flag_excluded(t.raw_products, eligible(t)).select("sku", "is_excluded")


@query("q27b_exclusion_merge")
def flags_merged(t: Tables) -> DataFrame:
    """All products are stored as excluded; the merge turns the flags that the rules turn."""
    rows = t.raw_products.withColumn("is_excluded", F.lit(True))
    table = sinks.BucketTable(scratch_path(t.spark, "products"), rows.schema, ("sku",), BUCKETS)
    table.create(rows)
    merge_exclusions(table, t.brand, ELIGIBILITY_PARAMS)
    return table.read(t.spark).select("sku", "is_excluded")


@query("q28_publish_replace")
def published(t: Tables) -> DataFrame:
    rows = zips(t)
    base = scratch_path(t.spark, "zip-network")
    first = sinks.stage_table(rows, base, "run-1")
    return sinks.stage_table(first, base, "run-2")


@query("q28b_publish_pointer")
def pointed(t: Tables) -> DataFrame:
    """A table that shows first only the zips' best facilities, then the whole network."""
    rows, base = zips(t), scratch_path(t.spark, "zip-network")
    name = f"zip_network_{uuid.uuid4().hex}"
    sinks.publish_pointed(rows.where("priority = 1"), name, base, "run-1")
    return sinks.publish_pointed(rows, name, base, "run-2")


@query("q29_feed_export")
def exported(t: Tables) -> DataFrame:
    rows = attributes(t)
    path, _ = sinks.export_feed(rows, scratch_path(t.spark, "feeds"), "location_attributes", RUN_TS)
    return sinks.read_feed(t.spark, path, rows.schema)


def _manifest_feeds(t: Tables) -> dict[str, DataFrame]:
    return {
        "location_attributes": attributes(t),
        "zip_network": zips(t),
        "size_groups": group_list(t),
    }


@query("q30_feed_manifest")
def manifest(t: Tables) -> DataFrame:
    """The counts are observed while the feeds are written."""
    return sinks.export_run(_manifest_feeds(t), scratch_path(t.spark, "feeds"), RUN_TS)


@query("q31_manifest_export")
def manifest_file(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "feeds")
    rows = sinks.export_run(_manifest_feeds(t), root, RUN_TS)
    stamp = RUN_TS.strftime("%Y%m%d%H%M%S")
    return sinks.read_feed(t.spark, f"{root}/{stamp}/manifest_{stamp}", rows.schema)


@query("q32_store_delta_export")
def store_files(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "store-delta")
    rows = store_delta(t)
    sinks.export_store_deltas(rows, root, "INVENTORY_STORE_", RUN_TS, 7)
    return sinks.read_feed(
        t.spark, root, "store_id bigint, sku string, quantity bigint, feed_file string"
    )


@query("q33_sequence_label")
def sequence_labels(t: Tables) -> DataFrame:
    return t.given("orders").select(
        "o_orderkey", sequence_label(F.col("o_orderkey")).alias("label")
    )


@query("q34_price_snapshot")
def prices(t: Tables) -> DataFrame:
    source = scratch_path(t.spark, "prices")
    t.given("part").select(
        "p_partkey", "p_name", F.col("p_retailprice").cast("decimal(18,2)").alias("price")
    ).write.option("header", True).option("sep", ";").csv(source)
    target = sources.stamped_price_file(
        t.spark, source, scratch_path(t.spark, "stamped-prices"), RUN_TS
    )
    return sources.read_prices(t.spark, target)


def _checked(t: Tables) -> list[quality.FeedCheck]:
    """Three feeds that hold what they promise and a delivery with products that lack a key."""
    base = scratch_path(t.spark, "checked-feeds")
    feeds = {
        "location_attributes": sinks.stage_table(attributes(t), base, "locations"),
        "zip_network": sinks.stage_table(zips(t), base, "zips"),
        "backorder_sales": sinks.stage_table(pending_value_of(t), base, "backorders"),
    }
    delivery = quality.FeedCheck("product_delivery", t.third_source, ["sku"])
    return [*planning_checks(feeds, sources.live_rows(t.catalog), t.locations), delivery]


@query("q35_reject_summary")
def rejects(t: Tables) -> DataFrame:
    return quality.reject_summary(_checked(t))


@query("q35b_reject_quarantine")
def quarantined(t: Tables) -> DataFrame:
    """Counts of the rows that were written apart as rejected."""
    base = scratch_path(t.spark, "quarantine")
    counts = []
    for feed in _checked(t):
        path = sinks.split_feed(feed, f"{base}/{feed.name}", "run")
        kept = sinks.split_rows(t.spark, path, feed.rows.schema, accepted=False)
        counts.append(kept.agg(F.count("*").alias("reject_count")).select(
            F.lit(feed.name).alias("interface_name"), "reject_count"
        ))
    return reduce(DataFrame.unionByName, counts)


@query("q35c_accepted_products")
def accepted_products(t: Tables) -> DataFrame:
    """What of a delivery is accepted: products with a key that is theirs alone."""
    feed = quality.FeedCheck("product_delivery", t.third_source, ["sku"])
    path = sinks.split_feed(feed, scratch_path(t.spark, "accepted"), "run")
    return sinks.split_rows(t.spark, path, feed.rows.schema, accepted=True)


@query("q36_reject_alert")
def reject_alert(t: Tables) -> DataFrame:
    return quality.rejected_feeds(rejects(t))


@query("q37_combine_products")
def combined(t: Tables) -> DataFrame:
    return product_history.combine_sources([t.second_source, t.first_source])


def _dimension(t: Tables) -> DataFrame:
    """A dimension after a first run: it has closed rows, new ones and deleted ones."""
    first = product_history.start_history(t.first_source, HISTORY_START)
    changed = product_history.track_changes(first, t.second_source, ["wholesale_price"], FIRST_RUN)
    grown = product_history.insert_new(changed, t.second_source, FIRST_RUN)
    return product_history.mark_deleted(grown, t.second_source)


@query("q38_product_scd")
def product_versions(t: Tables) -> DataFrame:
    return product_history.track_changes(
        _dimension(t), t.third_source, ["wholesale_price"], RUN_TS
    )


@query("q38b_product_type1")
def product_overwrites(t: Tables) -> DataFrame:
    return product_history.overwrite_current(_dimension(t), t.third_source, ["skudesc"])


@query("q38c_insert_new")
def product_inserts(t: Tables) -> DataFrame:
    return product_history.insert_new(_dimension(t), t.third_source, RUN_TS)


@query("q38d_mark_deleted")
def product_deletes(t: Tables) -> DataFrame:
    return product_history.mark_deleted(_dimension(t), t.third_source)


def _deliveries(t: Tables) -> tuple[DataFrame, list[tuple[DataFrame, dt.datetime]]]:
    """Products of a first dimension, and two later deliveries with the times of their runs."""
    key = F.substring_index(F.substring_index("sku", "-", 1), "P", -1).cast("bigint")
    raised = (F.col("wholesale_price") * F.lit("1.1").cast("decimal(2,1)")).cast("decimal(18,4)")
    merchandise = F.col("merchandise_class")
    products = t.raw_products
    second = products.filter(merchandise != "MC1").withColumn(
        "wholesale_price", F.when(key % 4 == 0, raised).otherwise(F.col("wholesale_price"))
    )
    third = products.filter(merchandise != "MC2").withColumn("sku", F.when(key % 97 != 0, F.col("sku")))
    return products.filter(~merchandise.isin("MC2", "MC3")), [(second, FIRST_RUN), (third, RUN_TS)]


@query("q38e_product_run")
def product_run(t: Tables) -> DataFrame:
    """Two whole runs on products with all their columns, the second on a later delivery."""
    first, deliveries = _deliveries(t)
    base = scratch_path(t.spark, "product-run")
    table = product_history.start_history(first, HISTORY_START)
    for source, run_ts in deliveries:
        table = product_dimension_run(
            table, [source], t.brand, ["wholesale_price"], ["skudesc"], base, run_ts, ELIGIBILITY_PARAMS
        )
    return table.select(*DIMENSION_COLUMNS)


@query("q38f_dimension_merge")
def dimension_merge(t: Tables) -> DataFrame:
    """The two runs of q38e on a dimension in buckets."""
    first, deliveries = _deliveries(t)
    rows = product_history.start_history(first, HISTORY_START).withColumn("is_deleted", F.lit(False))
    flagged = eligibility.flag_excluded(rows, eligibility.eligible_skus(rows, t.brand, ELIGIBILITY_PARAMS))
    base = scratch_path(t.spark, "product-merge")
    table = sinks.BucketTable(f"{base}/dimension", flagged.schema, ("sku",), BUCKETS)
    table.create(flagged)
    for source, run_ts in deliveries:
        product_dimension_merge(
            table, [source], t.brand, ["wholesale_price"], ["skudesc"], base, run_ts, ELIGIBILITY_PARAMS
        )
    return table.read(t.spark).select(*DIMENSION_COLUMNS)


@query("q38g_late_changes")
def late_changes(t: Tables) -> DataFrame:
    """Discounts of a product by ship date; open lines are delivered first, older ones after them."""
    lines = t.given("lineitem").select(
        part_sku("l_partkey").alias("sku"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("effective_at"),
        F.col("l_orderkey").alias("delivered"),
        money("l_discount").alias("discount"),
        "l_returnflag",
    )
    events = lines.drop("l_returnflag")
    base = scratch_path(t.spark, "events")
    stored = sinks.BucketTable(f"{base}/events", events.schema, ("sku",), BUCKETS)
    none = product_history.history_of_events(events.limit(0), "sku", ["discount"])
    history = sinks.BucketTable(f"{base}/history", none.schema, ("sku",), BUCKETS)
    stored.create(events.limit(0))
    history.create(none)
    for flag in ("N", "R", "A"):
        delivery = events.where(lines["l_returnflag"] == flag)
        merge_events(stored, history, delivery, "sku", ["discount"])
    return history.read(t.spark)


@query("q39_inventory_upsert")
def inventory_upsert(t: Tables) -> DataFrame:
    before = t.inventory_before.withColumn("as_of", F.lit(STOCK_DATE))
    after = t.inventory_after.withColumn("as_of", F.lit(dt.date(2001, 12, 31)))
    return inventory.upsert_snapshot(before, after)


@query("q40_inventory_delta")
def store_delta(t: Tables) -> DataFrame:
    return inventory.snapshot_delta(t.inventory_before, t.inventory_after)


@query("q40c_delta_by_digest")
def delta_by_digest(t: Tables) -> DataFrame:
    base = scratch_path(t.spark, "snapshots")
    before, after = (
        sinks.store_snapshot(rows, f"{base}/{name}", inventory.STORE_SKU, BUCKETS)
        for name, rows in (("before", t.inventory_before), ("after", t.inventory_after))
    )
    return sinks.compare_snapshots(before, after, inventory.snapshot_delta)


@query("q40b_store_inventory_run")
def inventory_run(t: Tables) -> DataFrame:
    """The delta that a run puts into its history and its files."""
    before, after = t.stored_inventories()
    inventory_table = before.withColumn("as_of", F.lit(STOCK_DATE))
    base = scratch_path(t.spark, "inventory-run")
    store_inventory_run(
        inventory_table, before, after.withColumn("as_of", F.lit(dt.date(2001, 12, 31))), base, "INV_", RUN_TS, 7
    )
    return sinks.read_history(t.spark, f"{base}/history", before.schema)


@query("q41_history_append")
def history(t: Tables) -> DataFrame:
    base = scratch_path(t.spark, "inventory-history")
    first = t.inventory_before
    delta = store_delta(t)
    sinks.append_history(first, base, "run-1")
    sinks.append_history(first, base, "run-2")
    sinks.append_history(delta, base, "run-2")
    return sinks.read_history(t.spark, base, delta.schema)


@query("q41b_history_compact")
def compacted_history(t: Tables) -> DataFrame:
    """Runs packed into larger files; one of them delivered again after it was packed."""
    first, delta = t.inventory_before, store_delta(t)
    base = scratch_path(t.spark, "packed-history")
    packed = sinks.PackedHistory(base, delta.schema, f"history_layout_{uuid.uuid4().hex}")
    for run in ("run-1", "run-2"):
        packed.append(first, run)
    packed.compact(t.spark, HISTORY_FILE_BYTES, recent=0)
    packed.append(delta, "run-2")
    packed.append(delta.limit(0), "run-3")
    packed.compact(t.spark, HISTORY_FILE_BYTES)
    return packed.read(t.spark)


def _decimal_value(df: DataFrame) -> DataFrame:
    return df.withColumn("value", F.col("value").cast("decimal(38,2)"))


@query("q42_refresh_full")
def full_refresh(t: Tables) -> DataFrame:
    lines = t.sales_lines()
    return _decimal_value(facts.refreshed_fact(None, lines, "full", t.last_date))


def _by_month(df: DataFrame) -> DataFrame:
    return df.withColumn("fact_month", F.trunc("fact_date", "month"))


def _window_refresh(t: Tables, mode: str) -> DataFrame:
    """A stored fact, by month, that has only part of the window's lines; then the refresh of the
    months that the window touches; then the table as stored."""
    last = t.last_date
    first = facts.refresh_window(mode, last)
    path = scratch_path(t.spark, "sales-fact")
    known = (F.col("fact_date") < F.lit(first)) | (F.col("l_returnflag") == "N")
    rows = _by_month(facts.fact_rollup(t.sales_lines().filter(known)))
    sinks.write_by_date(rows, path, "fact_month")
    month = first.replace(day=1)
    fresh = _by_month(facts.fact_rollup(t.sales_lines(month)))
    sinks.refresh_dates(fresh, path, "fact_month", month, last.replace(day=1))
    return _decimal_value(t.spark.read.schema(rows.schema).parquet(path).drop("fact_month"))


@query("q42b_refresh_incr")
def incremental_refresh(t: Tables) -> DataFrame:
    return _window_refresh(t, "incremental")


@query("q42c_refresh_daily")
def daily_refresh(t: Tables) -> DataFrame:
    return _window_refresh(t, "daily")


@query("q42d_refresh_weekly")
def weekly_refresh(t: Tables) -> DataFrame:
    return _window_refresh(t, "weekly")


@query("q42g_refresh_late")
def late_refresh(t: Tables) -> DataFrame:
    """Three loads; a line arrives nine days after its ship date for each line before it."""
    arrived = F.date_add(F.to_date("l_shipdate"), (F.col("l_linenumber") * 9).cast("int"))
    lines = t.sales_lines(arrived_at=arrived.cast("timestamp_ntz"))
    base, since = scratch_path(t.spark, "late-fact"), None
    for run_id, upto in (("one", ARRIVALS[0]), ("two", ARRIVALS[1]), ("three", ARRIVALS[2])):
        sinks.load_arrivals(lines, base, run_id, upto, since)
        since = upto
    return _decimal_value(sinks.read_fact(lines, base))


@query("q42e_inventory_fact")
def inventory_fact(t: Tables) -> DataFrame:
    """Units that stay: returned lines count against them."""
    sign = F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    lines = t.sales_lines().withColumns(
        {"units": F.col("units") * sign, "value": F.col("value") * sign.cast("decimal(2,0)")}
    )
    return _decimal_value(facts.refreshed_fact(None, lines, "full", t.last_date))


@query("q42f_style_fact")
def style_fact(t: Tables) -> DataFrame:
    lines = t.sales_lines()
    found = facts.refreshed_fact(None, lines, "full", t.last_date, keys=facts.STYLE_KEYS)
    return _decimal_value(found)
