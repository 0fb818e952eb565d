"""Physical plans: what is pushed down, pruned, pre-aggregated and split."""

from __future__ import annotations

import re

import pytest
from conftest import SMALL, explained

from checks.queries import REGISTERED

PRODUCTS_OF_DIMENSIONS = {
    "q04_selling_channels",
    "q05_store_locations",
    "q06_web_locations",
    "q08_location_dim",
    "q09_channel_groups",
    "q11_location_attributes",
    "q12_location_levels",
    "q17_store_network",
}
WRITES_FILES = {
    "q14_staged_zip_csv",
    "q15_staged_rule_csv",
    "q27b_exclusion_merge",
    "q28_publish_replace",
    "q28b_publish_pointer",
    "q29_feed_export",
    "q30_feed_manifest",
    "q31_manifest_export",
    "q32_store_delta_export",
    "q34_price_snapshot",
    "q35_reject_summary",
    "q35b_reject_quarantine",
    "q35c_accepted_products",
    "q36_reject_alert",
    "q38e_product_run",
    "q38f_dimension_merge",
    "q38g_late_changes",
    "q40b_store_inventory_run",
    "q40c_delta_by_digest",
    "q41_history_append",
    "q41b_history_compact",
    "q42b_refresh_incr",
    "q42c_refresh_daily",
    "q42d_refresh_weekly",
    "q42g_refresh_late",
}


@pytest.mark.parametrize("name", sorted(set(REGISTERED) - WRITES_FILES))
def test_no_python_in_tasks_and_no_product_of_facts(large_data, name):
    plan = explained(REGISTERED[name](large_data, SMALL))
    assert "Python" not in plan and "Pandas" not in plan
    if name not in PRODUCTS_OF_DIMENSIONS:
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_no_broadcast_is_forced(large_data):
    for name in ("q08_location_dim", "q19_sku_size_group", "q25_backorder_value"):
        assert "Broadcast" not in explained(REGISTERED[name](large_data, SMALL))


def test_filters_and_columns_reach_the_scan(spark):
    from checks.fixtures import Tables

    plan = explained(REGISTERED["q40_inventory_delta"](spark, SMALL), "formatted")
    assert "l_extendedprice" not in plan and "l_discount" not in plan
    t = Tables(spark, SMALL)
    plan = explained(t.sales_lines(t.last_date), "formatted")
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan


def test_tables_are_read_once_and_stored(spark):
    """Lines are read for the stored nested orders and the stored units, part once besides the rules."""
    plan = explained(REGISTERED["q25_backorder_value"](spark, SMALL), "formatted")
    assert "lineitem.parquet" not in plan and plan.count("backordered") >= 1
    plan = explained(REGISTERED["q19_sku_size_group"](spark, SMALL), "formatted")
    assert plan.count("part.parquet") <= 3
    for name in ("q05_store_locations", "q08_location_dim", "q12_location_levels", "q17_store_network"):
        assert "CartesianProduct" not in explained(REGISTERED[name](spark, SMALL))


def test_both_stocks_of_an_inventory_run_come_from_one_pass(spark, monkeypatch):
    from checks.fixtures import Tables

    read, given = [], Tables.given
    monkeypatch.setattr(Tables, "given", lambda t, name: read.append(name) or given(t, name))
    assert REGISTERED["q40b_store_inventory_run"](spark, SMALL).count() > 0
    assert read == ["lineitem"]
    t = Tables(spark, SMALL)
    for stored, stock in zip(t.stored_inventories(), (t.inventory_before, t.inventory_after), strict=True):
        assert sorted(stored.collect()) == sorted(stock.collect())


def test_soft_delete_filter_reaches_the_scan(spark, tmp_path):
    from shelfcast.sources import live_rows

    path = str(tmp_path / "t")
    spark.range(5).selectExpr("id", "id = 1 AS is_deleted").write.parquet(path)
    plan = explained(live_rows(spark.read.parquet(path)), "formatted")
    assert "Not(EqualTo(is_deleted,true))" in plan


def test_nested_columns_are_pruned(spark, tmp_path):
    from checks.fixtures import BACKORDER_PARAMS, Tables

    from shelfcast.operators.backorder import open_orders

    path = str(tmp_path / "nested")
    Tables(spark, SMALL).transactions.write.parquet(path)
    plan = explained(open_orders(spark.read.parquet(path), BACKORDER_PARAMS), "formatted")
    schema = re.search(r"ReadSchema: (.*)", plan).group(1)
    assert "details" not in schema and "employee_extid" not in schema
    assert "GreaterThanOrEqual(sb_event_date" in plan


def test_rules_are_cut_to_the_first_before_the_shuffle(spark):
    plan = explained(REGISTERED["q18_rule_lookup"](spark, SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_demand_is_a_semi_join(spark):
    assert "LeftSemi" in explained(REGISTERED["q24_demand_sales"](spark, SMALL))


def test_units_are_counted_before_they_are_joined(spark):
    plan = explained(REGISTERED["q22_backordered_units"](spark, SMALL))
    first_join = plan.index("n_units")
    assert "partial_count(1)" in plan[first_join:]
    assert "count(1)" not in plan[:first_join].split("Join")[0]


def test_hot_keys_are_split(large_data, tmp_path):
    """One order and one product with a third of the lines, over many input splits."""
    from pyspark.sql import functions as F

    from shelfcast.operators.backorder import demand_sales
    from shelfcast.params import BackorderParams

    spark = large_data
    n = 60_000
    hot = F.col("id") % 3 == 0
    details = spark.range(0, n, 1, 16).select(
        F.when(hot, F.lit(1)).otherwise(F.col("id")).alias("transaction_extid"),
        F.when(hot, F.lit("a")).otherwise(F.col("id").cast("string")).alias("sku"),
        F.lit("demand").alias("transaction_event_type"),
        F.lit("e").alias("employee_extid"),
        F.lit("c").alias("catalog_name"),
        F.expr("timestamp_ntz'2021-01-01 00:00:00'").alias("sb_event_date"),
        F.lit(1).cast("decimal(18,2)").alias("quantity"),
        F.lit(2).cast("decimal(18,2)").alias("amount"),
    )
    owed = spark.range(0, n, 1, 4).select(
        F.col("id").alias("order_number"),
        F.when(F.col("id") == 1, "a").otherwise(F.col("id").cast("string")).alias("sku"),
    )
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    found = demand_sales(details, owed, BackorderParams())
    result = found.collect()
    assert "skew=true" in explained(found)
    totals = {r.order_number: r.demand_quantity for r in result}
    assert totals[1] == n // 3 and len(totals) == n - n // 3


def test_owed_orders_filter_the_scan_and_details_move_once(large_data, tmp_path):
    """A Bloom filter of the owed orders stands below the flattening; details are shuffled by order
    and sku, and neither totals nor the result move them again."""
    from checks.fixtures import BACKORDER_PARAMS, Tables

    from shelfcast import sinks
    from shelfcast.plans.interface import pending_backorders

    t = Tables(large_data, SMALL)
    given = [sinks.stage_table(getattr(t, n), str(tmp_path), n) for n in ("units", "transactions", "products")]
    key = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    large_data.conf.set(key, "1")
    try:
        df = pending_backorders(*given, BACKORDER_PARAMS, str(tmp_path), "run")
        optimized = df._jdf.queryExecution().optimizedPlan().toString()
        executed = explained(df)
        assert df.count() > 0
    finally:
        large_data.conf.unset(key)
    below = optimized.split("Generate explode(details", 1)[1]
    filter_of_scan = next(text for text in below.splitlines() if "+- Filter" in text)
    assert "might_contain" in filter_of_scan and "xxhash64(transactions" in filter_of_scan
    above = executed.split("Generate explode(details")[0].splitlines()
    level, moves = len(above[-1]), 0
    for text in reversed(above):
        depth = len(text) - len(text.lstrip(" :+-"))
        if depth < level:
            level = depth
            moves += bool(re.search(r"Exchange hashpartitioning\((transaction_extid|order_number)", text))
    assert moves == 1


def test_open_orders_do_not_join_the_details(spark, monkeypatch):
    from checks import queries
    from checks.fixtures import Tables
    from shelfcast.plans import interface

    seen, read = [], interface.open_orders
    monkeypatch.setattr(interface, "open_orders", lambda rows, params: seen.append(rows) or read(rows, params))
    tables = Tables(spark, SMALL)
    queries.pending_value_of(tables)
    assert "details" not in seen[0].columns and "l_orderkey" not in explained(seen[0])
    whole = read(tables.transactions, queries.BACKORDER_PARAMS)
    assert sorted(map(str, whole.collect())) == sorted(map(str, read(seen[0], queries.BACKORDER_PARAMS).collect()))
