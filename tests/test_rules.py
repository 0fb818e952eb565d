"""Rules that decide results, each on a few literal rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfcast import sources
from shelfcast.functions import local_date, sequence_label, surrogate_key
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
from shelfcast.params import BackorderParams, EligibilityParams, LocationParams

RULES = (
    "axis2 string, group_name string, sizing_group string, optional_brand string, "
    "optional_mc string, optional_disable string"
)
PRODUCT = (
    "sku string, styleid string, brandid int, item_type string, skudesc string, is_gso boolean, "
    "industry string, netsuite_item_id bigint"
)
NESTED = (
    "transactions struct<transaction_extid:bigint,transaction_status:string,"
    "transaction_event_type:string,order_source_name:string>,"
    "customers struct<customer_firstname:string,customer_lastname:string,customer_email:string>,"
    "shipmodes struct<shipmode_full_name:string>,"
    "site_channels struct<website_name:string,website_storefront_rank:int>,"
    "employees struct<employee_extid:string>,catalogs struct<catalog_name:string>,"
    "sb_event_date timestamp_ntz,"
    "details array<struct<sku:string,quantity:decimal(18,2),amount:decimal(18,2)>>"
)
PARAMS = BackorderParams(since=dt.date(2021, 1, 1))
RUN = dt.datetime(2021, 10, 14, 6, 45)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def nested(spark, *orders):
    """(id, status, event, employee, date, details) with the rest filled in."""
    return spark.createDataFrame(
        [
            (
                (oid, status, event, "Website"),
                ("A", "B", "a@example.com"),
                ("Ship",),
                ("Site", 1),
                (employee,),
                ("Main",),
                date,
                details,
            )
            for oid, status, event, employee, date, details in orders
        ],
        NESTED,
    )


def test_key_bytes(spark):
    key = spark.range(1).select(surrogate_key("totalcompany", F.lit("totalcompany"))).first()[0]
    assert key == "94oApQbHhWHO11T3iqMGLg=="


def test_key_of_null_is_null(spark):
    key = surrogate_key("location", F.lit(None).cast("string"))
    assert spark.range(1).select(key).first()[0] is None


@pytest.mark.parametrize(("number", "label"), [(0, "00"), (7, "07"), (99, "99"), (100, "00"), (105, "05")])
def test_sequence_label(spark, number, label):
    assert spark.range(1).select(sequence_label(F.lit(number))).first()[0] == label


@pytest.mark.parametrize("dtype", ["timestamp_ntz", "timestamp"])
def test_local_date_crosses_the_day(spark, dtype):
    df = spark.sql(f"SELECT cast('2021-03-01 05:00:00' AS {dtype}) AS ts")
    assert df.select(local_date(df, "ts", "America/Denver")).first()[0] == dt.date(2021, 2, 28)


def test_null_deleted_flag_counts_as_deleted(spark):
    table = spark.createDataFrame([(1, False), (2, True), (3, None)], "id int, is_deleted boolean")
    assert rows(sources.live_rows(table).select("id")) == [(1,)]


def test_zip_network_drops_missing_and_deleted(spark):
    zips = spark.createDataFrame(
        [("841", "F1", None), ("841", "F1", "F2"), ("842", "F9", "F3"), (None, "F1", "F2")],
        sources.ZIP_MAP_SCHEMA,
    )
    places = spark.createDataFrame(
        [("F1", "one", False), ("F2", "two", False), ("F3", "three", True)],
        "location_extid string, name string, is_deleted boolean",
    )
    found = network.zip_network(zips, places)
    one, two = (
        spark.range(1).select(surrogate_key("location", F.lit(n))).first()[0] for n in ("one", "two")
    )
    assert rows(found) == sorted(
        [("841", one, 1), ("841", two, 2), (None, one, 1), (None, two, 2)], key=repr
    )


def test_store_network_keeps_duplicates(spark):
    zips = spark.createDataFrame(
        [("841", "F1", 1)], "zip_code string, inv_loc_id string, priority int"
    )
    places = spark.createDataFrame(
        [
            ("m1", "84101", "Retail"),
            ("m1", "84101", "Retail"),
            ("m2", "84199", "Closeout"),
            ("m3", None, "Retail"),
        ],
        "member_id string, zipcode string, dc_po_type_location string",
    )
    assert rows(network.store_network(zips, places)) == [("m1", "F1", 1), ("m1", "F1", 1)]


def test_disabled_first_rule_hides_its_key(spark):
    rules = spark.createDataFrame(
        [("L", "g0", "s", None, None, None), ("L", "g1", "s", "b1", None, "Y"), ("L", "g2", "s", "b2", None, None)],
        RULES,
    )
    found = sizing.rule_lookup(rules, ["axis2", "optional_brand"])
    assert rows(found) == sorted([("L", None, "g0"), ("L", "b2", "g2")], key=repr)


def test_disabled_default_hides_its_axis(spark):
    rules = spark.createDataFrame(
        [("L", "g0", "s", None, None, "Y"), ("L", "g1", "s", "b1", None, None)], RULES
    )
    assert rows(sizing.rule_lookup(rules, ["axis2"])) == []


def test_size_group_precedence_and_fall_through(spark):
    rules = spark.createDataFrame(
        [
            ("L", "default", "s", None, None, None),
            ("L", "class", "s", None, "MC1", None),
            ("L", None, "s", "b1", None, None),
            ("L", "brand", "s", "b2", None, None),
        ],
        RULES,
    )
    products = spark.createDataFrame(
        [
            ("named by class", "L", "b1", "MC1", "G", False),
            ("named by brand", "L", "b2", "MC1", "G", False),
            ("named by axis", "L", "b9", "MC9", "G", False),
            ("no product group", "L", "b2", "MC1", None, False),
            ("no rule", "Z", "b2", "MC1", "G", False),
            ("excluded", "L", "b2", "MC1", "G", True),
            ("flag unknown", "L", "b2", "MC1", "G", None),
        ],
        "sku string, axis2value string, brandname string, merchandise_class string, "
        "productgroupdesc string, is_excluded boolean",
    )
    groups = sizing.sku_size_groups(products, rules)
    assert rows(groups) == sorted(
        [
            ("named by class", "L", "G class"),
            ("named by brand", "L", "G brand"),
            ("named by axis", "L", "G default"),
            ("no product group", "L", None),
            ("no rule", None, None),
        ],
        key=repr,
    )
    assert rows(sizing.size_groups(groups)) == [
        ("G brand", "L"), ("G class", "L"), ("G default", "L")
    ]


def test_open_orders_drop_closed_unknown_and_old(spark):
    day = dt.datetime(2021, 5, 1)
    df = nested(
        spark,
        (1, "Pending Fulfillment", "demand", "e1", day, []),
        (1, "Pending Fulfillment", "demand", "e2", day, []),
        (2, "BILLED", "demand", "e1", day, []),
        (3, None, "demand", "e1", day, []),
        (4, "Pending Fulfillment", "return", "e1", day, []),
        (5, "Pending Fulfillment", "demand", "e1", dt.datetime(2020, 12, 31, 23), []),
    )
    assert rows(backorder.open_orders(df, PARAMS).select("transaction_extid")) == [(1,)]


def test_units_multiply_by_order_rows_and_repeated_products(spark):
    units = spark.createDataFrame(
        [(1, "a", "backordered", False)] * 3
        + [(1, "b", "backordered", False), (1, "a", "filled", False), (1, "a", "backordered", True)]
        + [(1, None, "backordered", False), (9, "a", "backordered", False)],
        "order_number bigint, sku string, status string, is_deleted boolean",
    )
    orders = spark.createDataFrame(
        [(1, "Open", "Site", "Web", "x"), (1, "Open", "Site", "Web", "y"), (1, "Held", "Site", "Web", "x")],
        "transaction_extid bigint, transaction_status string, catalog string, order_source string, "
        "customer_email string",
    )
    products = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "sku string")
    found = backorder.backordered_units(units, orders, products, PARAMS)
    assert rows(found) == sorted(
        [
            (1, "a", "Site", "Web", 12),
            (1, "a", "Site", "Web", 6),
            (1, "b", "Site", "Web", 2),
            (1, "b", "Site", "Web", 1),
            (1, None, "Site", "Web", 2),
            (1, None, "Site", "Web", 1),
        ],
        key=repr,
    )


def test_flatten_keeps_orders_without_details(spark):
    day = dt.datetime(2021, 5, 1)
    df = nested(
        spark,
        (1, "Open", "demand", "e1", day, [("a", Decimal(1), Decimal(2)), ("b", Decimal(3), Decimal(4))]),
        (2, "Open", "demand", "e1", day, []),
        (3, "Open", "demand", "e1", day, None),
    )
    found = backorder.flatten_details(df).select("transaction_extid", "sku")
    assert rows(found) == sorted([(1, "a"), (1, "b"), (2, None), (3, None)], key=repr)


def test_demand_splits_by_hidden_employee_then_merges_equal_rows(spark):
    day = dt.datetime(2021, 5, 1)

    def order(oid, employee, quantity):
        return (oid, "Open", "demand", employee, day, [("a", Decimal(quantity), Decimal(10))])

    df = nested(
        spark, order(1, "e1", 2), order(1, "e2", 2), order(1, "e3", 5), order(2, "e1", 0), order(3, "e1", 1)
    )
    owed = spark.createDataFrame([(1, "a"), (2, "a")], "order_number bigint, sku string")
    found = backorder.demand_sales(backorder.flatten_details(df), owed, PARAMS)
    assert rows(found.select("order_number", F.col("demand_quantity").cast("int"))) == [(1, 2), (1, 5)]


def backorder_fixture(spark):
    owed = spark.createDataFrame(
        [(1, "a", "Site", "Web", 3), (2, "a", "Site", "Web", 1), (1, "b", "Site", "Web", 1), (1, "c", "Site", "Web", 1)],
        "order_number bigint, sku string, catalog string, order_source string, backordered_qty bigint",
    )
    totals = spark.createDataFrame(
        [
            (1, "a", "Main", Decimal(150), Decimal("0.05") * 5, dt.datetime(2021, 3, 1, 5)),
            (1, "b", "Main", Decimal(1), Decimal(1), dt.datetime(2021, 3, 1, 5)),
            (1, "c", "Main", Decimal(1), Decimal(1), dt.datetime(2021, 3, 1, 5)),
            (7, "a", "Main", Decimal(1), Decimal(1), dt.datetime(2021, 3, 1, 5)),
        ],
        "order_number bigint, sku string, catalog_name string, demand_quantity decimal(28,2), "
        "demand_sales decimal(28,2), orderline_date timestamp_ntz",
    )
    products = spark.createDataFrame(
        [("a", Decimal("1.5"), False), ("b", Decimal(1), True), ("c", Decimal(1), None)],
        "sku string, wholesale_price decimal(18,4), is_excluded boolean",
    )
    return owed, totals, products


def test_value_rounds_half_away_from_zero_and_keeps_local_date(spark):
    found = backorder.backorder_value(*backorder_fixture(spark), PARAMS).collect()
    assert len(found) == 1
    row = found[0]
    # 0.25 * 3 / 150 is exactly half a cent
    assert row.pending_backorder_v == Decimal("0.01")
    assert row.pending_backorder_c == Decimal("4.5000")
    assert row.orderline_date == dt.date(2021, 2, 28)
    assert (row.pending_backorder_u, row.sku) == (3, "a")


@pytest.mark.parametrize(
    ("sales", "quantity", "units", "value"),
    [
        ("50.00", "10001.00", 1, "0.00"),
        ("50.00", "10000.00", 1, "0.01"),
        ("-50.00", "10000.00", 1, "-0.01"),
        ("0.01", "0.03", 1, "0.33"),
        ("99999999999.99", "1.00", 3, "299999999999.97"),
    ],
)
def test_value_is_rounded_once(spark, sales, quantity, units, value):
    owed, totals, products = backorder_fixture(spark)
    owed = owed.filter("order_number = 1 AND sku = 'a'").withColumn("backordered_qty", F.lit(units).cast("bigint"))
    totals = totals.withColumns(
        {
            "demand_sales": F.lit(Decimal(sales)).cast("decimal(28,2)"),
            "demand_quantity": F.lit(Decimal(quantity)).cast("decimal(28,2)"),
        }
    )
    found = backorder.backorder_value(owed, totals, products, PARAMS).first()
    assert found.pending_backorder_v == Decimal(value)


def test_restricting_demand_first_changes_nothing(spark):
    owed, totals, products = backorder_fixture(spark)
    restricted = totals.join(owed.select("order_number", "sku"), ["order_number", "sku"], "left_semi")
    whole = backorder.backorder_value(owed, totals, products, PARAMS)
    part = backorder.backorder_value(owed, restricted, products, PARAMS)
    assert rows(whole) == rows(part)


def product(sku="AB-[S/M-1", **changes):
    base = {
        "sku": sku, "styleid": "s", "brandid": 1, "item_type": "inventory item", "skudesc": "x",
        "is_gso": False, "industry": "Outdoor", "netsuite_item_id": 1,
    }
    return tuple((base | changes).values())


@pytest.mark.parametrize(
    ("changes", "passes"),
    [
        ({}, True),
        ({"sku": "AB-c"}, False),
        ({"sku": "#"}, False),
        ({"styleid": None}, False),
        ({"brandid": 2}, False),
        ({"brandid": 3}, False),
        ({"brandid": 99}, True),
        ({"brandid": None}, True),
        ({"item_type": ""}, True),
        ({"item_type": None}, False),
        ({"item_type": "kit"}, False),
        ({"skudesc": None}, True),
        ({"skudesc": "unknown"}, False),
        ({"is_gso": None}, False),
        ({"is_gso": True}, False),
        ({"industry": None}, False),
        ({"industry": "Service & Labor"}, False),
        ({"netsuite_item_id": -5}, False),
        ({"netsuite_item_id": None}, True),
    ],
)
def test_eligibility(spark, changes, passes):
    brand = spark.createDataFrame(
        [("1", "Good", None), ("2", "Old - do not use", "PX"), ("3", "Other", "ZZZ")],
        "brand_extid string, brand_name string, prefix string",
    )
    df = spark.createDataFrame([product(**changes)], PRODUCT)
    assert (eligibility.eligible_skus(df, brand, EligibilityParams()).count() == 1) is passes


def test_flag_of_null_sku_and_repeated_source_rows(spark):
    products = spark.createDataFrame([("1", None), ("2", False), (None, False)], "sku string, is_excluded boolean")
    eligible = spark.createDataFrame([("1",), ("1",)], "sku string")
    flagged = eligibility.flag_excluded(products, eligible)
    assert rows(flagged) == sorted([("1", False), ("2", True), (None, True)], key=repr)
    assert rows(eligibility.flag_excluded(flagged, eligible)) == rows(flagged)


def location_frames(spark):
    catalog = spark.createDataFrame(
        [(1, "C1", "Flag", False), (2, "C2", "Side", False), (3, "C3", "Gone", True)],
        "catalog_id int, catalog_extid string, catalog_name string, is_deleted boolean",
    )
    source = spark.createDataFrame(
        [(1, "Website", False), (2, "eBay", False), (5, "Offline", False), (6, "Old", None)],
        "order_source_id int, order_source_name string, is_deleted boolean",
    )
    places = spark.createDataFrame(
        [
            (1, "S1", "Downtown", "Town", "UT", "84101-0001", dt.datetime(2020, 1, 1, 3), False),
            (2, "S2", "Mall", "Town", "UT", None, dt.datetime(2020, 1, 1, 12), False),
            (3, "S3", "Closed", "Town", "UT", "84103", dt.datetime(2020, 1, 1, 12), True),
            (4, "D1", "Centre", "City", "VA", "24073-0001", dt.datetime(2020, 1, 1, 12), False),
        ],
        "location_id int, location_extid string, name string, city string, state string, "
        "zipcode string, date_last_modified timestamp_ntz, is_deleted boolean",
    )
    classes = locations.location_classes(
        spark, {"S1": "Retail", "S2": "Closeout"}, {"D1": "Retail or Closeout"}, {"D1": "1"}, {}
    )
    return catalog, source, places, classes


def test_store_locations(spark):
    catalog, source, places, classes = location_frames(spark)
    params = LocationParams(flagship_catalog="Flag")
    stores = locations.store_locations(catalog, source, places, classes, [1, 2, 3], params)
    shown = stores.select(
        "member_name", "zipcode", "active_status", "store_open_date", "dc_po_type_location", "merch_location_group"
    )
    assert rows(shown) == sorted(
        [
            ("Flag-Offline-Downtown", "84101", "TRUE", dt.date(2019, 12, 31), "Retail", "Downtown"),
            ("Flag-Offline-Mall", None, "TRUE", dt.date(2020, 1, 1), "Closeout", "Mall"),
            ("Side-Offline", None, "FALSE", None, "Retail", "miscellaneous"),
            ("Side-Offline", None, "FALSE", None, "Closeout", "miscellaneous"),
        ],
        key=repr,
    )
    assert tuple(stores.columns) == locations.LOCATION_COLUMNS
    ids = spark.createDataFrame([(1,), (2,), (3,)], "location_id int")
    same = locations.store_locations(catalog, source, places, classes, ids, params)
    assert rows(same) == rows(stores)


def test_web_and_centre_locations(spark):
    catalog, source, places, classes = location_frames(spark)
    web = locations.web_locations(catalog, source, LocationParams(flagship_catalog="Flag"))
    assert rows(web.select("member_name", "active_status", "merch_location_group", "location_group")) == [
        ("Flag-Website", "TRUE", "Flag", "Flag-Website"),
        ("Flag-eBay", "FALSE", "Marketplace", "Flag-Marketplace"),
        ("Side-Website", "TRUE", "Side", "Side-Website"),
        ("Side-eBay", "FALSE", "Marketplace", "Side-Marketplace"),
    ]
    centres = locations.dc_locations(places, classes, [4, 2])
    assert rows(centres.select("member_name", "loc_level", "zipcode", "dc_po_type_location", "dc_flag", "vdc_flag")) == [
        ("Centre", "DC_VDC", "24073", "Retail or Closeout", "1", "0"),
        ("Mall", "DC_VDC", None, "Unknown", "0", "0"),
    ]


def test_levels_leave_out_centres_and_repeat_channels(spark):
    catalog, source, places, classes = location_frames(spark)
    params = LocationParams(flagship_catalog="Flag", company_name="All")
    channels = locations.selling_channels(catalog, source)
    table = locations.location_table(
        locations.store_locations(catalog, source, places, classes, [1], params),
        locations.web_locations(catalog, source, params),
        locations.dc_locations(places, classes, [4]),
    )
    members = levels.location_levels(locations.catalog_members(catalog), channels, table, "All")
    counts = {r.loc_level: r["count"] for r in members.groupBy("loc_level").count().collect()}
    assert counts == {
        "totalcompany": 1, "channel": 1, "catalog": 3, "selling_channel": 7, "area": 7,
        "region": 7, "district": 7, "account": 7, "location": 7,
    }
    attributes = locations.location_attributes(table)
    assert len(attributes.columns) == 37
    assert attributes.filter("member_name = 'Centre'").count() == 1


def test_combine_takes_each_field_from_the_first_source_that_has_it(spark):
    schema = "sku string, name string, price int"
    first = spark.createDataFrame([("a", None, 1), ("b", "B", None), (None, "x", 1)], schema)
    second = spark.createDataFrame([("a", "A", 9), ("c", "C", 3), (None, "y", 2)], schema)
    combined = product_history.combine_sources([first, second])
    assert rows(combined) == sorted(
        [("a", "A", 1), ("b", "B", None), ("c", "C", 3)], key=repr
    )
    assert rows(product_history.keyless_rows([first, second])) == [(2,)]


def test_track_changes_is_null_safe_and_leaves_closed_rows(spark):
    start = dt.datetime(2021, 1, 1)
    base = spark.createDataFrame([("a", 1), ("b", None), ("c", 3), ("d", 4)], "sku string, price int")
    dimension = product_history.start_history(base, start)
    source = spark.createDataFrame([("a", 2), ("b", None), ("c", None)], "sku string, price int")
    once = product_history.track_changes(dimension, source, ["price"], RUN)
    assert rows(once) == sorted(
        [
            ("a", 1, start, RUN, False), ("a", 2, RUN, None, True), ("b", None, start, None, True),
            ("c", 3, start, RUN, False), ("c", None, RUN, None, True), ("d", 4, start, None, True),
        ],
        key=repr,
    )
    again = product_history.track_changes(once, source, ["price"], RUN + dt.timedelta(days=1))
    assert rows(again) == rows(once)


def test_type1_insert_and_delete(spark):
    start = dt.datetime(2021, 1, 1)
    schema = "sku string, name string"
    base = spark.createDataFrame([("a", "A"), ("b", "B")], schema)
    dimension = product_history.start_history(base, start)
    source = spark.createDataFrame([("a", None), ("c", "C")], schema)
    over = product_history.overwrite_current(dimension, source, ["name"])
    assert rows(over.select("sku", "name")) == sorted([("a", None), ("b", "B")], key=repr)
    grown = product_history.insert_new(dimension, source, RUN)
    assert rows(grown.select("sku", "valid_from")) == [("a", start), ("b", start), ("c", RUN)]
    marked = product_history.mark_deleted(grown, source)
    assert rows(marked.select("sku", "is_deleted")) == [("a", False), ("b", True), ("c", False)]
    kept = product_history.mark_deleted(marked, base)
    assert rows(kept.select("sku", "is_deleted")) == [("a", False), ("b", False), ("c", True)]
    nameless = spark.createDataFrame([(None, "x")], schema)
    assert product_history.new_rows(grown, nameless, RUN).isEmpty()


def test_closed_rows_keep_their_flag(spark):
    schema = "sku string, is_current boolean, is_deleted boolean"
    versions = spark.createDataFrame([("a", False, True), ("a", True, True), ("b", False, False)], schema)
    marked = product_history.mark_deleted(versions, spark.createDataFrame([("a",)], "sku string"))
    assert rows(marked) == [("a", False, True), ("a", True, False), ("b", False, False)]


def test_upsert_twice_is_upsert_once(spark):
    schema = "store_id bigint, sku string, quantity bigint, as_of date"
    old, new = dt.date(2021, 1, 1), dt.date(2021, 1, 2)
    stock = spark.createDataFrame([(1, "a", 5, old), (1, "b", 6, new)], schema)
    snapshot = spark.createDataFrame([(1, "a", 7, new), (1, "b", 1, old), (2, "a", 1, new)], schema)
    once = inventory.upsert_snapshot(stock, snapshot)
    assert rows(once) == [(1, "a", 7, new), (1, "b", 6, new), (2, "a", 1, new)]
    assert rows(inventory.upsert_snapshot(once, snapshot)) == rows(once)


def test_delta_has_changed_new_and_vanished_keys(spark):
    schema = "store_id bigint, sku string, quantity bigint"
    before = spark.createDataFrame([(1, "same", 5), (1, "changed", 5), (1, "gone", 5)], schema)
    after = spark.createDataFrame([(1, "same", 5), (1, "changed", 6), (1, "new", 0)], schema)
    assert rows(inventory.snapshot_delta(before, after)) == [
        (1, "changed", 6), (1, "gone", 0), (1, "new", 0)
    ]


def test_daily_refreshes_equal_a_full_one(spark):
    days = [dt.date(2021, 1, d) for d in range(1, 11)]
    lines = spark.createDataFrame(
        [(day, 1, sku, i + 1, Decimal(i)) for i, day in enumerate(days) for sku in ("a", "b", "a")],
        "fact_date date, location_id int, sku string, units bigint, value decimal(18,2)",
    )
    full = facts.refreshed_fact(None, lines, "full", days[-1])
    table = facts.refreshed_fact(None, lines.filter(F.col("fact_date") == F.lit(days[0])), "full", days[0])
    for day in days[1:]:
        table = facts.refreshed_fact(table, lines, "daily", day)
    assert rows(table) == rows(full)
    styles = facts.refreshed_fact(
        None, lines.withColumn("style", F.lit("s")), "full", days[-1], keys=facts.STYLE_KEYS
    )
    assert styles.columns == ["fact_date", "location_id", "style", "units", "value"] and styles.count() == 10
    assert facts.refresh_window("weekly", days[-1]) == dt.date(2020, 12, 14)
    late = facts.refreshed_fact(
        facts.refreshed_fact(None, lines.filter("sku = 'a'"), "full", days[-1]), lines, "incremental", days[-1]
    )
    recent = F.col("fact_date") > F.lit(days[2])
    assert rows(late.filter(recent)) == rows(full.filter(recent))
    with pytest.raises(ValueError, match="unknown refresh mode"):
        facts.refresh_window("hourly", days[0])


def test_rejects_count_each_row_once(spark):
    feed = spark.createDataFrame(
        [(1, "x"), (1, "x"), (2, "x"), (3, "?"), (None, "x"), (4, None), (5, "x"), (5, "?")],
        "id int, ref string",
    )
    known = spark.createDataFrame([("x",), ("x",)], "name string")
    check = quality.FeedCheck("feed", feed, ["id"], {"ref": known})
    clean = quality.FeedCheck("clean", feed.filter("id = 2"), ["id"], {"ref": known})
    empty = quality.FeedCheck("empty", feed.filter("id = 0"), ["id"], {"ref": known})
    summary = quality.reject_summary([check, clean, empty])
    assert rows(summary) == [("clean", 0), ("empty", 0), ("feed", 7)]
    assert rows(quality.rejected_feeds(summary)) == [("feed",)]
    assert not quality.is_clean(summary)
    assert quality.is_clean(summary.filter("interface_name <> 'feed'"))
