"""Rewritten operators against the plain formulation, on random rows with repeats and NULLs."""

from __future__ import annotations

import datetime as dt
import random
from functools import reduce

import pytest
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators import backorder, inventory, locations, product_history, quality
from shelfcast.params import BackorderParams, LocationParams

PARAMS = BackorderParams()


def rows(df: DataFrame):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def some(rng: random.Random, values, p_null=0.1):
    return None if rng.random() < p_null else rng.choice(values)


@pytest.mark.parametrize("seed", [1, 2])
def test_counted_units_equal_the_counted_join(spark, seed):
    rng = random.Random(seed)
    units = spark.createDataFrame(
        [
            (
                rng.randint(1, 12),
                some(rng, "abcd"),
                rng.choice(["backordered", "filled"]),
                some(rng, [False, False, True]),
            )
            for _ in range(300)
        ],
        "order_number bigint, sku string, status string, is_deleted boolean",
    )
    orders = spark.createDataFrame(
        {
            (rng.randint(1, 15), some(rng, ["Open", "Held"]), some(rng, "XY"), "Web", rng.choice("pqr"))
            for _ in range(60)
        },
        "transaction_extid bigint, transaction_status string, catalog string, "
        "order_source string, customer_email string",
    )
    products = spark.createDataFrame([(some(rng, "abc"),) for _ in range(6)], "sku string")
    plain = (
        units.filter("status = 'backordered' AND NOT is_deleted")
        .join(orders, F.col("order_number") == F.col("transaction_extid"))
        .join(products.select(F.col("sku").alias("p_sku")), F.col("sku") == F.col("p_sku"), "left")
        .groupBy("order_number", "sku", "transaction_status", "catalog", "order_source")
        .agg(F.count(F.lit(1)).alias("backordered_qty"))
        .drop("transaction_status")
    )
    assert rows(backorder.backordered_units(units, orders, products, PARAMS)) == rows(plain)


def test_store_rows_equal_the_distinct_product(spark):
    rng = random.Random(3)
    catalog = spark.createDataFrame(
        [(i, f"C{i}", name, False) for i, name in enumerate(["Flag", "Side", None, "Flag"])],
        "catalog_id int, catalog_extid string, catalog_name string, is_deleted boolean",
    )
    source = spark.createDataFrame(
        [(1, "Website", False), (5, "Offline", False)],
        "order_source_id int, order_source_name string, is_deleted boolean",
    )
    places = spark.createDataFrame(
        [
            (i, f"S{i}", some(rng, ["North", "South"]), "Town", "UT", some(rng, ["84101-1"]),
             dt.datetime(2020, 1, i + 1, 3), i == 7)
            for i in range(10)
        ],
        "location_id int, location_extid string, name string, city string, state string, "
        "zipcode string, date_last_modified timestamp_ntz, is_deleted boolean",
    )
    classes = locations.location_classes(
        spark, {f"S{i}": rng.choice(["Retail", "Closeout"]) for i in range(8)}, {}, {}, {}
    )
    params = LocationParams(flagship_catalog="Flag")
    found = locations.store_locations(catalog, source, places, classes, list(range(9)), params)
    flagship = F.col("catalog_name") == "Flag"
    channel = F.concat("catalog_name", F.lit("-"), "order_source_name")
    named = F.when(flagship, F.concat(channel, F.lit("-"), "name")).otherwise(channel)
    plain = (
        catalog.drop("is_deleted")
        .crossJoin(source.drop("is_deleted"))
        .filter("order_source_name = 'Offline'")
        .crossJoin(
            locations.with_location_classes(places.filter("NOT is_deleted AND location_id < 9"), classes)
        )
        .select(
            named.alias("member_name"),
            "catalog_extid",
            F.when(flagship, F.col("name")).otherwise("miscellaneous").alias("merch"),
            F.when(flagship, F.col("city")).alias("city"),
            F.when(flagship, F.substring("zipcode", 1, 5)).alias("zipcode"),
            F.when(flagship, "TRUE").otherwise("FALSE").alias("active_status"),
            F.when(flagship, F.date_sub(F.to_date("date_last_modified"), 1)).alias("opened"),
            "store_po_type",
        )
        .distinct()
    )
    shown = found.select(
        "member_name",
        "catalog_id",
        "merch_location_group",
        "city",
        "zipcode",
        "active_status",
        "store_open_date",
        "dc_po_type_location",
    )
    assert rows(shown) == rows(plain)


def test_combined_sources_equal_the_full_outer_join(spark):
    rng = random.Random(4)
    schema = "sku string, name string, price int"

    def source():
        keys = rng.sample([f"s{i}" for i in range(40)], 25)
        return spark.createDataFrame(
            [(k, some(rng, "xyz", 0.3), some(rng, [1, 2], 0.3)) for k in keys], schema
        )

    frames = [source(), source(), source()]

    def fill(first, second):
        return first.alias("a").join(second.alias("b"), "sku", "full_outer").select(
            "sku", *[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in ("name", "price")]
        )

    assert rows(product_history.combine_sources(frames)) == rows(reduce(fill, frames))


def test_delta_equals_the_full_outer_join(spark):
    rng = random.Random(5)
    schema = "store_id bigint, sku string, quantity bigint"

    def snapshot():
        keys = rng.sample([(s, k) for s in range(4) for k in "abcdefgh"], 20)
        return spark.createDataFrame([(*k, rng.randint(0, 2)) for k in keys], schema)

    before, after = snapshot(), snapshot()
    plain = (
        before.alias("b")
        .join(after.alias("a"), ["store_id", "sku"], "full_outer")
        .filter("NOT (a.quantity <=> b.quantity)")
        .select("store_id", "sku", F.coalesce("a.quantity", F.lit(0)))
    )
    assert rows(inventory.snapshot_delta(before, after)) == rows(plain)


def test_rejects_equal_the_row_by_row_check(spark):
    rng = random.Random(6)
    feed = spark.createDataFrame(
        [(some(rng, range(150)), some(rng, "abcde")) for _ in range(200)], "id int, ref string"
    )
    known = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "ref string")
    per_key = F.count(F.lit(1)).over(Window.partitionBy("id"))
    plain = feed.withColumn("n", per_key).filter(
        "n > 1 OR id IS NULL OR ref IS NULL OR ref NOT IN ('a', 'b')"
    )
    check = quality.FeedCheck("feed", feed, ["id"], {"ref": known})
    assert quality.feed_rejects(check).first().reject_count == plain.count()


def test_history_has_one_current_row_and_no_overlap_after_any_runs(spark):
    rng = random.Random(7)
    schema = "sku string, price int, name string"

    def source():
        keys = rng.sample([f"s{i}" for i in range(30)], 20)
        return spark.createDataFrame(
            [(k, some(rng, [1, 2, 3]), some(rng, "xy")) for k in keys], schema
        )

    dimension = product_history.start_history(source(), dt.datetime(2021, 1, 1))
    for day in range(2, 5):
        delivered = source()
        run = dt.datetime(2021, 1, day)
        changed = product_history.track_changes(dimension, delivered, ["price"], run)
        over = product_history.overwrite_current(changed, delivered, ["name"])
        dimension = product_history.insert_new(over, delivered, run)
        current = dimension.filter("is_current")
        assert current.count() == current.select("sku").distinct().count()
        assert delivered.exceptAll(current.select("sku", "price", "name")).isEmpty()
    by_sku = Window.partitionBy("sku").orderBy("valid_from")
    chained = dimension.withColumn("next_from", F.lead("valid_from").over(by_sku))
    assert chained.filter("NOT (valid_to <=> next_from)").isEmpty()
    assert chained.filter("is_current <> (valid_to IS NULL)").isEmpty()
