"""Whole runs over the small tables."""

from __future__ import annotations

import datetime as dt

from conftest import SMALL
from pyspark.sql import functions as F

from checks.fixtures import BACKORDER_PARAMS, ELIGIBILITY_PARAMS, LOCATION_PARAMS, Tables
from shelfcast import sinks
from shelfcast.operators.product_history import start_history
from shelfcast.plans import planning_feeds, planning_rejects, product_dimension_run
from shelfcast.sources import live_rows

RUN = dt.datetime(2021, 10, 14, 6, 45)
START = dt.datetime(2021, 1, 1)


def test_planning_run(spark, tmp_path):
    t = Tables(spark, SMALL)
    feeds = planning_feeds(t.inputs, LOCATION_PARAMS, BACKORDER_PARAMS, str(tmp_path / "tables"), RUN)
    manifest = {r.filename: r["count"] for r in sinks.export_run(feeds, str(tmp_path / "out"), RUN).collect()}
    assert manifest == {
        sinks.feed_file_name(name, RUN): sinks.read_feed(
            spark, f"{tmp_path}/out/20211014064500/{name}", df.schema
        ).count()
        for name, df in feeds.items()
    }
    assert manifest["FEED_20211014064500_backorder_sales.DAT"] > 0
    rejects = {r.interface_name: r.reject_count for r in planning_rejects(feeds, live_rows(t.catalog), t.locations).collect()}
    assert rejects["location_attributes"] == 0


def test_product_dimension_run(spark, tmp_path):
    t = Tables(spark, SMALL)
    products = t.raw_products
    first = products.filter("merchandise_class <> 'MC1'")
    second = products.filter("merchandise_class <> 'MC2'").withColumn(
        "wholesale_price", (F.col("wholesale_price") + F.when(F.col("brandid") < 9, 1).otherwise(0)).cast("decimal(18,4)")
    ).withColumn("industry", F.coalesce("industry", F.lit("Outdoor")))
    dimension = start_history(first, START)

    def run(table, sources, name, at):
        return product_dimension_run(
            table, sources, t.brand, ["wholesale_price"], ["industry", "skudesc"],
            str(tmp_path / name), at, ELIGIBILITY_PARAMS,
        )

    result = run(dimension, [second], "one", RUN)
    versions = result.groupBy("sku").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("is_current").cast("int")).alias("n_current")
    )
    assert versions.filter("n_current <> 1 OR n > 2").isEmpty()
    both = first.join(second.select("sku"), "sku")
    assert versions.filter("n = 2").count() == both.filter("brandid < 9").count()
    assert result.filter("valid_to IS NOT NULL AND is_current").isEmpty()
    assert result.filter("is_deleted").select("sku").distinct().count() == (
        first.join(second.select("sku"), "sku", "left_anti").count()
    )
    current = result.filter("is_current AND NOT is_deleted")
    assert current.select(second.columns).exceptAll(second).isEmpty()
    assert second.exceptAll(current.select(second.columns)).isEmpty()
    again = run(result, [second], "two", RUN + dt.timedelta(days=1))
    assert again.select(result.columns).exceptAll(result).isEmpty() and again.count() == result.count()
