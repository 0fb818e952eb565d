"""Merges that rewrite only what they touch: buckets, months of late lines, histories, pointers."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from checks.fixtures import ELIGIBILITY_PARAMS, Tables
from shelfcast import sinks
from shelfcast.operators import eligibility, facts, inventory, product_history
from shelfcast.plans import merge_events, merge_exclusions, product_dimension_merge, product_dimension_run

START, RUN = dt.datetime(2021, 1, 1), dt.datetime(2021, 10, 14, 6, 45)


def files(path, folder="bucket"):
    """Data files and their times, by bucket."""
    found = {}
    for name in glob.glob(f"{path}/{folder}=*/*.parquet"):
        number = name.split(f"{folder}=")[1].split("/")[0]
        found.setdefault(number, set()).add((os.path.basename(name), os.stat(name).st_mtime_ns))
    return found


def changed(before, after):
    return {b for b in before.keys() | after.keys() if before.get(b) != after.get(b)}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def stock(spark, tmp_path):
    rows = spark.range(200).select(F.concat(F.lit("s"), "id").alias("sku"), (F.col("id") * 2).alias("n"))
    rows = rows.unionByName(spark.sql("SELECT cast(null AS string) AS sku, 7L AS n"))
    table = sinks.BucketTable(str(tmp_path / "stock"), rows.schema, ("sku",), 8)
    table.create(rows)
    return table


def test_one_changed_key_rewrites_one_bucket(spark, stock):
    before, rows = files(stock.path), rows_of(stock.read(spark))
    change = spark.sql("SELECT 's17' AS sku")
    raised = lambda df, only: df.withColumn("n", F.when(F.col("sku") == "s17", -1).otherwise(F.col("n")).cast("long"))
    only = sinks.merge_buckets(stock, change, raised)
    assert len(only) == 1 and changed(before, files(stock.path)) == {str(only[0])}
    assert rows_of(stock.read(spark)) == sorted([r if r[0] != "s17" else ("s17", -1) for r in rows], key=str)


def test_no_change_rewrites_nothing_and_null_keys_have_a_bucket(spark, stock):
    before = files(stock.path)
    assert sinks.merge_buckets(stock, stock.read(spark).limit(0), lambda df, only: df) == []
    assert files(stock.path) == before
    null = stock.read(spark).where("sku IS NULL")
    assert null.count() == 1
    only = sinks.merge_buckets(stock, null, lambda df, only: df.where("sku IS NOT NULL"))
    assert len(only) == 1 and stock.read(spark).where("sku IS NULL").isEmpty()
    assert stock.read(spark).count() == 200


def test_a_bucket_that_lost_its_rows_is_emptied(spark, stock):
    only = sinks.merge_buckets(stock, spark.sql("SELECT 's3' AS sku"), lambda df, only: df.limit(0))
    left = stock.read(spark)
    assert left.where(stock.bucket().isin(only)).isEmpty() and 0 < left.count() < 201


def test_only_touched_buckets_are_in_the_scan(spark, stock):
    for name in glob.glob(f"{stock.path}/bucket=[0-35-7]/*.parquet"):
        os.truncate(name, 3)  # no reader gets past this
    assert stock.read(spark, [4]).count() > 0


def test_flags_are_merged_by_bucket(spark, tmp_path):
    t = Tables(spark, SMALL)
    rows = eligibility.flag_excluded(t.raw_products, eligibility.eligible_skus(t.raw_products, t.brand, ELIGIBILITY_PARAMS))
    table = sinks.BucketTable(str(tmp_path / "products"), rows.schema, ("sku",), 12)
    table.create(rows)
    expected = rows_of(rows.select("sku", "is_excluded"))
    assert merge_exclusions(table, t.brand, ELIGIBILITY_PARAMS) == []
    sku = table.read(spark).where("NOT is_excluded").select("sku").orderBy("sku").first()[0]
    turned = F.when(F.col("sku") == sku, ~F.col("is_excluded")).otherwise(F.col("is_excluded"))
    table.create(rows.withColumn("is_excluded", turned))
    before = files(table.path)
    only = merge_exclusions(table, t.brand, ELIGIBILITY_PARAMS)
    assert len(only) == 1 and changed(before, files(table.path)) == {str(only[0])}
    assert rows_of(table.read(spark).select("sku", "is_excluded")) == expected


def test_dimension_merge_equals_the_run_and_can_be_repeated(spark, tmp_path):
    t = Tables(spark, SMALL)
    products = t.raw_products
    first = product_history.start_history(products.where("merchandise_class <> 'MC1'"), START)
    first = first.withColumn("is_deleted", F.lit(False))
    first = eligibility.flag_excluded(first, eligibility.eligible_skus(first, t.brand, ELIGIBILITY_PARAMS))
    source = products.where("merchandise_class <> 'MC2'").withColumn(
        "wholesale_price", (F.col("wholesale_price") + F.when(F.col("brandid") < 9, 1).otherwise(0)).cast("decimal(18,4)")
    )
    columns = (["wholesale_price"], ["skudesc"])
    table = sinks.BucketTable(str(tmp_path / "dimension"), first.schema, ("sku",), 16)
    table.create(first)
    assert product_dimension_merge(table, [source], t.brand, *columns, str(tmp_path / "a"), RUN, ELIGIBILITY_PARAMS)
    expected = product_dimension_run(first, [source], t.brand, *columns, str(tmp_path / "b"), RUN, ELIGIBILITY_PARAMS)
    assert rows_of(table.read(spark)) == rows_of(expected.select(*first.columns))
    before = files(table.path)
    later = RUN + dt.timedelta(days=1)
    assert product_dimension_merge(table, [source], t.brand, *columns, str(tmp_path / "c"), later, ELIGIBILITY_PARAMS) == []
    one = source.withColumn("skudesc", F.when(F.col("sku") == source.select(F.max("sku")).first()[0], "new").otherwise(F.col("skudesc")))
    later += dt.timedelta(days=1)
    only = product_dimension_merge(table, [one], t.brand, *columns, str(tmp_path / "d"), later, ELIGIBILITY_PARAMS)
    assert len(only) == 1 and changed(before, files(table.path)) == {str(only[0])}


def test_snapshots_are_compared_by_digest(spark, tmp_path):
    t = Tables(spark, SMALL)
    before = t.inventory_before
    sku, store = before.select(F.max("sku"), F.max("store_id")).first()
    one = (F.col("sku") == sku) | (F.col("store_id") == store) & (F.col("quantity") < 0)
    after = before.withColumn("quantity", F.when(one, F.col("quantity") + 1).otherwise(F.col("quantity")).cast("long"))
    a, b = (
        sinks.store_snapshot(df, str(tmp_path / name), inventory.STORE_SKU, 64)
        for name, df in (("a", before), ("b", after.orderBy(F.desc("sku"))))
    )
    expected = rows_of(inventory.snapshot_delta(before, after))
    only = sinks.differing_buckets(a, b)
    assert 0 < len(only) < 32
    for path in (a.table.path, b.table.path):  # the other buckets are never opened
        for name in glob.glob(f"{path}/bucket=*/*.parquet"):
            if int(name.split("bucket=")[1].split("/")[0]) not in only:
                os.truncate(name, 3)
    assert rows_of(sinks.compare_snapshots(a, b, inventory.snapshot_delta)) == expected
    assert sinks.differing_buckets(a, a) == []
    with pytest.raises(ValueError):
        sinks.differing_buckets(a, sinks.Snapshot(sinks.BucketTable("x", before.schema, ("sku",), 64), a.digests))


LINE = "fact_date date, location_id long, sku string, units long, value decimal(18,2), arrived_at timestamp_ntz"


def line(day, units, arrived, sku="a"):
    return (dt.date(2021, *day), 1, sku, units, None, dt.datetime(2021, *arrived))


def test_late_lines_are_added_once(spark, tmp_path):
    base = str(tmp_path / "fact")
    lines = spark.createDataFrame(
        [line((1, 5), 1, (1, 6)), line((1, 5), 2, (2, 20)), line((2, 1), 4, (2, 3)), line((3, 1), 8, (3, 2)),
         line((1, 9), 16, (3, 3), "b"), line((1, 5), 32, (9, 9)), (dt.date(2021, 1, 5), 1, "a", 64, None, None)],
        LINE,
    )
    cuts = [dt.datetime(2021, 2, 10), dt.datetime(2021, 2, 25), dt.datetime(2021, 3, 5)]
    assert sinks.load_arrivals(lines, base, "1", cuts[0], None) == [dt.date(2021, 1, 1), dt.date(2021, 2, 1)]
    since = sinks.high_water_mark(spark, base, ["1"])
    assert since == cuts[0] and sinks.high_water_mark(spark, base, []) is None
    before = files(f"{base}/fact", "fact_month")
    assert sinks.load_arrivals(lines, base, "2", cuts[1], since) == [dt.date(2021, 1, 1)]
    assert changed(before, files(f"{base}/fact", "fact_month")) == {"2021-01-01"}
    # the mark of the second run is lost: the months know how far they are
    assert sinks.load_arrivals(lines, base, "3", cuts[2], cuts[0]) == [dt.date(2021, 1, 1), dt.date(2021, 3, 1)]
    seen = lines.where(F.col("arrived_at") <= F.lit("2021-03-05").cast("timestamp_ntz"))
    assert rows_of(sinks.read_fact(lines, base)) == rows_of(facts.fact_rollup(seen))
    assert sinks.high_water_mark(spark, base, ["1", "2", "3"]) == cuts[2]
    assert sinks.load_arrivals(lines, base, "4", cuts[2], cuts[2]) == []


EVENT = "sku string, effective_at timestamp_ntz, delivered long, price long"


def test_history_does_not_depend_on_the_order_of_delivery(spark, tmp_path):
    at = lambda day: dt.datetime(2021, 1, day)
    said = [("a", at(1), 1, 5), ("a", at(9), 2, 5), ("a", at(5), 3, 6), ("a", at(5), 4, 7), ("b", at(2), 1, None),
            ("b", at(3), 2, 1), ("b", at(1), 9, None), ("c", None, 1, 1), (None, at(1), 1, 2), ("a", at(1), 1, 5)]
    results = []
    for name, order in (("in", sorted(said, key=lambda e: (e[1] or at(1), e[2]))), ("out", said[::-1]), ("as", said)):
        schema = spark.createDataFrame([], EVENT).schema
        events = sinks.BucketTable(str(tmp_path / name / "events"), schema, ("sku",), 4)
        none = spark.createDataFrame([], EVENT)
        empty = product_history.history_of_events(none, "sku", ["price"])
        history = sinks.BucketTable(str(tmp_path / name / "history"), empty.schema, ("sku",), 4)
        events.create(none)
        history.create(empty)
        for i in range(0, len(order), 3):
            part = spark.createDataFrame(order[i : i + 3], EVENT)
            merge_events(events, history, part, "sku", ["price"])
            merge_events(events, history, part, "sku", ["price"])  # a repeated run changes nothing
        results.append(rows_of(history.read(spark)))
    assert results[0] == results[1] == results[2]
    assert [r for r in results[0] if r[0] == "a"] == [
        ("a", 5, at(1), at(5), False), ("a", 5, at(9), None, True), ("a", 7, at(5), at(9), False),
    ]
    assert [r for r in results[0] if r[0] == "b"] == [("b", 1, at(3), None, True), ("b", None, at(1), at(3), False)]


def test_readers_keep_the_old_run_while_a_publish_fails(spark, tmp_path):
    name, base = "pointed_rows", str(tmp_path / "rows")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    first = sinks.publish_pointed(spark.range(3).selectExpr("id", "'a' AS x"), name, base, "1")
    assert rows_of(first) == [(i, "a") for i in range(3)]
    failing = spark.range(9).selectExpr("id", "if(id = 8, raise_error('broken'), 'b') AS x")
    with pytest.raises(Exception, match="broken"):
        sinks.publish_pointed(failing, name, base, "2")
    assert rows_of(spark.table(name)) == [(i, "a") for i in range(3)]
    sinks.publish_pointed(spark.range(2).selectExpr("id", "'c' AS x"), name, base, "3")
    assert rows_of(spark.table(name)) == [(0, "c"), (1, "c")]
    with pytest.raises(ValueError):
        sinks.publish_pointed(spark.range(2), name, base, "4")
    spark.sql(f"DROP TABLE {name}")


def test_rejected_rows_are_kept_apart_with_their_reasons(spark, tmp_path):
    from shelfcast.operators import quality

    rows = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "x"), ("b", 1, "y"), ("c", 9, "x"), (None, 1, "x"), (None, 1, "x"), ("d", None, "z"),
         ("e", 2, "x"), ("f", 9, "y"), ("f", 9, "y")],
        "k string, ref int, other string",
    )
    known = spark.createDataFrame([(1,), (2,)], "id int")
    feed = quality.FeedCheck("feed", rows, ["k"], {"ref": known})
    path = sinks.split_feed(feed, str(tmp_path), "run")
    good = sinks.split_rows(spark, path, rows.schema, accepted=True)
    bad = sinks.split_rows(spark, path, rows.schema, accepted=False)
    assert rows_of(good) == [("b", 1, "y"), ("e", 2, "x")]
    assert bad.count() == quality.feed_rejects(feed).first()["reject_count"] == 8
    labels = {(r.k, r.ref): r.reject_bits for r in bad.collect()}
    assert labels == {("a", 1): 4, ("a", 2): 4, ("c", 9): 2, (None, 1): 1, ("d", None): 1, ("f", 9): 6}
    by_rule = {r.rule: r.reject_count for r in quality.rejects_by_rule(feed, bad).collect()}
    assert by_rule == {"unknown_key": 3, "not_in_ref": 3, "repeated_key": 4}
    assert quality.reject_rules(quality.FeedCheck("f", rows, ["k"], unique=False)) == ["unknown_key"]
    none = quality.FeedCheck("none", rows.limit(0), ["k"], {"ref": known})
    assert sinks.split_rows(spark, sinks.split_feed(none, str(tmp_path), "none"), rows.schema, True).isEmpty()


def test_a_history_is_written_once_and_emptied_where_no_event_has_a_time(spark, tmp_path, monkeypatch):
    schema = spark.createDataFrame([], EVENT).schema
    events = sinks.BucketTable(str(tmp_path / "events"), schema, ("sku",), 4)
    stale = spark.createDataFrame([("a", dt.datetime(2021, 1, 1), 1, 5), ("b", dt.datetime(2021, 1, 1), 1, 5)], EVENT)
    versions = product_history.history_of_events(stale, "sku", ["price"])
    history = sinks.BucketTable(str(tmp_path / "history"), versions.schema, ("sku",), 4)
    events.create(spark.createDataFrame([], EVENT))
    history.create(versions)
    stored, stage = [], sinks.buckets.stage_table
    monkeypatch.setattr(sinks.buckets, "stage_table", lambda df, *where: stored.append(df.columns) or stage(df, *where))
    untimed = spark.createDataFrame([("a", None, 1, 5)], EVENT)
    only = merge_events(events, history, untimed, "sku", ["price"])
    assert stored == [events.schema.names]
    kept = [r for r in rows_of(versions.withColumn("b", history.bucket())) if r[-1] not in only]
    assert rows_of(history.read(spark)) == [r[:-1] for r in kept] and rows_of(events.read(spark)) == rows_of(untimed)
