"""Round trips through files."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from shelfcast import sinks, sources
from shelfcast.plans import store_inventory_run
from shelfcast.session import held_settings, scratch_path

RUN = dt.datetime(2021, 10, 14, 6, 45)
TEXT = "key string, value string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def data_files(path):
    return [os.path.join(d, f) for d, _, files in os.walk(path) for f in files if f.startswith("part-")]


def write_text(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_staged_csv_reads_empty_fields_as_null(spark, tmp_path):
    path = write_text(tmp_path, "zip.csv", 'ZIPCODE,OPTIMAL_FACILITY,BACKUP\n841,"",F3\n842,F1,\n')
    staged = sources.stage_csv(spark, path, sources.ZIP_MAP_SCHEMA, str(tmp_path / "stage"), "r1")
    assert rows(staged) == sorted([("841", None, "F3"), ("842", "F1", None)], key=repr)


@pytest.mark.parametrize("line", ["841,F1", "841,F1,F2,F3"])
def test_jagged_row_fails(spark, tmp_path, line):
    path = write_text(tmp_path, "zip.csv", f"ZIPCODE,OPTIMAL_FACILITY,BACKUP\n{line}\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        sources.read_typed_csv(spark, path, sources.ZIP_MAP_SCHEMA).select("zipcode").collect()


def test_feed_round_trip_keeps_text(spark, tmp_path):
    values = ['q"x', "a|b", " padded ", "plain", None, ""]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], TEXT)
    path, count = sinks.export_feed(df, str(tmp_path), "Text", RUN)
    back = sinks.read_feed(spark, path, TEXT)
    # an empty text is written as "" and read as NULL, as consumers of the feed do
    expected = [(str(i), v or None) for i, v in enumerate(values)]
    assert count == len(values) and rows(back) == sorted(expected, key=repr)
    text = "".join(open(f).read() for f in data_files(path))
    assert '"q""x"' in text and "key|value" in text and path.endswith("/20211014064500/Text")


def test_empty_feed_has_a_header_and_count_zero(spark, tmp_path):
    df = spark.createDataFrame([], TEXT)
    path, count = sinks.export_feed(df, str(tmp_path), "Empty", RUN)
    assert count == 0
    assert [open(f).read().strip() for f in data_files(path)] == ["key|value"]


def test_feed_is_sharded_by_rows(spark, tmp_path):
    df = spark.range(0, 100, 1, 1).selectExpr("string(id) AS key", "'x' AS value")
    path, count = sinks.export_feed(df, str(tmp_path), "Large", RUN, rows_per_file=30)
    assert count == 100 and len(data_files(path)) == 4
    assert sinks.read_feed(spark, path, TEXT).count() == 100


def test_run_manifest_counts_what_was_written(spark, tmp_path):
    feeds = {n: spark.range(n_rows).selectExpr("string(id) AS key") for n, n_rows in (("A", 3), ("B", 0))}
    manifest = sinks.export_run(feeds, str(tmp_path), RUN)
    expected = [("FEED_20211014064500_A.DAT", 3), ("FEED_20211014064500_B.DAT", 0)]
    assert rows(manifest) == expected
    lazily = sinks.combine_manifests([sinks.feed_manifest(df, n, RUN) for n, df in feeds.items()])
    assert rows(lazily) == expected
    path = str(tmp_path / "20211014064500" / "manifest_20211014064500")
    assert len(data_files(path)) == 1
    assert rows(sinks.read_feed(spark, path, manifest.schema)) == expected


def test_publish_never_overwrites(spark, tmp_path):
    df = spark.range(3)
    first = sinks.publish_table(df, str(tmp_path), "r1")
    second = sinks.publish_table(spark.read.parquet(first).filter("id > 0"), str(tmp_path), "r2")
    assert spark.read.parquet(first).count() == 3 and spark.read.parquet(second).count() == 2
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        sinks.publish_table(df, str(tmp_path), "r1")


def test_history_rerun_replaces_its_run_even_when_empty(spark, tmp_path):
    base = str(tmp_path)
    df = spark.range(3)
    sinks.append_history(df, base, "20210101")
    sinks.append_history(df, base, "20210102")
    sinks.append_history(df.filter("id = 0"), base, "20210102")
    assert rows(sinks.read_history(spark, base, df.schema)) == [
        (0, "20210101"), (0, "20210102"), (1, "20210101"), (2, "20210101")
    ]
    sinks.append_history(df.limit(0), base, "20210102")
    assert sinks.read_history(spark, base, df.schema).count() == 3


def test_refresh_dates_replaces_its_window_only(spark, tmp_path):
    from shelfcast.sinks.publish import write_by_date

    path = str(tmp_path / "fact")
    days = [dt.date(2021, 1, d) for d in range(1, 6)]
    schema = "fact_date date, units int"
    old = spark.createDataFrame([(d, 1) for d in days], schema)
    write_by_date(old, path, "fact_date")
    new = spark.createDataFrame([(days[0], 9), (days[2], 2), (days[4], 2)], schema)
    sinks.refresh_dates(new, path, "fact_date", days[2], days[4])
    stored = spark.read.schema("units int, fact_date date").parquet(path).select("fact_date", "units")
    assert rows(stored) == [(days[0], 1), (days[1], 1), (days[2], 2), (days[4], 2)]


def test_store_deltas_have_one_folder_per_store_with_rows(spark, tmp_path):
    delta = spark.createDataFrame(
        [(1, "a", 5), (1, "b", 0), (12, "a", 1)], "store_id bigint, sku string, quantity bigint"
    )
    root = sinks.export_store_deltas(delta, str(tmp_path / "out"), "INV_", RUN, 100)
    folders = {f for f in os.listdir(root) if f.startswith("feed_file=")}
    assert folders == {
        "feed_file=INV_120211014064500_DELTA_00", "feed_file=INV_1220211014064500_DELTA_00"
    }
    back = sinks.read_feed(spark, f"{root}/feed_file=INV_120211014064500_DELTA_00", delta.schema)
    assert rows(back) == [(1, "a", 5), (1, "b", 0)]


def test_large_store_is_written_by_several_tasks(spark, tmp_path):
    delta = spark.range(0, 40_000, 1, 16).selectExpr(
        "if(id % 3 = 0, 1, id % 5 + 2) AS store_id", "string(id) AS sku", "id AS quantity"
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32KB")
    root = sinks.export_store_deltas(delta, str(tmp_path / "out"), "INV_", RUN, 1)
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(data_files(f"{root}/feed_file=INV_120211014064500_DELTA_01")) > 1
    back = sinks.read_feed(spark, root, "store_id bigint, sku string, quantity bigint, feed_file string")
    assert back.count() == 40_000


def test_small_stores_are_dealt_to_more_tasks_than_cores_and_have_no_side_files(spark, tmp_path):
    delta = spark.range(0, 20_000, 1, 16).selectExpr("id % 400 AS store_id", "string(id) AS sku", "id AS quantity")
    small = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB"}
    with held_settings(spark, small):
        root = sinks.export_store_deltas(delta, str(tmp_path / "out"), "INV_", RUN, 1)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionNum", None) is None
    files = [f for _, _, found in os.walk(root) for f in found]
    written = [f for f in files if f.startswith("part-")]
    assert len(written) == 400 and len({f[:10] for f in written}) > 2 * spark.sparkContext.defaultParallelism
    # a checksum file beside each file costs as much as the file
    assert not [f for f in files if f.endswith(".crc")]
    back = sinks.read_feed(spark, root, "store_id bigint, sku string, quantity bigint, feed_file string")
    assert back.count() == 20_000


def test_store_files_of_a_mounted_folder_are_those_spark_writes(spark, tmp_path):
    skus = ['q"x', "a|b", " padded ", "two\nlines", "", None, "na\u00efve", "#c", "\\"]
    delta = spark.createDataFrame(
        [(store, sku, n) for store in (7, -3, None) for n, sku in enumerate([*skus, "z"])]
        + [(None, None, None), (5, None, None)],
        "store_id bigint, sku string, `quantity|2` bigint",
    )
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.shop.link./to", f"file://{tmp_path}")

    def written(root, folder):
        assert sinks.export_store_deltas(delta, root, "IN:V/{1}%", RUN, 7) == root
        found = {}
        for path in data_files(folder):
            text = open(path, "rb").read()
            modes = [os.stat(p).st_mode for p in (path, os.path.dirname(path), folder)]
            found.setdefault(os.path.dirname(path).removeprefix(folder), []).append((sorted(text.split(b"\n")), modes))
        others = {f for _, _, files in os.walk(folder) for f in files if not f.startswith("part-")}
        return found, others

    by_spark = written("viewfs://shop/to/spark", f"{tmp_path}/spark")
    assert len(by_spark[0]) == 4 and by_spark[1] == {"_SUCCESS"}
    for root in (f"{tmp_path}/plain", f"file://{tmp_path}/uri/", f"file:{tmp_path}/plain"):
        assert written(root, f"{tmp_path}/{root.rstrip('/').rsplit('/', 1)[1]}") == by_spark
    assert sorted(os.listdir(tmp_path)) == ["plain", "spark", "uri"]


def test_store_files_need_no_process_each(spark, tmp_path):
    def started():
        return next(int(line.split()[1]) for line in open("/proc/stat") if line.startswith("processes"))

    delta = spark.range(2_000).selectExpr("id AS store_id", "'a' AS sku", "id AS quantity")
    before = started()
    root = sinks.export_store_deltas(delta, str(tmp_path / "out"), "INV_", RUN, 1)
    assert started() - before < 1_000 and len(data_files(root)) == 2_000


def test_store_files_that_fail_leave_those_before(spark, tmp_path):
    delta = spark.range(0, 400, 1, 8).selectExpr("id % 100 AS store_id", "string(id) AS sku", "id AS quantity")
    root = sinks.export_store_deltas(delta, str(tmp_path / "out"), "INV_", RUN, 1)
    files = sorted(data_files(root))
    failing = delta.withColumn("sku", F.when(F.col("quantity") != 333, F.col("sku")).otherwise(F.raise_error(F.lit("no"))))
    with pytest.raises(Exception, match="no"):
        sinks.export_store_deltas(failing, root, "INV_", RUN, 1)
    assert len(files) == 100 and sorted(data_files(root)) == files and os.listdir(tmp_path) == ["out"]
    sinks.export_store_deltas(delta.limit(0), root, "INV_", RUN, 1)
    assert os.listdir(root) == ["_SUCCESS"]


def test_price_file_is_stamped_and_otherwise_unchanged(spark, tmp_path):
    source = write_text(tmp_path, "prices.csv", 'sku;price;note\n001;10.50;"a;b"\n002;7;\n')
    target = sources.stamped_price_file(spark, source, str(tmp_path / "out"), dt.datetime(2021, 3, 1, 5, 30))
    back = sources.read_prices(spark, target)
    assert back.columns == ["sku", "price", "note", "snapshot_date"]
    assert rows(back) == [
        ("001", "10.50", "a;b", "2021-02-28T23:30:00"), ("002", "7", None, "2021-02-28T23:30:00")
    ]
    assert sources.price_file_name(dt.date(2021, 3, 1), "PRICES") == "PRICES_2021022801.csv"


def test_store_inventory_run(spark, tmp_path):
    schema = "store_id bigint, sku string, quantity bigint, as_of date"
    old, new = dt.date(2021, 1, 1), dt.date(2021, 1, 2)
    stock = spark.createDataFrame([(1, "a", 5, old), (1, "b", 6, old)], schema)
    snapshot = spark.createDataFrame([(1, "a", 7, new), (2, "c", 1, new)], schema)
    merged = store_inventory_run(stock, stock.drop("as_of"), snapshot, str(tmp_path), "INV_", RUN, 3)
    assert rows(merged.select("store_id", "sku", "quantity")) == [
        (1, "a", 7), (1, "b", 6), (2, "c", 1)
    ]
    files = spark.read.options(sep="|", header=True).csv(f"{tmp_path}/files/20211014064500")
    assert rows(files.select("store_id", "sku", "quantity", F.col("feed_file").substr(-8, 8))) == [
        ("1", "a", "7", "DELTA_03"), ("1", "b", "0", "DELTA_03"), ("2", "c", "1", "DELTA_03")
    ]


def test_scratch_path_is_under_the_shared_folder(spark):
    path = scratch_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir")) and path != scratch_path(spark, "x")
