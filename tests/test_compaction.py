"""Packing a history's small files."""

from __future__ import annotations

import uuid

import pytest
from conftest import explained

from shelfcast import sinks

COLUMNS = "sku string, quantity bigint"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def history(spark, tmp_path):
    schema = spark.createDataFrame([], COLUMNS).schema
    return sinks.PackedHistory(str(tmp_path / "history"), schema, f"layout_{uuid.uuid4().hex}")


def run(spark, first, n, parts=4):
    return spark.range(first, first + n, 1, parts).selectExpr("concat('s', id) AS sku", "id AS quantity")


def files_read(df):
    return len(set(df.inputFiles()))


def test_many_small_runs_become_few_files_with_the_same_rows(spark, tmp_path):
    held = history(spark, tmp_path)
    for i in range(6):
        held.append(run(spark, 100 * i, 50 + i), f"r{i}")
    before = rows(held.read(spark))
    assert len(before) == sum(50 + i for i in range(6)) and files_read(held.read(spark)) == 24
    assert held.compact(spark, 1 << 20) == ["r0", "r1", "r2", "r3", "r4"]
    assert rows(held.read(spark)) == before
    assert files_read(held.read(spark)) == 1 + 4
    assert held.compact(spark, 1 << 20) == []  # nothing left to pack


def test_files_hold_equal_shares_and_large_runs_are_split(spark, tmp_path):
    held = history(spark, tmp_path)
    held.append(run(spark, 0, 30_000, 24), "large")
    for i in range(3):
        held.append(run(spark, i, 3000), f"small{i}")
    layout = {r.run_id: r for r in held.layout(spark)}
    target = max(r.bytes // r.files for r in layout.values()) * 3
    expected = sum(r.bytes for r in layout.values()) // target
    before = rows(held.read(spark))
    held.compact(spark, target, recent=0)
    assert rows(held.read(spark)) == before
    counts = [spark.read.parquet(f).count() for f in set(held.read(spark).inputFiles())]
    assert len(counts) == expected > 5
    assert max(counts) < 1.2 * min(counts)


def test_a_run_written_again_replaces_its_packed_rows(spark, tmp_path):
    held = history(spark, tmp_path)
    for name in ("a", "b", "c"):
        held.append(run(spark, 0, 5), name)
    held.compact(spark, 1 << 20, recent=0)
    held.append(run(spark, 100, 2), "b")
    held.append(run(spark, 0, 0), "c")
    expected = sorted(
        [(f"s{i}", i, "a") for i in range(5)] + [("s100", 100, "b"), ("s101", 101, "b")], key=repr
    )
    assert rows(held.read(spark)) == expected
    held.compact(spark, 1 << 20, recent=0)  # the replaced rows are not packed again
    assert rows(held.read(spark)) == expected and files_read(held.read(spark)) == 1


def test_a_compaction_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch):
    held = history(spark, tmp_path)
    for name in ("a", "b"):
        held.append(run(spark, 0, 5), name)
    before = rows(held.read(spark))

    def fails(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(sinks.PackedHistory, "_show", fails)
        with pytest.raises(RuntimeError):
            held.compact(spark, 1 << 20, recent=0)
    assert rows(held.read(spark)) == before
    assert held.compact(spark, 1 << 20, recent=0) == ["a", "b"]
    assert rows(held.read(spark)) == before


def test_nulls_repeated_rows_and_no_runs(spark, tmp_path):
    held = history(spark, tmp_path)
    assert rows(held.read(spark)) == [] and held.compact(spark, 1 << 20) == []
    twice = spark.createDataFrame([(None, 1), (None, 1), ("a", None)], COLUMNS)
    held.append(twice, "x")
    held.append(run(spark, 0, 0, 1), "empty")
    held.compact(spark, 1 << 20, recent=0)
    assert rows(held.read(spark)) == sorted([(None, 1, "x"), (None, 1, "x"), ("a", None, "x")], key=repr)


def test_rows_are_never_dealt_out_by_run(large_data, tmp_path, monkeypatch):
    held = history(large_data, tmp_path)
    for name in ("a", "b", "c"):
        held.append(run(large_data, 0, 500), name)
    plans, write = [], sinks.PackedHistory._write
    monkeypatch.setattr(sinks.PackedHistory, "_write", lambda self, df: plans.append(explained(df)) or write(self, df))
    assert held.compact(large_data, 1 << 20) == ["a", "b"]
    for plan in (*plans, explained(held.read(large_data))):
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
