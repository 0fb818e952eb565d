"""The same comparison where one key of every fact and dimension holds a third of the rows.

Broadcasts are off and skew thresholds low, so hot keys go through shuffles and get split.
"""

from __future__ import annotations

import duckdb
import pytest
from conftest import SMALL, explained

from checks.compare import differences, duck
from checks.oracle import oracle_sql
from checks.queries import REGISTERED

# Row 0 of each table's own numbering goes to the hot value; the rest stays as it is.
HOT_COLUMNS = {
    "region": {},
    "nation": {},
    "supplier": {"s_nationkey": "1::INTEGER"},
    "customer": {"c_nationkey": "1::INTEGER"},
    "part": {"p_brand": "'Brand#2'", "p_type": "'MEDIUM'", "p_size": "11::INTEGER"},
    "orders": {"o_custkey": "1::BIGINT"},
    "lineitem": {
        "l_orderkey": "(SELECT min(o_orderkey) FROM '{orders}' "
        "WHERE o_orderstatus = 'O' AND o_orderkey % 10 <> 0 AND o_orderdate >= '1997-01-01')",
        "l_partkey": "13::BIGINT",
        "l_suppkey": "3::BIGINT",
    },
}
SHIFTED = {"l_partkey": 1, "l_suppkey": 2}


def skewed_copy(folder: str, target: str) -> str:
    connection = duckdb.connect()
    for table, columns in HOT_COLUMNS.items():
        source = f"{folder}/{table}.parquet"
        hot = ", ".join(
            f"CASE WHEN (rn + {SHIFTED.get(column, 0)} * (rn // 3)) % 3 = 0 "
            f"THEN {value.format(orders=f'{folder}/orders.parquet')} ELSE {column} END AS {column}"
            for column, value in columns.items()
        )
        replace = f"REPLACE ({hot})" if hot else ""
        connection.execute(
            f"COPY (SELECT * EXCLUDE (rn) {replace} FROM "
            f"(SELECT *, row_number() OVER () AS rn FROM '{source}')) "
            f"TO '{target}/{table}.parquet' (FORMAT parquet, ROW_GROUP_SIZE 2048)"
        )
    return target


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    return skewed_copy(SMALL, str(tmp_path_factory.mktemp("skewed")))


@pytest.mark.parametrize("name", REGISTERED)
def test_hot_keys_give_the_same_rows(large_data, skewed, name):
    df = REGISTERED[name](large_data, skewed)
    assert differences(df, duck(skewed), oracle_sql()[name]) == ""


def test_hot_order_is_split(large_data, tmp_path):
    large_data.conf.set("spark.sql.files.maxPartitionBytes", "256KB")
    tables = skewed_copy(SMALL.replace("0.001", "0.01"), str(tmp_path))
    df = REGISTERED["q23_flatten_details"](large_data, tables)
    df.collect()
    assert "skew=true" in explained(df)


def test_nesting_does_not_depend_on_the_largest_order(spark, skewed):
    """A row is one delivery of an order, in skewed data as in plain ones."""
    from checks.fixtures import Tables

    for folder in (SMALL, skewed):
        t = Tables(spark, folder)
        deliveries = t.given("lineitem").select("l_orderkey", "l_suppkey", "l_shipdate").distinct()
        assert t.order_details.count() == deliveries.count()
