"""Every registered query gives the rows of its SQL."""

from __future__ import annotations

import __spark_entry__ as entry_point
import pytest
from conftest import SMALL

from checks.compare import differences, duck
from checks.oracle import oracle_sql
from checks.queries import REGISTERED


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


@pytest.mark.parametrize("name", REGISTERED)
def test_query_matches_sql(spark, connection, name):
    df = REGISTERED[name](spark, SMALL)
    assert differences(df, connection, oracle_sql()[name]) == ""


def test_every_query_has_sql():
    assert REGISTERED.keys() == oracle_sql().keys()
    own = {n for n in entry_point.queries() if n.startswith("q")}
    assert own == REGISTERED.keys() and REGISTERED.keys() <= entry_point.oracle_sql().keys()


def test_entry_has_rows(spark):
    assert not entry_point.entry(spark).isEmpty()
