"""Every registered query against its SQL at the smallest scale."""

from __future__ import annotations

import pytest
from compare import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from crawlframe.catalog import registered

SF = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry(spark):
    rows = entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"host", "n"}


@pytest.mark.parametrize("name", list(registered()))
def test_query(spark, con, name):
    assert compare(spark, con, name, queries()[name], SQL.get(name), SF) is None
