"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, views

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return views(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    good, note = compare(spark, con, SF, entry.queries()[name], entry.oracle_sql().get(name))
    assert good, note


def test_entry(spark):
    assert entry.entry(spark).columns == ["symbol", "trade_time", "close", "volume", "sma_5", "sma_10", "sma_20"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
