"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry_points
from compare import compare, connect
from conftest import SMALL
from stratamart.registry import all_oracles, all_queries


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, con, name):
    verdict, _, _ = compare(spark, con, SMALL, name)
    assert verdict == "ok", verdict


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(entry_points.queries())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[0] == "sales_key" and df.count() > 0
