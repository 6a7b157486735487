"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from tests import oracle

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query(spark, con, name):
    found = oracle.spark_rows(entry_points.queries()[name](spark, SF_DIR))
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        assert sum(found[1].values()) > 0
    else:
        assert oracle.difference(oracle.sql_rows(con, sql), found) is None


def test_entry(spark):
    assert set(entry_points.entry(spark).columns) == {"query_id", "id", "similarity", "rank"}


def test_oracles_belong_to_queries():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
