"""Every registered query against its SQL on the small tables."""

import os

import pytest

import __spark_entry__
from tablestream.plans import QUERIES
from tests.oracle import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    q = QUERIES[name]
    assert q.sql is not None
    assert difference(q.build(spark, SF_DIR), con, q.sql) is None


def test_contract(spark):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    df = __spark_entry__.entry(spark)
    assert df.columns == ["event_time", "category", "orders"] and not df.isEmpty()
