"""Every registered query against its SQL twin, over the smallest given tables."""

import os

import pytest

import __spark_entry__ as entry
from crosscheck import compare, load

SF_DIR = os.environ.get("CROSSCHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no given tables here")


@pytest.fixture(scope="module")
def duck():
    return compare.duck(SF_DIR)


@pytest.mark.parametrize("name", list(load().QUERIES))
def test_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() >= 0
    else:
        assert compare.difference(df, duck, sql) is None


def test_every_query_has_sql():
    assert set(load().QUERIES) == set(load().ORACLE)
    assert set(load().QUERIES) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
