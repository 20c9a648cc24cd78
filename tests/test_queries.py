"""Every registered query against its SQL, or for its rows where there is no SQL."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import difference, duck

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["userId", "itemId", "score", "rank", "label"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, SF)
    if name in oracle_sql():
        assert difference(df, con, oracle_sql()[name]) is None
    else:
        assert df.count() > 0
