"""Every registered query against its SQL on the driver tables."""

import pytest

import __spark_entry__ as entry
from checks.run import compare, connect

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "part_key", "attr"] and df.count() > 0


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, small, key):
    ok, message = compare(spark, con, key, QUERIES[key], ORACLES.get(key), small)
    assert ok, message
