"""Every registered query with SQL, compared over whole results."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect

SF = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def engine():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, engine, name):
    ok, message = compare(spark, SF, engine, QUERIES[name], ORACLES[name])
    assert ok, message


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
