"""Every named query against DuckDB on the same tables."""

import pytest

import __spark_entry__ as contract
from tests.compare import connect, differences

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    if name not in ORACLES:
        assert df.count() >= 0
        return
    assert differences(df, con, ORACLES[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
