"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry_module
from tests.oracle import connect, differences

QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    result = QUERIES[name](spark, sf_dir).toPandas()
    if name in ORACLES:
        assert differences(result, con.sql(ORACLES[name]).df()) == []
    else:
        assert len(result) > 0


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert ORACLES.keys() <= QUERIES.keys()
