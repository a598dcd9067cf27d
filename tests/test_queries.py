"""Every registered query against its SQL, on whole tables."""

import pytest
from compare import connection, difference

import __spark_entry__ as entry
from twinflow.plans import catalogue, oracles

# the reference's own operators; those on training text have tests of their own
QUERIES, SQL = catalogue.queries(), dict(oracles.ORACLES)


@pytest.fixture(scope="module")
def con(sf_dir):
    return connection(sf_dir)


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == [
        "request_id", "digital_twin", "outcome", "observation_id", "route", "error_code",
    ]
    assert rows.count() > 0
