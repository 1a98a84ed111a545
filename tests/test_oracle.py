"""Every registered query against its SQL oracle on the smallest test data."""

import check_oracle
import pytest

import __spark_entry__ as entry
from conftest import SMALL

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return check_oracle.connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, db, name):
    assert check_oracle.compare(QUERIES[name](spark, SMALL), db, ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_returns_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
