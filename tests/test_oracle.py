"""Every registered query against its SQL on the second engine."""

import re

import pytest

import __spark_entry__ as contract
from checks.compare import connect, differences

# The text operators have tests of their own; some of them cannot be said in SQL.
TEXT = re.compile(r"op\d+_|pipeline$")
QUERIES = {n: q for n, q in contract.queries().items() if not TEXT.match(n)}
ORACLES = {n: q for n, q in contract.oracle_sql().items() if not TEXT.match(n)}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, sf, con, name):
    assert differences(QUERIES[name](spark, sf), con, ORACLES[name]) == []


def test_flagship(spark):
    assert contract.entry(spark).count() > 0
