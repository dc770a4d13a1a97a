"""Every registered query against its check SQL on the smallest tables."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry
from wordloom.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SQL = ORACLES


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    problem, rows = compare(spark, duck, SF, QUERIES[name], SQL[name])
    assert not problem
    assert rows > 0


def test_every_sql_has_a_query():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
