"""Every registered query against its SQL twin in an independent engine."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import oracle
from check_oracle import database, difference
from hoptrail.plans import catalog

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return database(small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, small, name):
    assert difference(QUERIES[name](spark, small).toArrow(), con, SQL[name]) == ""


def test_every_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_every_query_has_a_twin():
    assert set(catalog.QUERIES) == set(oracle.all_queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
