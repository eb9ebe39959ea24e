"""All checks against plain SQL at the smallest scale."""

from __future__ import annotations

import compare
import pytest
from conftest import SMALL

import __spark_entry__ as entry_module
from fiscoframe import checks

QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()
NAMES = list(SQL)


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_equals_plain_sql(spark, connection, name):
    assert compare.compare(QUERIES[name](spark, SMALL), connection, SQL[name]) == ""


def test_every_query_has_sql():
    assert set(checks.loaded(checks.QUERIES)) == set(checks.loaded(checks.SQL))


def test_flagship(spark):
    assert entry_module.entry(spark).count() > 0
