"""Every query against its SQL at the smallest scale, and the contract of the entry file."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.check import connect, difference
from newsloom import catalog, oracle
from tests.conftest import DATA

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.sql())
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    wrong = difference(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
    assert wrong is None, wrong


def test_entry(spark):
    row = entry.entry(spark).first()
    assert row.total_records == row.unique_ids > 0 and row.chars_total > 0
