"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tests.compare import connect, mismatch

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(contract.OWN_QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.OWN_QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert mismatch(contract.queries()[name](spark, FOLDER), duck, contract.oracle_sql()[name]) is None


def test_entry_is_sorted(spark):
    months = [row.mes for row in contract.entry(spark).collect()]
    assert months and months == sorted(months)


@pytest.mark.parametrize("name", ["revenue_by_state", "seller_ranking"])
def test_rankings_are_sorted_by_revenue(spark, name):
    totals = [row.receita_total for row in contract.queries()[name](spark, FOLDER).collect()]
    assert totals and totals == sorted(totals, reverse=True)
