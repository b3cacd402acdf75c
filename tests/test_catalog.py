"""Every catalog query against its SQL on an independent engine, on the smallest data."""

from __future__ import annotations

import pytest
from compare import compare, duck

import __spark_entry__ as contract
from larder.catalog import entries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(entries()))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, entries()[name], SF) is None


def test_contract(spark):
    assert contract.entry(spark).columns[0] == "date_id"
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) > 150
