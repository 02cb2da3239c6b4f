"""The driver contract: the flagship query, and queries equal to their SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from oracle import compare, connect

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["market_id", "t", "o", "h", "l", "c"]
    assert rows.count() > 0


def test_names():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, con, name):
    assert compare(spark, con, name, SMALL) == ""
