"""Every registered query against its SQL twin on the small tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from obslake.catalog import oracles, registered
from tests.conftest import SMALL
from tools.compare import differences, duckdb_over


@pytest.fixture(scope="module")
def duck():
    return duckdb_over(SMALL)


OWN = sorted(registered())


def test_every_query_has_a_twin():
    assert set(oracles()) == set(OWN)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert "cumulative_pct" in df.columns


@pytest.mark.parametrize("name", OWN)
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SMALL)
    found = df.collect()
    assert found, "a check on no rows proves nothing"
    assert differences(df, found, duck.sql(contract.oracle_sql()[name])) == []
