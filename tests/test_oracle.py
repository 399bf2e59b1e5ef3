"""Every named query against its SQL oracle, value by value."""

import os

import pytest

import compare
from oracle.sql import ORACLES
from tidepanel import catalogue

SF_DIR = os.environ.get("TIDEPANEL_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(catalogue.QUERIES)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_matches_oracle(spark, con, name):
    assert compare.differences(spark, con, SF_DIR, name) == []


def test_entry_contract(spark):
    import __spark_entry__ as contract

    assert set(catalogue.QUERIES) <= set(contract.queries())
    assert set(catalogue.QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())
    rows = contract.entry(spark)
    assert rows.columns == ["year", "top10_weight_pct", "uk_gdp_growth_pct", "top10_companies"]
    assert rows.count() > 0
