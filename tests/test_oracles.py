"""Every registered query against its SQL oracle, on whole driver tables."""

import os

import pytest
from oracle import compare, oracle_connection

import __spark_entry__ as entry
from zonetide.catalog import ORACLES, QUERIES

SF = os.environ.get("ORACLE_SF", "0.001")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_oracle(spark, con, key):
    assert compare(spark, con, QUERIES[key], ORACLES[key], SF) is None


def test_entry_has_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "target_demand" in df.columns
