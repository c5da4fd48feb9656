"""Every registered query against its SQL restatement."""

import os

import pytest

import __spark_entry__ as entry
from oracle_compare import compare, connect
from spanledger.plans import registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    result = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF_DIR)
    assert result["values_equal"] and result["columns_equal"] and not result["types_differ"], result


def test_entry(spark):
    assert entry.entry(spark).count() > 0
