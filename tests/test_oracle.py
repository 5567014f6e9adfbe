"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from catalog.compare import compare, connect
from catalog.registry import QUERIES, oracles

SF_DIR = "/root/testdata/sf0.001"
@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracles())


@pytest.mark.parametrize("name", sorted(oracles()))
def test_query_matches_sql(spark, tables, name):
    found = compare(spark, tables, name, SF_DIR)
    assert found["status"] == "same", found
    assert not found["types"]


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
