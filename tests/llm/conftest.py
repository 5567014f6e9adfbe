from __future__ import annotations

import pytest
from samples import EDGES, SCHEMA, rows_of


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls, empty and long texts, copies, and columns whose names the operators use themselves."""
    return spark.createDataFrame(rows_of(EDGES), SCHEMA).cache()


@pytest.fixture(scope="session")
def empty(edges):
    return edges.limit(0)
