from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from wattline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", "tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def evaluate(spark):
    """Value of each SQL text over one row of typed columns."""

    def run(texts: dict[str, str], row: dict[str, str] | None = None) -> dict:
        source = spark.range(1)
        for name, literal in (row or {}).items():
            source = source.selectExpr("*", f"{literal} AS {name}")
        columns = [f"{text} AS `{name}`" for name, text in texts.items()]
        return source.selectExpr(*columns).first().asDict(recursive=True)

    return run
