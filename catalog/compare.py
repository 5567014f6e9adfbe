"""Run a query and its SQL twin on the same tables and compare the rows as bags."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from catalog.registry import ORACLES, QUERIES, expand


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _rows(table) -> tuple[list[str], Counter]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, Counter(tuple(map(_plain, row)) for row in zip(*columns))


def _kinds(table) -> dict[str, str]:
    return {n: str(table.schema.field(n).type) for n in table.column_names}


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> dict:
    """Row count, whether the rows agree, and columns whose types differ."""
    ours = QUERIES[name](spark, sf_dir).toArrow()
    result = {"name": name, "rows": ours.num_rows}
    if name not in ORACLES:
        return {**result, "status": "rows only"}
    theirs = con.sql(expand(ORACLES[name])).to_arrow_table()
    (our_names, our_rows), (their_names, their_rows) = _rows(ours), _rows(theirs)
    kinds, their_kinds = _kinds(ours), _kinds(theirs)
    types = {n: (k, their_kinds.get(n)) for n, k in kinds.items() if k != their_kinds.get(n)}
    missing, extra = their_rows - our_rows, our_rows - their_rows
    same = our_names == their_names and not missing and not extra
    return {
        **result,
        "status": "same" if same else "DIFFERENT",
        "oracle_rows": theirs.num_rows,
        "columns": our_names if our_names == their_names else (our_names, their_names),
        "types": types,
        "missing": list(missing.items())[:3],
        "extra": list(extra.items())[:3],
    }
