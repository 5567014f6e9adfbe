"""Query registry, table access, and the WITH clauses that the SQL twins share."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = {}


# Declared, so that opening a table starts no job to look at its file.
SCHEMAS = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
}


class Tables:
    """``t.orders`` reads orders.parquet."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        path = f"{self.sf_dir.rstrip('/')}/{name}.parquet"
        return self.spark.read.schema(SCHEMAS[name]).parquet(path)


def query(name: str, sql: str | None = None):
    """Register a query by its name, with the equivalent SQL if there is one."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def cte(name: str, body: str) -> None:
    """A named sub-select that other SQL texts may use."""
    if name in CTES:
        raise ValueError(f"sub-select {name} is defined twice")
    CTES[name] = body.strip()


def expand(select: str) -> str:
    """``select`` with the sub-selects it names in front, each after those it needs."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"\w+", text):
            if word in CTES and word not in ordered:
                visit(CTES[word])
                if word not in ordered:
                    ordered.append(word)

    visit(select)
    if not ordered:
        return select.strip()
    named = ",\n".join(f"{name} AS (\n{CTES[name]}\n)" for name in ordered)
    return f"WITH {named}\n{select.strip()}"


def oracles() -> dict[str, str]:
    """The SQL twins, complete with the sub-selects they use."""
    return {name: expand(sql) for name, sql in ORACLES.items()}


def rounded(value: str, digits: int = 6) -> Column:
    """Rounded, without a negative zero. The SQL texts write ``round(x, 6) + 0.0``."""
    return F.expr(f"round({value}, {digits}) + 0D")
