"""Physical plans of every query: no Python in the rows, no cross join, no unpartitioned window."""

from __future__ import annotations

import re

import pytest

from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401 - registers the queries
from catalog import standins as S
from catalog.registry import QUERIES, Tables
from wattline import constants as C
from wattline.plans import raw

SF_DIR = "/root/testdata/sf0.001"
# These train a model or write files while the plan is built; other tests run them.
BUILT_BY_JOBS = {
    "train_gbt", "log_run", "predict_proba",
}
NAMES = sorted(n for n in QUERIES if n not in BUILT_BY_JOBS and not n.startswith(("src_", "sink_", "model_input_")))
# NOT IN over a table never shows up: the library writes anti joins.
UNWANTED = ["EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"]


@pytest.mark.parametrize("name", NAMES)
def test_plan(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in UNWANTED if op in plan]
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if re.search(r"[+:-] *(\*\(\d+\) )?Window \[", line):
            assert "SinglePartition" not in "".join(lines[i + 1 : i + 5]), "a window in one task"


def test_scan_reads_only_what_is_asked(spark):
    df = QUERIES["agg_month_sum"](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    orders = next(line for line in plan.splitlines() if "orders.parquet" in line)
    assert "o_shippriority" not in orders and "o_custkey" in orders
    lines = QUERIES["feat_zscore_tail"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_shipdate" in lines


def exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


def test_readings_cross_the_network_once(spark):
    """In full once, by consumer and month; then a row per month goes to the consumer."""
    readings = S.consumption(Tables(spark, SF_DIR))
    full, monthly = sorted(exchanges(raw.summarise_consumption(readings)), key=len, reverse=True)
    assert re.sub(r"#\d+L?", "", full).startswith("CONS_ID, CSQ, pos, _place")
    assert re.sub(r"#\d+L?", "", monthly).startswith("CONS_ID, CSQ, ") and "pos" not in monthly
    for name in ("agg_month_sum", "agg_month_first_code"):
        assert len(exchanges(QUERIES[name](spark, SF_DIR))) == 1


def test_both_ways_of_reading_months_agree(spark):
    readings = S.consumption(Tables(spark, SF_DIR))
    readings = readings.union(readings.limit(400)).union(readings.where("BC_CD = '199913'").withColumn("MNO", F.lit("m")))
    found = [
        raw.summarise_consumption(readings, many).select(*C.KEYS, F.to_json(F.struct("*")).alias("row")).collect()
        for many in (False, True)
    ]
    assert sorted(found[0]) == sorted(found[1]) and len(found[0]) > 100
