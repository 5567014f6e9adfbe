"""Batches of readings merged into the monthly state, against one run over all of them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wattline import constants as C
from wattline.plans import increments, raw, run_config
from wattline.sources import readers

from test_operators import CONSUMPTION
from test_stages import MONTHS, files, write  # noqa: F401 - a fixture

FIRST = [
    ("a", "1", "m1", "202101", "B", None, 5.0, 0),
    ("a", "1", "m1", "202101", "B", "NR", 7.0, 1),
    ("a", "1", "m2", "202103", "B", None, None, 2),
    ("a", "1", None, "209913", "B", "XX", 9.0, 3),
    ("b", "1", "m3", "202102", None, "NR", 1.0, 4),
    ("b", "1", "m3", "202102", None, "NR", 1.0, 5),
]
SECOND = [
    ("a", "1", "m1", "202101", "B", "NR", 7.0, 6),  # repeated
    ("a", "1", "m1", "202101", "B", "LW", 2.0, 7),  # late
    ("a", "1", "m2", "202103", None, "B", None, 8),  # the same values, but for where they are missing
    ("a", "1", "m4", "209913", "B", "XX", 9.0, 9),
    ("b", "1", "m5", "202104", "B", None, 4.0, 10),
    ("c", "1", "m6", "202001", "B", "LW", 3.0, 11),
]
LAST = [("b", "1", "m3", "202102", None, "NR", 1.0, 12), ("c", "1", "m7", "202001", "B", "NR", 1.0, 13)]


def shown(summary):
    columns = [c for c in sorted(summary.columns)]
    return sorted(r[0] for r in summary.select(F.to_json(F.struct(*columns))).collect())


@pytest.mark.parametrize("many", [False, True])
def test_batches_equal_one_run(spark, tmp_path, many):
    state = str(tmp_path / "state")
    parts = [FIRST, SECOND, [], LAST]
    for k, rows in enumerate(parts):
        assert increments.add_batch(spark, spark.createDataFrame(rows, CONSUMPTION), state, f"{k}", many)
        seen = spark.createDataFrame(sum(parts[: k + 1], []), CONSUMPTION)
        assert shown(increments.summary(spark, state)) == shown(raw.summarise_consumption(seen, many))


def test_a_batch_counts_once_and_in_order(spark, tmp_path):
    state = str(tmp_path / "state")
    assert shown(increments.summary(spark, state)) == []
    batch = spark.createDataFrame(FIRST, CONSUMPTION)
    assert increments.add_batch(spark, batch, state, "2021-06")
    before = shown(increments.summary(spark, state))
    assert not increments.add_batch(spark, spark.createDataFrame(SECOND, CONSUMPTION), state, "2021-06")
    with pytest.raises(ValueError, match="comes before"):
        increments.add_batch(spark, batch, state, "2021-05")
    assert shown(increments.summary(spark, state)) == before


def test_a_failed_batch_leaves_the_state(spark, tmp_path):
    state = str(tmp_path / "state")
    increments.add_batch(spark, spark.createDataFrame(FIRST, CONSUMPTION), state, "1")
    before = shown(increments.summary(spark, state))
    broken = spark.createDataFrame(SECOND, CONSUMPTION).withColumn(
        "ENT_CD", F.when(F.col("CONS_ID") == "c", F.raise_error(F.lit("lost"))).otherwise(F.col("ENT_CD"))
    )
    with pytest.raises(Exception, match="lost"):
        increments.add_batch(spark, broken, state, "2")
    assert increments.batches(spark, state) == ["1"]
    assert shown(increments.summary(spark, state)) == before


def test_only_the_batch_and_its_years_are_read(spark, tmp_path):
    state = str(tmp_path / "state")
    increments.add_batch(spark, spark.createDataFrame(FIRST + SECOND, CONSUMPTION), state, "1")
    known = increments._read(spark, state, "readings", increments.READING_SQL).where("year = 2020")
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and known.count() == 1


def test_job_with_state_equals_job_without(spark, files, tmp_path):  # noqa: F811
    lines = open(files["consumption"]).read().splitlines()
    header, rows = lines[0].split("|"), [line.split("|") for line in lines[1:]]
    cut = len(rows) // 2
    # The second batch repeats a part of the first.
    parts = [write(tmp_path / f"{k}.txt", "|", header, own) for k, own in enumerate((rows[:cut], rows[cut - 200 :]))]

    def run(name, **extra):
        dataset = {"consumer": files["consumer"], **extra}
        lookups = {"mcd": files["mcd"], "defect_range": files["ranges"]}
        config = {"lookups": lookups, "combine": {"output_directory": str(tmp_path / name), "files": {"D": dataset}}}
        return shown(spark.read.parquet(run_config.process_raw(spark, config)["D"]))

    state = {"state": str(tmp_path / "state")}
    run("one", consumption=parts[0], batch="1", **state)
    both = run("two", consumption=parts[1], batch="2", **state)
    assert both == run("full", consumption=files["consumption"]) and both
    # A job that runs again finds its batch merged.
    assert run("two", consumption=parts[1], batch="2", **state) == both
    keyless = {r["source"] for r in spark.read.parquet(str(tmp_path / "two" / "D_keyless")).collect()}
    assert keyless == {"consumer"}
