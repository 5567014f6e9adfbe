"""Operators on small tables: edge cases, ties, hot keys, and the second way of each join."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wattline import constants as C
from wattline.operators import combine, lookup, metrics, ranking, rows, screens, series
from wattline.plans import raw

RANGES = [
    ("ACME", "5-20", "230", 1000, 2000),
    ("ACME", "5-20", "230", 1990, 2500),
    ("ACME", "5-20", "230", 2502, 2502),
    ("ACME", "5-20", "230", 60000, 200000),
    ("ACME", "5-20", "230", 70, 60),
    ("OTHER", "5-20", "230", 1, 5),
]
RANGE_SCHEMA = "MFG string, AMP string, VLT string, start_serial long, end_serial long"


@pytest.mark.parametrize("max_pieces", [lookup.BROADCAST_PIECES, 0])
def test_defect_ranges(spark, max_pieces):
    serials = ["999", "1000", "1995", "2500", "2501", "2502", "A12", None, "65535", "65536", "131072", "200000", "200001", "65", "3"]
    meters = spark.createDataFrame([("ACME", "5-20", "230", s) for s in serials], "MFG string, AMP string, VLT string, MNO string")
    ranges = spark.createDataFrame(RANGES, RANGE_SCHEMA)
    found = lookup.range_defect_lookup(meters, ranges, max_pieces=max_pieces)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == (max_pieces > 0)
    got = {r["MNO"]: r["defect_range"] for r in found.collect()}
    inside = {"1000", "1995", "2500", "2502", "65535", "65536", "131072", "200000"}
    assert got == {s: int(s in inside) for s in serials}


def test_defect_ranges_match_brute_force_on_one_hot_make(spark):
    dice = random.Random(11)
    ranges = [("ACME", "a", "1", s, s + dice.randint(0, 30000)) for s in (dice.randint(0, 300000) for _ in range(40))]
    meters = [("ACME", "a", "1", str(dice.randint(0, 330000))) for _ in range(2000)]
    meters += [("ACME", "a", "1", "150000")] * 1000
    df = spark.createDataFrame(meters, "MFG string, AMP string, VLT string, MNO string")
    for max_pieces in (1000, 0):
        found = lookup.range_defect_lookup(df, spark.createDataFrame(ranges, RANGE_SCHEMA), max_pieces=max_pieces)
        got = sorted((r["MNO"], r["defect_range"]) for r in found.collect())
        want = sorted((m[3], int(any(lo <= int(m[3]) <= hi for *_, lo, hi in ranges))) for m in meters)
        assert got == want


@pytest.mark.parametrize("max_pieces", [lookup.BROADCAST_PIECES, 0])
def test_long_ranges(spark, max_pieces):
    """Ranges of all widths, up to all serials there are, beside short ones that they overlap."""
    top = 2**63 - 1
    ranges = [
        ("A", "a", "1", 5, 10**12), ("A", "a", "1", 7, 9), ("A", "a", "1", 10**12 - 3, 10**12 + 100_000),
        ("B", "a", "1", 10**15, 10**16), ("C", "a", "1", 0, top), ("D", "a", "1", top - 1, top), ("D", "a", "1", 2**53 + 1, 2**53 + 1),
    ]
    serials = [0, 4, 5, 8, 10**9, 10**12, 10**12 + 100_000, 10**12 + 100_001, 10**15 - 1, 10**15, 10**16, 10**16 + 1, 2**53, 2**53 + 1, 2**53 + 2, top - 2, top - 1, top]
    meters = [(m, "a", "1", str(n)) for m in "ABCDE" for n in serials]
    df = spark.createDataFrame(meters, "MFG string, AMP string, VLT string, MNO string")
    table = spark.createDataFrame(ranges, RANGE_SCHEMA)
    assert sum(lookup.piece_counts(table).values()) <= len(ranges) * 1026
    found = lookup.range_defect_lookup(df, table, max_pieces=max_pieces).collect()
    assert len(found) == len(meters)
    for r in found:
        want = any(m == r["MFG"] and lo <= int(r["MNO"]) <= hi for m, _, _, lo, hi in ranges)
        assert r["defect_range"] == int(want), r


def test_properties_of_unknown_model_are_null(spark):
    models = spark.createDataFrame([(102, "ACME", "5-20", "230", "Y", "N", "Y")], "MCD int, MFG string, AMP string, VLT string, SUP string, SMT string, ELC string")
    meters = spark.createDataFrame([(102,), (7,), (None,)], "MCD int")
    got = {r["MCD"]: r["MFG"] for r in lookup.join_mcd_properties(meters, models).collect()}
    assert got == {102: "ACME", 7: None, None: None}


def test_priority_dedup(spark):
    make = lambda data: spark.createDataFrame(data, "CONS_ID string, CSQ string, CNO string, MNO string")
    tables = {
        "D_1": make([("1", "1", "c", "m"), ("9", "1", None, "m")]),
        "D_2": make([("2", "2", "c", "m"), ("2", "1", "c", "m"), ("3", "1", "d", "m")]),
        "D_5": make([("4", "1", "c", "m"), ("8", "1", None, "m")]),
        "D_x": make([("0", "0", "c", "m"), ("0", "0", "e", "m")]),
    }
    best = combine.dedup_priority(combine.union_sources(tables), list(tables), {"D_1": 0, "D_2": 3, "D_5": 1})
    got = {(r["CNO"], r["SOURCE"], r["CONS_ID"], r["CSQ"]) for r in best.collect()}
    assert got == {("c", "D_2", "2", "1"), ("d", "D_2", "3", "1"), ("e", "D_x", "0", "0"), (None, "D_5", "8", "1")}


def test_remark_filter_and_relabel(spark):
    base = [("1", "1", "c", "m", 1), ("2", "1", "c", "m", 0), ("3", "1", "c", "m", 1), ("4", "1", "c", "m", 1)]
    kept = spark.createDataFrame(base, "CONS_ID string, CSQ string, CNO string, MNO string, LABEL int")
    remarks = {"1": "METER OK", "2": "METER DEFECTIVE", "3": C.REMARK_OTHER_METER_OK, "4": None}
    report = spark.createDataFrame([(k, "1", "c", "m", v) for k, v in remarks.items()], "CONS_ID string, CSQ string, CNO string, MNO string, `TD REMARKS` string")
    got = {r["CONS_ID"]: r["LABEL"] for r in combine.relabel_on_report(kept, report).collect()}
    assert got == {"1": 0, "2": 1, "4": 1}


def test_screen_conditions(evaluate):
    texts = {
        "five": screens.is_short_series("array(1D, 2D, 3D, 4D, 5D)"),
        "six": screens.is_short_series("array(1D, 2D, 3D, 4D, 5D, 6D)"),
        "max_1": screens.is_low_max("array(1D, null)"),
        "max_1_5": screens.is_low_max("array(1.5D, 0D)"),
        "no_value": screens.is_low_max("array(double(null))"),
        "sparse_6": screens.is_sparse("concat(array_repeat(double(null), 6), array_repeat(1D, 4))"),
        "sparse_7": screens.is_sparse("concat(array_repeat(double(null), 7), array_repeat(1D, 3))"),
    }
    assert evaluate(texts) == {
        "five": True, "six": False, "max_1": True, "max_1_5": False, "no_value": True,
        "sparse_6": False, "sparse_7": True,
    }


def test_reason_order_differs_by_path(spark):
    readings = "CAST(array(0, 0, 0, 0, 0, 0) AS array<double>)"
    df = spark.range(1).selectExpr(f"{readings} AS adv_ut_list", "102 AS MCD", "1 AS defect_range")
    row = df.select(screens.master_path_reason().alias("m"), screens.history_path_reason().alias("h")).first()
    assert (row["m"], row["h"]) == (C.DEFECT_RANGE, C.SILENT_LOW_MAX)


def test_missing_serial_counts_as_different(spark):
    left = spark.createDataFrame([("1", "a"), ("2", None), ("3", None), ("4", "a")], "k string, MNO string")
    right = spark.createDataFrame([("1", "a"), ("2", None), ("3", "x"), ("4", "b")], "k string, MNO string")
    got = {r["k"] for r in screens.screen_different_mno(left, right, ["k"]).collect()}
    assert got == {"2", "3", "4"}


CONSUMPTION = "CONS_ID string, CSQ string, MNO string, BC_CD string, BL_CD string, ENT_CD string, ADV_UT double, row_order long"


def test_summary_of_readings(spark):
    data = [
        ("1", "1", "a", "202401", "x", None, 5.0, 0),
        ("1", "1", "a", "202401", "x", "NR", 2.0, 1),
        ("1", "1", "a", "202401", "x", "NR", 2.0, 2),
        ("1", "1", "b", "202403", "x", "SP", None, 3),
        ("2", "1", "a", "202401", "x", None, 1.0, 4),
        ("2", "1", "z", "202413", "x", None, 9.0, 5),
    ]
    found = raw.summarise_consumption(spark.createDataFrame(data, CONSUMPTION))
    got = {r["CONS_ID"]: r for r in found.collect()}
    january = 2024 * 12
    assert [tuple(e) for e in got["1"]["entries"]] == [(january, 7.0, "NR"), (january + 2, 0.0, "SP")]
    assert (got["1"]["read_mno"], got["1"]["last_pos"]) == ("b", january + 2)
    assert [tuple(e) for e in got["2"]["entries"]] == [(january, 1.0, None)]
    assert got["2"]["read_mno"] == "z"


def test_hot_key_is_summed_before_the_shuffle(spark):
    """A third of 300,000 readings belongs to one consumer; tasks receive a row per month."""
    readings = spark.range(300000).selectExpr(
        "if(id % 3 = 0, 'hot', string(id)) AS CONS_ID", "'1' AS CSQ",
        "int(2024 * 12 + id % 24) AS pos", "1D AS v",
    )
    summed = series.agg_month_sum(readings, "v")
    plan = summed._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
    lists = series.build_series(summed)
    hot = lists.where("CONS_ID = 'hot'").first()
    assert len(hot["adv_ut_list"]) == 22 and sum(x or 0 for x in hot["adv_ut_list"]) == 100000


def test_a_hot_consumer_is_spread_over_its_months_and_places(spark):
    """A third of 60,000 readings belongs to one consumer, half of them without a month."""
    readings = spark.range(60000).selectExpr(
        "if(id % 3 = 0, 'hot', string(id)) AS CONS_ID", "'1' AS CSQ", "string(id % 7) AS MNO",
        "if(id % 2 = 0, string(202401 + (id div 6) % 6), 'none') AS BC_CD", "'B' AS BL_CD", "'NR' AS ENT_CD", "double(id) AS ADV_UT", "id AS row_order",
    )
    placed = raw.placed_months(readings)
    sizes = placed.where("CONS_ID = 'hot'").groupBy("pos", raw.PLACE).count()
    assert sizes.where("pos IS NULL").count() == raw.NO_MONTH_PLACES
    assert sizes.where("pos IS NULL").agg({"count": "max"}).first()[0] < 100
    assert sizes.where("pos IS NOT NULL").agg({"count": "max"}).first()[0] <= 10000 // 6 + 1
    found = raw.summarise_consumption(readings).where("CONS_ID = 'hot'").first()
    assert len(found["entries"]) == 6 and sum(e["units"] for e in found["entries"]) == sum(range(0, 60000, 6))
    assert found["read_mno"] == str(59997 % 7)  # the last reading without a month


def test_top1_keeps_one_row_per_task_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, null, id % 5) AS k", "id AS v")
    top = rows.top1_per_group(df, ["k"], [F.desc("v")])
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    got = {r["k"]: r["v"] for r in top.collect()}
    assert got == {None if i % 3 == 0 else i % 5: i for i in range(1000)}


def test_distinct_rows_keep_the_first_place(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2)], "x string, row_order long")
    assert {tuple(r) for r in rows.distinct_rows(df).collect()} == {("a", 1), ("b", 2)}


def test_split_equals_a_global_rank(spark):
    df = spark.range(20000).selectExpr("id", "int(id % 10 = 0) AS label", "string(id) AS wide")
    found = ranking.stratified_split(df, "label", ["id"])
    place = F.row_number().over(Window.partitionBy("label").orderBy(ranking.row_hash(["id"])))
    size = F.count("id").over(Window.partitionBy("label"))
    wanted = place <= F.floor(size * 0.2)
    assert found.count() == 20000 and found.withColumn("w", wanted).where("is_validation != w").count() == 0
    few = ranking.stratified_split(df.where("id < 3"), "label", ["id"])
    assert few.count() == 3 and few.where("is_validation").count() == 0


def test_split_is_stratified_and_stable(spark):
    df = spark.range(5003).selectExpr("id", "int(id % 7 = 0) AS label")
    first = ranking.stratified_split(df, "label", ["id"])
    again = ranking.stratified_split(df.repartition(13), "label", ["id"])
    counts = {r["label"]: (r["n"], r["v"]) for r in first.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_validation").alias("v")).collect()}
    assert counts == {0: (4288, 857), 1: (715, 143)}
    assert first.exceptAll(again).count() == 0


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 30 + [(1,)] * 10 + [(None,)], "label int")
    got = {r["label"]: r["class_weight"] for r in ranking.with_class_weights(df, "label").collect()}
    assert got == pytest.approx({0: 40 / 60, 1: 2.0})
    held = {r["label"]: r["class_weight"] for r in ranking.with_class_weights(df, "label", 0.2).collect()}
    assert held == pytest.approx({0: 32 / 48, 1: 2.0})


def test_metrics_without_a_positive(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "a int, p int")
    row = metrics.metric_prf(df, "a", "p").first()
    assert tuple(row) == (1.0, 0.0, 0.0, 0.0)


def test_foreign_keys_go_before_the_first_shuffle(spark, tmp_path):
    master = spark.range(500).selectExpr("string(id) AS CONS_ID", "if(id % 7 = 0, 'é', '1') AS CSQ")
    known = rows.key_filter(master, f"{tmp_path}/keys")
    readings = spark.range(20000).selectExpr(
        "string(id % 4000) AS CONS_ID", "if(id % 4000 % 7 = 0, 'é', '1') AS CSQ", "'m' AS MNO",
        "string(202401 + id % 12) AS BC_CD", "'B' AS BL_CD", "'NR' AS ENT_CD", "double(id) AS ADV_UT", "id AS row_order",
    )
    left = rows.with_likely_keys(readings, known)
    assert left.columns == readings.columns
    assert left.join(master, ["CONS_ID", "CSQ"], "left_anti").count() < 17500 / 10  # expected: one in 16
    own = readings.join(master, ["CONS_ID", "CSQ"], "left_semi")
    assert own.exceptAll(left).count() == 0 and own.count() == 2500
    plan = raw.summarise_consumption(left)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.index("REPARTITION_BY_COL") < plan.index("BroadcastHashJoin [_word")
    assert rows.key_filter(master, f"{tmp_path}/none", most=499) is None
    assert rows.with_likely_keys(readings, None) is readings
    empty = rows.key_filter(master.limit(0), f"{tmp_path}/empty")
    assert rows.with_likely_keys(readings, empty).count() == 0


def test_first_copies_are_the_distinct_rows(spark):
    data = [
        ("a", 1, 0.0, "x", 5), ("a", 1, -0.0, "x", 3), ("a", 1, 0.0, "x", None), ("a", None, float("nan"), None, 1),
        ("a", None, float("nan"), None, 2), (None, None, None, None, None), (None, None, None, None, None), ("b", 1, 1.5, "y", 4),
    ]
    df = spark.createDataFrame(data, "k string, pos int, v double, `w.x` string, row_order long")
    found, wanted = rows.first_copies(df, ["k", "pos"]), rows.distinct_rows(df.withColumnRenamed("w.x", "w"))
    assert found.columns == ["k", "pos", "v", "w.x", "row_order"]
    assert sorted(str(tuple(r)) for r in found.collect()) == sorted(str(tuple(r)) for r in wanted.collect())
    assert rows.first_copies(df.drop("row_order"), ["k", "pos"]).count() == 4


def test_readings_are_sorted_once_and_not_held_in_hash_tables(spark):
    readings = spark.range(1000).selectExpr(
        "string(id % 50) AS CONS_ID", "string(id % 2) AS CSQ", "string(id % 3) AS MNO", "string(202401 + id % 12) AS BC_CD",
        "string(id % 4) AS BL_CD", "if(id % 9 = 0, 'NR', 'SP') AS ENT_CD", "double(id % 5) AS ADV_UT", "id AS row_order",
    )
    plan = raw.summarise_consumption(readings)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and " HashAggregate(" not in plan


def test_many_models_in_a_small_file_are_not_broadcast(spark, tmp_path):
    table = spark.range(500).selectExpr("int(id) AS MCD", "'a' AS MFG", "'b' AS AMP", "'c' AS VLT", "'Y' AS SUP", "'N' AS SMT", "'Y' AS ELC")
    stored = lookup.store_models(table, f"{tmp_path}/models")
    meters = spark.range(2000).selectExpr("int(id % 600) AS MCD", "id")
    for n, joined in ((stored.rows, "BroadcastHashJoin"), (lookup.BROADCAST_MODELS + 1, "SortMergeJoin")):
        found = lookup.join_mcd_properties(meters, lookup.StoredModels(stored.table, n))
        assert joined in found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 2000 and found.where("MFG IS NULL").count() == 300
