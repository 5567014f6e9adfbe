"""Whole job from CSV files and one config, and properties of the trained model."""

from __future__ import annotations

import csv
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wattline import constants as C
from wattline.operators import lookup, training
from wattline.plans import model_input, model_run, raw, run_config
from wattline.session import remove_dir, restore_dir, scratch_dir, shared_dir
from wattline.sources import readers, sinks

MONTHS = [f"{y}{m:02d}" for y in (2021, 2022, 2023) for m in range(1, 13)]


def write(path, sep, header, data):
    with open(path, "w", newline="") as out:
        writer = csv.writer(out, delimiter=sep)
        writer.writerow(header)
        writer.writerows(data)
    return str(path)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    root = tmp_path_factory.mktemp("meters")
    master, readings, report, life, names = [], [], [], [], []
    for i in range(80):
        cons, cno, mno = f"{i:05d}", f"{['011', '88', '77'][i % 3]}{i:04d}", f"0{i + 100}"
        mcd = "104.0" if i == 7 else "102.0"
        fixed = "99/99/2020" if i == 3 else "15/01/2021"
        master.append([cons, "1", cno, mno, mcd, fixed, "Y" if i % 4 == 0 else "N", "N", "junk"])
        if i == 5:
            continue
        used = MONTHS[:4] if i == 9 else MONTHS
        for j, month in enumerate(used):
            unit = "" if (i + j) % 11 == 0 else str(50 + (i * 7 + j * 13) % 60 + (400 if i % 4 == 0 and j == 35 else 0))
            meter = "other" if i == 11 else mno
            readings.append([cons, "1", meter, month, "B", "NR" if (i + j) % 5 == 0 else "", unit, "junk"])
        if i == 2:
            readings.append([cons, "", mno, "202101", "B", "", "5", "junk"])
        report.append([cons, "1", cno, mno, "METER OK" if i == 0 else "", "junk"])
        values = [None if (i + j) % 9 == 0 else float(60 + (i + 3 * j) % 40) for j in range(30)]
        codes = [None if j % 3 else "LW" for j in range(30)]
        text = str(values).replace("None", "nan") if i % 2 else str(values)
        life.append([cons, "1", f"L{mno}", "103.0", text, str(codes), str(codes), str(i % 3 != 0)])
        names.append([cons, "1", "x", f"L{cno}"])
    models = [[f"{c}.0", "ACME", "5-20", "230", "Y", "N", "Y" if c == 102 else "N"] for c in (102, 103, 104)]
    ranges = [["ACME", "5-20", "230", 120, 121, 2]]
    range_header = ["MANUFACTURER", "CURRENT RATING", "VOLTAGE RATING", "STARTING SERIAL NO.", "END SERIAL NO.", "QUANTITY"]
    return {
        "root": str(root),
        "consumer": write(root / "master.txt", "|", [*C.CONSUMER_COLUMNS, "EXTRA"], master),
        "consumption": write(root / "readings.txt", "|", [*C.CONSUMPTION_COLUMNS, "EXTRA"], readings),
        "report": write(root / "report.csv", ",", [*C.REPORT_COLUMNS, "EXTRA"], report),
        "names": write(root / "names.txt", "|", ["CONS_ID", "CSQ", "MNO", "CONS_NUM"], names),
        "life": write(root / "life.csv", ",", C.METER_LIFE_COLUMNS, life),
        "mcd": write(root / "mcd.csv", ",", ["MCD", *C.MODEL_PROPERTIES], models),
        "ranges": write(root / "ranges.csv", ",", range_header, ranges),
    }


def test_master_path_accounts_for_every_consumer(spark, files):
    master = readers.read_consumer(spark, files["consumer"])
    screened = raw.screen_master_path(
        master,
        raw.summarise_consumption(readers.read_consumption(spark, files["consumption"])),
        readers.read_mcd(spark, files["mcd"]),
        readers.read_defect_range(spark, files["ranges"]),
    )
    reasons = {r["CONS_ID"]: (r[C.REMARKS], r["CNO"]) for r in screened.rejects().collect()}
    assert {k: v[0] for k, v in reasons.items()} == {
        "00003": C.MISSING_FDT, "00005": C.NO_CONSUMPTION, "00007": C.UNSUPPORTED_MCD,
        "00009": C.LESS_CONSUMPTION, "00011": C.DIFFERENT_MNO, "00020": C.DEFECT_RANGE, "00021": C.DEFECT_RANGE,
    }
    assert reasons["00011"][1] is None and reasons["00007"][1] is not None
    kept = {r["CONS_ID"]: r for r in screened.kept().collect()}
    assert set(kept) | set(reasons) == {f"{i:05d}" for i in range(80)}
    assert not set(kept) & set(reasons)
    assert kept["00002"]["MNO"] == "0102" and kept["00002"]["LABEL"] == 0
    assert all(len(r["ent_cd_list"]) == 36 for r in kept.values())


def test_whole_job(spark, files, tmp_path):
    out = str(tmp_path)
    config = {
        "lookups": {"mcd": files["mcd"], "defect_range": files["ranges"]},
        "combine": {
            "output_directory": out,
            "files": {
                "D_1": {"consumer": files["names"], "consumption": files["life"], "custom_processing": True},
                "D_5": {"consumer": files["consumer"], "consumption": files["consumption"], "report": files["report"]},
            },
        },
        "concatenate": {"output_directory": out, "priority": {"D_1": 0, "D_5": 1}},
        "prepare_model_input": {"output_directory": out},
        "train": {"output_directory": out},
    }
    shared = Path(shared_dir(spark).removeprefix("file:"))
    before = {p.name for p in shared.iterdir() if p.name.startswith(("screened-", "training-rows-"))}
    run = run_config.run_all(spark, config, training.TreeParams(trees=4, depth=3))
    assert {p.name for p in shared.iterdir() if p.name.startswith(("screened-", "training-rows-"))} == before
    keyless = {r["source"]: r["rows_without_key"] for r in spark.read.parquet(f"{out}/D_5_keyless").collect()}
    assert keyless == {"consumer": 0, "consumption": 1}
    assert spark.read.parquet(f"{out}/D_1_keyless").count() == 2
    assert run.metrics["original_features"] == 20
    assert 10 <= run.metrics["selected_features"] <= 20
    d5 = spark.read.parquet(f"{out}/D_5_raw")
    assert d5.where("CONS_ID = '00000'").first()["LABEL"] == 0
    assert d5.where("CONS_ID = '00004'").first()["LABEL"] == 1
    rejects = spark.read.parquet(f"{out}/D_5_rejects")
    assert rejects.count() == 7
    combined = spark.read.parquet(f"{out}/D_1_D_5")
    assert combined.count() == combined.select("CNO", "MNO").distinct().count()
    assert {r["SOURCE"] for r in combined.select("SOURCE").distinct().collect()} == {"D_1", "D_5"}
    table = spark.read.parquet(f"{out}/D_1_D_5_model_input")
    assert table.columns[: len(C.BASE_COLUMNS)] == C.BASE_COLUMNS
    scores = model_run.predict(run.full, table, run.features)
    assert scores.count() == table.count()
    assert scores.where("PREDICTION_SCORE NOT BETWEEN 0 AND 1").count() == 0
    assert scores.where("CATEGORY IS NULL").count() == 0
    scored = run_config.score(spark, {"score": {
        "output_directory": f"{out}/scored", "combined": f"{out}/D_1_D_5", "model": str(next(tmp_path.glob("models/gbt_model_*"))),
        "rejects": [f"{out}/D_5_rejects"],
    }})
    rows = spark.read.parquet(scored)
    assert rows.count() == combined.count() + 7 and rows.where("PREDICTION_SCORE IS NULL").count() == 7
    assert spark.read.parquet(f"{out}/evaluation/confusion").count() == 2
    logged = {r["name"]: r["value"] for r in spark.read.parquet(f"{out}/runs").collect()}
    assert set(logged["selected_names"].split(",")) == set(run.chosen.names) and float(logged["class_weight_1"]) > 0
    assert float(logged["trees"]) == 4 and "f1_validation_original" in logged
    fixed = model_input.model_input(readers.read_combined(spark, f"{out}/D_1_D_5"), "fixed")
    assert fixed.where(F.col("common_weight_normalized").isNull()).count() == 0


def test_missing_keys_are_counted_and_left_out(spark, tmp_path):
    path = write(tmp_path / "m.txt", "|", C.CONSUMER_COLUMNS, [["1", "", "c", "m", "1", "", "", ""], ["NA", "1", "c", "m", "1", "", "", ""], ["2", "1", "c", "007", "80.0", "", "Y", ""]])
    text = readers.read_text_table(spark, path, C.CONSUMER_COLUMNS, "|")
    assert readers.missing_key_count(text).first()[0] == 2
    row = readers.read_consumer(spark, path).collect()
    assert [(r["CONS_ID"], r["MNO"], r["MCD"], r["FDT"]) for r in row] == [("2", "007", 80, None)]


def test_row_order_follows_the_file(spark, tmp_path):
    data = [[str(i), "1", "c", "m", "1", "", "", ""] for i in range(5000)]
    table = readers.read_consumer(spark, write(tmp_path / "o.txt", "|", C.CONSUMER_COLUMNS, data))
    ordered = [r["CONS_ID"] for r in table.orderBy(C.ROW_ORDER).select("CONS_ID").collect()]
    assert ordered == [d[0] for d in data]


@pytest.mark.parametrize("split", ["128m", "20000b", "3000b"])
def test_row_order_follows_the_files_of_a_folder(spark, tmp_path, split):
    """The same rows in one file and in several, the first of which is the smallest."""
    def row(i):
        return ["1", "1", f"m{i}", "202101", "B", f"c{i}", str(i)]

    folder = tmp_path / "in put é%"
    folder.mkdir()
    for name, low, high in (("a", 0, 1), ("b", 1, 3001), ("c%20", 3001, 3019)):
        write(folder / f"{name}.txt", "|", C.CONSUMPTION_COLUMNS, [row(i) for i in range(low, high)])
    one = write(tmp_path / "one.txt", "|", C.CONSUMPTION_COLUMNS, [row(i) for i in range(3019)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        for path in (str(folder), one):
            readings = readers.read_consumption(spark, path)
            assert [r["MNO"] for r in readings.orderBy(C.ROW_ORDER).select("MNO").collect()] == [f"m{i}" for i in range(3019)]
            found = raw.summarise_consumption(readings).first()
            assert found["entries"][0]["code"] == "c0" and found["read_mno"] == "m3018"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_rejects_read_the_readings_once(spark, files, tmp_path):
    raw.summarise_consumption(readers.read_consumption(spark, files["consumption"])).write.parquet(str(tmp_path / "s"))
    screened = raw.screen_master_path(
        readers.read_consumer(spark, files["consumer"]),
        spark.read.parquet(str(tmp_path / "s")),
        readers.read_mcd(spark, files["mcd"]),
        readers.read_defect_range(spark, files["ranges"]),
    )
    assert "readings.txt" not in screened.rejects()._jdf.queryExecution().executedPlan().toString()


def test_scratch_folder_goes_away_also_after_a_failure(spark):
    kept = []
    with pytest.raises(ZeroDivisionError):
        with scratch_dir(spark, "probe") as path:
            kept.append(path)
            spark.range(3).write.parquet(path)
            assert Path(path.removeprefix("file:")).exists()
            1 / 0
    assert not Path(kept[0].removeprefix("file:")).exists()
    remove_dir(spark, kept[0])


def test_each_source_is_read_once(spark, files, tmp_path, monkeypatch):
    """Every CSV source is opened by one job's plan, also on the history path and for the counts."""
    seen = []
    written = type(spark.range(1).write).parquet

    def parquet(self, *args, **kwargs):
        seen.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        return written(self, *args, **kwargs)

    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.parquet", parquet)
    opened = []
    read = readers.read_text_table
    monkeypatch.setattr(readers, "read_text_table", lambda s, path, *a, **k: opened.append(path) or read(s, path, *a, **k))
    config = {
        "lookups": {"mcd": files["mcd"], "defect_range": files["ranges"]},
        "combine": {"output_directory": str(tmp_path), "files": {
            "D_1": {"consumer": files["names"], "consumption": files["life"], "custom_processing": True},
            "D_5": {"consumer": files["consumer"], "consumption": files["consumption"]}}},
    }
    run_config.process_raw(spark, config)
    assert sorted(opened) == sorted(files[k] for k in ("mcd", "ranges", "names", "life", "consumer", "consumption"))
    for part, columns in (("life", C.METER_LIFE_COLUMNS), ("readings", C.CONSUMPTION_COLUMNS), ("master", C.CONSUMER_COLUMNS)):
        unique = {"life": "is_current_meter", "readings": "BL_CD", "master": "XCHG"}[part]
        assert unique in columns and sum(f"{unique}#" in plan and " csv" in plan for plan in seen) == 1, part


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/out"
    sinks.write_table(spark.range(5), path)
    with pytest.raises(Exception):
        sinks.write_table(spark.range(9).selectExpr("if(id = 7, raise_error('stopped'), id) AS id"), path)
    assert spark.read.parquet(path).count() == 5
    sinks.write_table(spark.read.parquet(path).where("id > 1"), path)  # made from what it replaces
    assert spark.read.parquet(path).count() == 3 and [p.name for p in tmp_path.iterdir() if "." in p.name and not p.name.startswith(".")] == []
    (tmp_path / "out").rename(tmp_path / "out.old-1")  # stopped between the two renames
    restore_dir(spark, path)
    assert spark.read.parquet(path).count() == 3


def test_stored_lookups_need_no_aggregation_below_the_join(spark, files, tmp_path):
    models = lookup.store_models(readers.read_mcd(spark, files["mcd"]), f"{tmp_path}/models")
    ranges = lookup.store_ranges(readers.read_defect_range(spark, files["ranges"]), f"{tmp_path}/ranges")
    meters = readers.read_consumer(spark, files["consumer"])
    found = lookup.range_defect_lookup(lookup.join_mcd_properties(meters, models), ranges)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Window" not in plan and plan.count("BroadcastHashJoin") == 2
    plain = lookup.range_defect_lookup(
        lookup.join_mcd_properties(meters, readers.read_mcd(spark, files["mcd"])), readers.read_defect_range(spark, files["ranges"])
    )
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect())) and models.rows == 3
    with pytest.raises(Exception, match="model listed more than once"):
        lookup.store_models(models.table.union(models.table), f"{tmp_path}/twice")
