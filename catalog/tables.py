"""Sources and sinks: each query writes a table in the source's format and reads it back."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog import modelling, stages
from catalog import standins as S
from catalog.registry import Tables, query, rounded
from catalog.relational import screen_missing_fdt, screen_no_consumption
from wattline import constants as C
from wattline.plans import model_run
from wattline.session import fresh_dir
from wattline.sources import readers, sinks


def _as_csv(df: DataFrame, label: str, sep: str) -> str:
    """Written with a column in front that no reader asks for."""
    path = fresh_dir(df.sparkSession, label)
    wide = df.withColumn("UNUSED", F.lit("x")).select("UNUSED", *(F.col(f"`{c}`") for c in df.columns))
    wide.write.option("sep", sep).option("header", True).option("escape", '"').csv(path)
    return path


@query("src_consumer", "SELECT CONS_ID, CSQ, CNO, MNO, MCD, FDT, XCHG, ADV FROM master")
def src_consumer(t: Tables) -> DataFrame:
    codes = S.master(t).withColumn("MCD", F.col("MCD").cast("double")).select(*C.CONSUMER_COLUMNS)
    return readers.read_consumer(t.spark, _as_csv(codes, "consumer", "|")).drop(C.ROW_ORDER)


@query("src_consumption", "SELECT CONS_ID, CSQ, MNO, BC_CD, BL_CD, ENT_CD, ADV_UT FROM consumption")
def src_consumption(t: Tables) -> DataFrame:
    path = _as_csv(S.consumption(t).select(*C.CONSUMPTION_COLUMNS), "consumption", "|")
    return readers.read_consumption(t.spark, path).drop(C.ROW_ORDER)


@query("src_report", 'SELECT CONS_ID, CSQ, CNO, MNO, remark AS "TD REMARKS" FROM report')
def src_report(t: Tables) -> DataFrame:
    return readers.read_report(t.spark, _as_csv(S.report(t), "report", ","))


@query("src_master_history", "SELECT DISTINCT CONS_ID, CSQ, CNO FROM master")
def src_master_history(t: Tables) -> DataFrame:
    names = S.master(t).select(*C.KEYS, F.col("CNO").alias("CONS_NUM"), "MNO")
    return readers.read_master_history(t.spark, _as_csv(names, "history", "|"))


def _list_text(items: str, quoted: bool) -> Column:
    def show(x: Column) -> Column:
        text = x.cast("string")
        if quoted:
            text = F.concat(F.lit("'"), text, F.lit("'"))
        return F.coalesce(text, F.lit("None" if quoted else "nan"))

    return F.concat(F.lit("["), F.array_join(F.transform(items, show), ", "), F.lit("]"))


@query(
    "src_meter_life",
    """SELECT m.CONS_ID, m.CSQ, m.MNO, m.MCD, m.is_current_meter, r.idx, r.v AS reading, r.code
FROM life_meters m JOIN (SELECT user_id, event_type, CAST(idx AS INTEGER) AS idx, v, code FROM life_rows) r USING (user_id, event_type)""",
)
def src_meter_life(t: Tables) -> DataFrame:
    text = S.life(t).withColumns(
        {
            "bl_cd_list": _list_text("ent_cd_list", quoted=True),
            "adv_ut_list": _list_text("adv_ut_list", quoted=False),
            "ent_cd_list": _list_text("ent_cd_list", quoted=True),
        }
    )
    life = readers.read_meter_life(t.spark, _as_csv(text.select(*C.METER_LIFE_COLUMNS), "life", ","))
    items = F.posexplode(F.arrays_zip("adv_ut_list", "ent_cd_list")).alias("idx", "item")
    return life.select(*C.KEYS, "MNO", "MCD", "is_current_meter", items).select(
        *C.KEYS, "MNO", "MCD", "is_current_meter", "idx",
        F.col("item.adv_ut_list").alias("reading"), F.col("item.ent_cd_list").alias("code"),
    )


@query("src_mcd", "SELECT MCD, MFG, AMP, VLT, SUP, SMT, ELC FROM models")
def src_mcd(t: Tables) -> DataFrame:
    models = S.models(t).withColumn("MCD", F.col("MCD").cast("double"))
    return readers.read_mcd(t.spark, _as_csv(models, "mcd", ","))


@query("src_defect_range", "SELECT MFG, AMP, VLT, start_serial, end_serial FROM ranges")
def src_defect_range(t: Tables) -> DataFrame:
    names = ["MANUFACTURER", "CURRENT RATING", "VOLTAGE RATING", "STARTING SERIAL NO.", "END SERIAL NO."]
    return readers.read_defect_range(t.spark, _as_csv(S.ranges(t).toDF(*names), "ranges", ","))


RAW_SQL = f"SELECT {stages.KEPT.replace('MCD', 'CAST(MCD AS VARCHAR) AS MCD')}"


def _raw_path(t: Tables) -> str:
    return sinks.write_raw(stages.history_path(t).kept(), fresh_dir(t.spark, "raw"), "D_1")


@query("sink_raw", f"{RAW_SQL} FROM h_screened WHERE REMARKS IS NULL")
def sink_raw(t: Tables) -> DataFrame:
    return stages._flat(t.spark.read.parquet(_raw_path(t)))


@query("src_dataset", f"{RAW_SQL}, 'D_1' AS SOURCE FROM h_screened WHERE REMARKS IS NULL")
def src_dataset(t: Tables) -> DataFrame:
    return stages._flat(readers.read_dataset(t.spark, _raw_path(t), "D_1"))


@query("sink_combined", f"{RAW_SQL}, SOURCE FROM combined")
def sink_combined(t: Tables) -> DataFrame:
    return stages._flat(t.spark.read.parquet(stages.combined_path(t)))


@query("src_combined", f"{RAW_SQL} FROM combined")
def src_combined(t: Tables) -> DataFrame:
    return stages._flat(stages.stored_combined(t))


def _model_input_path(t: Tables) -> str:
    return sinks.write_model_input(modelling.table_of(t), fresh_dir(t.spark, "features"), "D_1_D_2")


@query("sink_model_input", "SELECT CNO, MNO, LABEL, t_1_c_1, t_2_c_3 FROM x_rules")
def sink_model_input(t: Tables) -> DataFrame:
    return t.spark.read.parquet(_model_input_path(t)).select("CNO", "MNO", "LABEL", "t_1_c_1", "t_2_c_3")


@query("src_training", "SELECT CNO, MNO, MFG, ELC, LABEL, round(max_abs_zscore, 6) + 0.0 AS max_abs_zscore FROM x_rules")
def src_training(t: Tables) -> DataFrame:
    table = readers.read_training(t.spark, _model_input_path(t), ["CNO", "MNO"])
    return table.select("CNO", "MNO", "MFG", "ELC", "LABEL", rounded("max_abs_zscore").alias("max_abs_zscore"))


@query(
    "sink_rejects",
    f"""SELECT CONS_ID, CSQ, CNO, MNO, REMARKS FROM (
  SELECT CONS_ID, CSQ, CNO, MNO, '{C.NO_CONSUMPTION}' AS REMARKS FROM master
  WHERE (CONS_ID, CSQ) NOT IN (SELECT (CONS_ID, CSQ) FROM consumption)
  UNION ALL SELECT CONS_ID, CSQ, CNO, MNO, '{C.MISSING_FDT}' FROM master_rows WHERE FDT IS NULL)""",
)
def sink_rejects(t: Tables) -> DataFrame:
    both = screen_no_consumption(t).unionByName(screen_missing_fdt(t))
    path = sinks.write_rejects(both, fresh_dir(t.spark, "rejects"), "D_2")
    return t.spark.read.parquet(path).select(*C.REJECT_COLUMNS)


@query("sink_predictions", modelling.SCORES)
def sink_predictions(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "predictions")
    sinks.write_predictions(model_run.predict_all(modelling.fixed_model(t.spark), modelling.table_of(t)), path)
    return modelling.scores_of(t.spark.read.parquet(path))


@query("sink_model", f"SELECT *, true AS same FROM ({modelling.SCORES})")
def sink_model(t: Tables) -> DataFrame:
    """Scores of the saved and reloaded fixed model, and whether the model trained on the table scores as before its save."""
    table, run = modelling.run_of(t)
    trained = PipelineModel.load(sinks.write_model(run.full, fresh_dir(t.spark, "model")))
    fixed = PipelineModel.load(sinks.write_model(modelling.fixed_model(t.spark), fresh_dir(t.spark, "model")))
    # All models score the same row, so that rows without a key stay.
    before = model_run.predict_all(run.full, table, run.features).withColumnRenamed("PREDICTION_SCORE", "before")
    after = model_run.predict_all(trained, before.drop("CATEGORY", "prediction"), run.features)
    marked = after.withColumn("same", F.col("before") == F.col("PREDICTION_SCORE"))
    found = model_run.predict_all(fixed, marked.drop("CATEGORY", "prediction", "PREDICTION_SCORE"))
    return modelling.scores_of(found, "same")
