"""Sources. Identifiers stay text, so that leading zeros survive; numbers are cast one by one."""

from __future__ import annotations

import re
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wattline import constants as C
from wattline.functions.labels import serial_number
from wattline.functions.lists import parse_code_list, parse_reading_list
from wattline.operators.rows import distinct_rows
from wattline.sources import schemas


_MISSING = ", ".join(f"'{text}'" for text in C.MISSING_TEXTS)


def _known(name: str) -> str:
    return f"if(trim(`{name}`) IN ({_MISSING}), null, `{name}`) AS `{name}`"


def _number(name: str) -> Column:
    return F.expr(f"nullif(try_cast({name} AS double), double('NaN'))")


def _whole(name: str) -> Column:
    # Codes may be written as 80.0. One beyond the range of a code is as unknown as none.
    return _number(name).try_cast("int")


# A folder of up to this many files is numbered by a broadcast table of their paths.
NUMBERED_FILES = 100_000
# Rows of one task in the numbers that ``monotonically_increasing_id`` gives: a fixed value of Spark.
TASK_ROWS = 1 << 33
# Bytes of one file that the number of a row has room for.
FILE_BYTES = 1 << 47


def with_row_order(table: DataFrame) -> DataFrame:
    """Number the rows by path of their file, then by their place in it.

    Neither the size of the files nor how Spark packs them into tasks matters. Of a single file the
    blocks come in the order of its bytes anyway, so Spark's own number is enough; of several it is
    the file's rank, the first byte of the block, and the place of the row in it, as one decimal.
    """
    number = F.monotonically_increasing_id()
    paths = sorted(table.inputFiles())
    if len(paths) < 2:
        return table.withColumn(C.ROW_ORDER, number)
    # Spark writes the slashes behind a scheme in two ways.
    first = [(Decimal(rank * FILE_BYTES * TASK_ROWS), re.sub(":/+", ":/", p, count=1)) for rank, p in enumerate(paths)]
    ranks = table.sparkSession.createDataFrame(first, "_first decimal(38,0), _path string")
    block = F.col("_metadata.file_block_start")
    place = (block.cast("decimal(15,0)") * F.lit(TASK_ROWS).cast("decimal(10,0)") + number % TASK_ROWS).cast("decimal(37,0)")
    path = F.expr("regexp_replace(_metadata.file_path, '^([^:/]+):/+', '$1:/')")
    placed = table.select("*", path.alias("_path"), place.alias("_place"))
    ranked = placed.join(F.broadcast(ranks) if len(paths) <= NUMBERED_FILES else ranks, "_path", "left")
    unknown = F.raise_error(F.concat(F.lit("a file that was not listed: "), "_path"))
    order = F.when(F.col("_first").isNull(), unknown).otherwise(F.col("_first") + F.col("_place")).cast("decimal(38,0)")
    return ranked.withColumn(C.ROW_ORDER, order).drop("_path", "_place", "_first")


def read_text_table(
    spark: SparkSession, path: str, columns: Sequence[str], sep: str, ordered: bool = False
) -> DataFrame:
    """The named columns of a CSV file as text, whatever their places in it.

    Of a folder all files must have the same header: Spark reads by place, so another order fails the
    job instead of swapping columns. Cells that spell a missing value become NULL. With ``ordered`` each row carries its place in
    the files, for the steps where the first or last row counts.
    """
    table = spark.read.option("sep", sep).option("header", True).option("enforceSchema", False).option("escape", '"').csv(path)
    kept = list(map(_known, columns))
    return with_row_order(table).selectExpr(*kept, C.ROW_ORDER) if ordered else table.selectExpr(*kept)


def drop_missing_keys(df: DataFrame, keys: Sequence[str] = C.KEYS) -> DataFrame:
    """Rows whose key is complete; the others belong to no consumer."""
    return df.dropna(subset=list(keys))


def _missing_keys(keys: Sequence[str]) -> Column:
    missing = " OR ".join(f"{k} IS NULL" for k in keys)
    return F.expr(f"count_if({missing})").alias("rows_without_key")


def missing_key_count(df: DataFrame, keys: Sequence[str] = C.KEYS) -> DataFrame:
    """One row that says how many rows ``drop_missing_keys`` leaves out."""
    return df.agg(_missing_keys(keys))


def keyless_rows(spark: SparkSession, path: str, sep: str) -> int:
    """How many rows of a file ``drop_missing_keys`` leaves out."""
    return missing_key_count(read_text_table(spark, path, C.KEYS, sep)).first()[0]


def _counted(table: DataFrame, counted: Observation | None) -> DataFrame:
    """``counted`` learns ``rows_without_key`` while the first job reads the table."""
    return table if counted is None else table.observe(counted, _missing_keys(C.KEYS))


def read_consumer(spark: SparkSession, path: str, counted: Observation | None = None) -> DataFrame:
    table = _counted(read_text_table(spark, path, C.CONSUMER_COLUMNS, "|", ordered=True), counted)
    return drop_missing_keys(table.withColumn("MCD", _whole("MCD")))


def read_consumption(spark: SparkSession, path: str, counted: Observation | None = None) -> DataFrame:
    table = _counted(read_text_table(spark, path, C.CONSUMPTION_COLUMNS, "|", ordered=True), counted)
    return drop_missing_keys(table.withColumn("ADV_UT", _number("ADV_UT")))


def read_report(spark: SparkSession, path: str, form: str | None = None) -> DataFrame:
    """Field report, as CSV or Parquet: ``form`` says which, else the suffix does."""
    if (form or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")) == "parquet":
        return spark.read.parquet(path).select(*(F.col(f"`{c}`") for c in C.REPORT_COLUMNS))
    return read_text_table(spark, path, C.REPORT_COLUMNS, ",")


def read_master_history(spark: SparkSession, path: str, counted: Observation | None = None) -> DataFrame:
    """Distinct consumer numbers of a master file."""
    table = _counted(read_text_table(spark, path, [*C.KEYS, "CONS_NUM"], "|"), counted)
    return distinct_rows(drop_missing_keys(table.withColumnRenamed("CONS_NUM", "CNO")))


def read_meter_life(spark: SparkSession, path: str, counted: Observation | None = None) -> DataFrame:
    """One row per meter with its lists, which the file holds as text."""
    table = _counted(read_text_table(spark, path, C.METER_LIFE_COLUMNS, ","), counted)
    return drop_missing_keys(
        table.withColumns(
            {
                "MCD": _whole("MCD"),
                "adv_ut_list": F.expr(parse_reading_list("adv_ut_list")),
                "bl_cd_list": F.expr(parse_code_list("bl_cd_list")),
                "ent_cd_list": F.expr(parse_code_list("ent_cd_list")),
                "is_current_meter": F.col("is_current_meter").try_cast("boolean"),
            }
        )
    )


def read_mcd(spark: SparkSession, path: str) -> DataFrame:
    """Meter models with their six properties."""
    table = read_text_table(spark, path, ["MCD", *C.MODEL_PROPERTIES], ",")
    # A voltage may be written as 230 or 230.0.
    return table.withColumns({"MCD": _whole("MCD"), "VLT": _whole("VLT").cast("string")})


def read_defect_range(spark: SparkSession, path: str) -> DataFrame:
    columns = {
        "MANUFACTURER": "MFG",
        "CURRENT RATING": "AMP",
        "VOLTAGE RATING": "VLT",
        "STARTING SERIAL NO.": "start_serial",
        "END SERIAL NO.": "end_serial",
    }
    table = read_text_table(spark, path, list(columns), ",").withColumnsRenamed(columns)
    return table.withColumns(
        {
            "VLT": _whole("VLT").cast("string"),
            "start_serial": F.expr(serial_number("start_serial")),
            "end_serial": F.expr(serial_number("end_serial")),
        }
    )


def read_dataset(spark: SparkSession, path: str, source: str) -> DataFrame:
    """One raw dataset, tagged with its name."""
    return spark.read.schema(schemas.RAW).parquet(path).withColumn("SOURCE", F.lit(source))


def read_combined(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.COMBINED).parquet(path).select(*C.RAW_COLUMNS)


def read_training(spark: SparkSession, path: str, extra: Sequence[str] = ()) -> DataFrame:
    """Only the columns that training needs."""
    return spark.read.parquet(path).select(*extra, *(f.name for f in schemas.TRAINING.fields))
