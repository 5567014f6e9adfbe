"""Monthly state of the readings, so that a run reads only the readings that are new.

Below the state's folder each batch has one of its own, named ``batch-<name>``:

    readings/year=<n>   two hashes of each reading that came with this batch for the first time
    months              what these readings bring to each consumer and month

A batch is written beside the others and gets its name by one rename, so a failed job leaves the state as
it was. Nothing is rewritten: late readings give a further row for their month, and rows of one month are
merged when the summary is made. A reading that an earlier batch had is known by its hashes and left out;
only the years that the batch has readings of are looked up. The result is that of all batches read at
once, in the order of their names. Readings are told apart by 128 bits.

An empty batch adds nothing. Readings without a month are state like others, under the year -1.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import constants as C
from wattline.operators import series
from wattline.plans import raw
from wattline.session import names_below, publish_dir, remove_dir, scratch_dir

PREFIX = "batch-"
YEAR, HASHES, BATCH = "year", ("h1", "h2"), "batch"
NO_YEAR = -1
READING_SQL = f"{', '.join(f'{k} string' for k in C.KEYS)}, h1 long, h2 long, {YEAR} int"
MONTH_SQL = (
    f"{', '.join(f'{k} string' for k in C.KEYS)}, {raw.PLACE} int, {series.POSITION} int, {series.VALUE} double, "
    f"{series.CODE} string, code_order decimal(38,0), month_mno string, month_order decimal(38,0), {BATCH} string"
)


def batches(spark: SparkSession, state: str) -> list[str]:
    """Names of the batches in the state, in order."""
    return names_below(spark, state, PREFIX)


def _read(spark: SparkSession, state: str, part: str, schema: str) -> DataFrame:
    found = spark.createDataFrame([], schema)
    for name in batches(spark, state):
        found = found.unionByName(spark.read.schema(schema).parquet(f"{state.rstrip('/')}/{PREFIX}{name}/{part}"))
    return found


def _marked(consumption: DataFrame, many_copies: bool) -> DataFrame:
    """Distinct readings with position, place, year and two hashes of all that they hold."""
    content = [c for c in consumption.columns if c != C.ROW_ORDER]
    # A hash passes over missing values, so which ones are missing is hashed too.
    held = [*content, *(F.col(c).isNull() for c in content)]
    marks = {name: F.xxhash64(F.lit(seed), *held) for seed, name in enumerate(HASHES)}
    year = F.coalesce(F.floor(F.col(series.POSITION) / 12), F.lit(NO_YEAR)).cast("int")
    order = F.col(C.ROW_ORDER).cast("decimal(38,0)")
    placed = raw.placed_months(consumption, many_copies)
    return placed.withColumns({**marks, YEAR: year, C.ROW_ORDER: order})


def _months(fresh: DataFrame, name: str) -> DataFrame:
    """What readings bring to each consumer, month and place."""
    found = series.agg_months(
        fresh,
        "ADV_UT",
        "ENT_CD",
        C.ROW_ORDER,
        raw.PLACE_KEYS,
        extra=[
            F.expr(f"min({C.ROW_ORDER}) FILTER (WHERE ENT_CD IS NOT NULL)").alias("code_order"),
            F.max_by("MNO", C.ROW_ORDER).alias("month_mno"),
            F.max(C.ROW_ORDER).alias("month_order"),
        ],
    )
    return found.withColumn(BATCH, F.lit(name))


def add_batch(
    spark: SparkSession, consumption: DataFrame, state: str, name: str, many_copies: bool = False
) -> bool:
    """Merge a batch of readings; False if the state has one of this name, which is then left alone.

    Names must ascend, as they say which reading came first. One job at a time may add to a state.
    """
    done = batches(spark, state)
    if name in done:
        return False
    if done and name < done[-1]:
        raise ValueError(f"batch {name} comes before {done[-1]}, which is in the state already")
    root = state.rstrip("/")
    fresh_dir = f"{root}/new-{uuid.uuid4().hex}"
    with scratch_dir(spark, "readings") as scratch:
        _marked(consumption, many_copies).write.parquet(f"{scratch}/marked")
        fresh = spark.read.parquet(f"{scratch}/marked")
        if done:
            # Months outside 1677 to 2262 count as missing, so these are 587 years at most.
            years = [r[YEAR] for r in fresh.select(YEAR).distinct().collect()]
            known = _read(spark, state, "readings", READING_SQL).where(F.col(YEAR).isin(years))
            fresh.join(known, [*C.KEYS, YEAR, *HASHES], "left_anti").write.parquet(f"{scratch}/fresh")
            fresh = spark.read.parquet(f"{scratch}/fresh")
        try:
            hashes = fresh.select(*C.KEYS, *HASHES, YEAR).repartitionByRange(YEAR, HASHES[0])
            hashes.write.partitionBy(YEAR).parquet(f"{fresh_dir}/readings")
            _months(fresh, name).write.parquet(f"{fresh_dir}/months")
            publish_dir(spark, fresh_dir, f"{root}/{PREFIX}{name}")
        except BaseException:
            remove_dir(spark, fresh_dir)
            raise
    return True


def summary(spark: SparkSession, state: str) -> DataFrame:
    """What ``raw.summarise_consumption`` gives for the readings of all batches."""
    months = _read(spark, state, "months", MONTH_SQL)
    coded, read = (F.struct(BATCH, order) for order in ("code_order", "month_order"))
    merged = months.groupBy(*raw.PLACE_KEYS, series.POSITION).agg(
        F.sum(series.VALUE).alias(series.VALUE),
        F.min_by(series.CODE, F.when(F.col(series.CODE).isNotNull(), coded)).alias(series.CODE),
        F.max_by("month_mno", read).alias("month_mno"),
        F.max(read).alias("month_order"),
    )
    return raw.summary_of_months(merged)
