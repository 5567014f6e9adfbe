"""Meter-model properties and known defect ranges of serials."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline import constants as C
from wattline.functions.labels import serial_number

MAKE = ("MFG", "AMP", "VLT")
# A range table of up to this many pieces is broadcast; a larger one is joined by shuffle.
BROADCAST_PIECES = 200_000
# So is a table of up to this many models.
BROADCAST_MODELS = 100_000
# Serial blocks spread one make's serials over many join keys. A range is cut into the smallest blocks,
# 2^16 serials or 2^10 times as many and so on, of which it spans at most 2^10 (and one more at its border).
LEVELS = (16, 26, 36, 46, 56)
SPAN = 10


def unique_models(models: DataFrame, on: str, properties: Sequence[str]) -> DataFrame:
    """The properties of each model; raises where a model has more than one row."""
    single = models.where(F.col(on).isNotNull()).groupBy(on).agg(
        F.count(F.lit(1)).alias("_n"), *(F.first(c).alias(c) for c in properties)
    )
    twice = F.raise_error(F.concat(F.lit("model listed more than once: "), F.col(on).cast("string")))
    return single.select(on, *(F.when(F.col("_n") > 1, twice).otherwise(F.col(c)).alias(c) for c in properties))


@dataclass(frozen=True)
class StoredModels:
    """A table of models, each listed once, and how many they are."""

    table: DataFrame
    rows: int


def store_models(
    models: DataFrame, path: str, on: str = "MCD", properties: Sequence[str] = C.MODEL_PROPERTIES
) -> StoredModels:
    """Check once that no model is listed twice, which raises, and keep the table at ``path``."""
    once = unique_models(models, on, properties)
    once.write.parquet(path)
    table = models.sparkSession.read.schema(once.schema).parquet(path)
    return StoredModels(table, table.count())


def join_mcd_properties(
    df: DataFrame,
    models: DataFrame | StoredModels,
    on: str = "MCD",
    properties: Sequence[str] = C.MODEL_PROPERTIES,
) -> DataFrame:
    """Attach model properties; an unknown model gets NULLs, a model listed twice fails the job.

    Stored models are known to be unique: the join reads them as they are, and broadcasts them if their
    number is small. A plain table is checked inside the join. Without a broadcast AQE splits a model
    that holds many meters.
    """
    if isinstance(models, StoredModels):
        table = models.table.select(on, *properties)
        # More are never broadcast: a small file may hold many models.
        return df.join(F.broadcast(table) if models.rows <= BROADCAST_MODELS else table.hint("merge"), on, "left")
    return df.join(unique_models(models, on, properties), on, "left")


def join_mcd_key(df: DataFrame, models: DataFrame | StoredModels, on: str = "MCD") -> DataFrame:
    """Attach make, current and voltage only."""
    return join_mcd_properties(df, models, on, MAKE)


def leveled(ranges: DataFrame) -> DataFrame:
    """Ranges with the width of their blocks, as a power of two, and their first and last block.

    A reversed range holds no serial.
    """
    fits = " ".join(
        f"WHEN shiftright(end_serial, {bits}) - shiftright(start_serial, {bits}) <= {1 << SPAN} THEN {bits}"
        for bits in LEVELS
    )
    return (
        ranges.where("start_serial <= end_serial")
        .withColumn("bits", F.expr(f"CASE {fits} END"))
        .selectExpr("*", "shiftright(start_serial, bits) AS first_block", "shiftright(end_serial, bits) AS last_block")
    )


def disjoint_blocks(ranges: DataFrame, bits: int, make: Sequence[str] = MAKE) -> DataFrame:
    """Ranges of one width cut at block borders, overlaps merged: each serial lies in at most one piece.

    ``ranges`` has the make columns and inclusive ``start_serial`` / ``end_serial``. A window holds
    one make and block, hence at most one row per different start in the block.
    """
    cut = (
        leveled(ranges)
        .where(F.col("bits") == bits)
        .withColumn("block", F.expr("explode(sequence(first_block, last_block))"))
        .selectExpr(
            *make,
            "block",
            f"greatest(start_serial, block * {1 << bits}) AS lo",
            f"least(end_serial, block * {1 << bits} + {(1 << bits) - 1}) AS hi",
        )
        .groupBy(*make, "block", "lo")
        .agg(F.max("hi").alias("hi"))
    )
    within = Window.partitionBy(*make, "block").orderBy("lo")
    reach = F.max("hi").over(within.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum("opens").over(within.rowsBetween(Window.unboundedPreceding, 0))
    return (
        cut.withColumn("opens", F.when(F.col("lo") <= reach, 0).otherwise(1))
        .withColumn("island", island)
        .groupBy(*make, "block", "island")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .drop("island")
    )


def piece_counts(ranges: DataFrame) -> dict[int, int]:
    """An upper bound of the pieces of each width that occurs, from one pass over the range table."""
    total = leveled(ranges).groupBy("bits").agg(F.expr("sum(last_block - first_block + 1)").alias("pieces"))
    return {row["bits"]: int(row["pieces"]) for row in total.collect()}


@dataclass(frozen=True)
class StoredRanges:
    """Disjoint pieces of the defect ranges and their number, by width of block."""

    pieces: Mapping[int, tuple[DataFrame, int]]


def store_ranges(ranges: DataFrame, path: str, make: Sequence[str] = MAKE) -> StoredRanges:
    """Cut the ranges once and keep the pieces below ``path``."""
    kept = {}
    for bits in sorted(piece_counts(ranges)):
        cut, place = disjoint_blocks(ranges, bits, make), f"{path}/{bits}"
        cut.write.parquet(place)
        table = ranges.sparkSession.read.schema(cut.schema).parquet(place)
        kept[bits] = (table, table.count())
    return StoredRanges(kept)


def range_defect_lookup(
    df: DataFrame,
    ranges: DataFrame | StoredRanges,
    serial: str = "MNO",
    make: Sequence[str] = MAKE,
    max_pieces: int = BROADCAST_PIECES,
    counts: Mapping[int, int] | None = None,
) -> DataFrame:
    """Add ``defect_range``: 1 if the serial lies in a range of its make, else 0.

    Equi-join on make and serial block, with the range as residual condition, once per width of
    block that occurs: one, unless a range spans more than 2^26 serials. The pieces of a width are
    disjoint, so no row is doubled. They are broadcast only if their counted number is small.
    More are shuffled by make and block: a make that holds a third of the meters still spreads
    over its blocks. Stored ranges are cut already. ``counts`` are the ``piece_counts`` of a plain
    table, if they are known.
    """
    if isinstance(ranges, StoredRanges):
        found = ranges.pieces
    else:
        known = piece_counts(ranges) if counts is None else counts
        found = {bits: (disjoint_blocks(ranges, bits, make), n) for bits, n in known.items()}
    joined = df.select("*", F.expr(serial_number(serial)).alias("_serial"), F.lit(0).alias("_inside"))
    same_make = " AND ".join(f"m.`{c}` = r.`{c}`" for c in make)
    for bits in sorted(found):
        cut, pieces = found[bits]
        if pieces <= max_pieces:
            cut = F.broadcast(cut)
        inside = f"shiftright(m._serial, {bits}) = r.block AND m._serial BETWEEN r.lo AND r.hi"
        joined = joined.alias("m").join(cut.alias("r"), F.expr(f"{same_make} AND {inside}"), "left").selectExpr(
            "m.* EXCEPT (_inside)", "greatest(m._inside, int(r.lo IS NOT NULL)) AS _inside"
        )
    return joined.select(*(F.col(f"`{c}`") for c in df.columns), F.col("_inside").alias("defect_range"))
