"""Key sets, distinct rows, the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline import constants as C

DEFAULT_KEYS = tuple(C.KEYS)


def key_set(df: DataFrame, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """Distinct keys; a hot key shrinks to one row per task before the shuffle."""
    return df.select(*keys).distinct()


def with_common_keys(df: DataFrame, other: DataFrame, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """Rows whose key the other side has."""
    return df.join(key_set(other, keys), list(keys), "left_semi")


def with_missing_keys(df: DataFrame, other: DataFrame, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """Rows whose key the other side lacks."""
    return df.join(key_set(other, keys), list(keys), "left_anti")


def keys_intersect(left: DataFrame, right: DataFrame, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    return key_set(left, keys).intersect(key_set(right, keys))


def keys_except(left: DataFrame, right: DataFrame, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    return key_set(left, keys).subtract(key_set(right, keys))


# A filter is made for up to this many keys: 16 bits of each, 20 MB in all, and as much again as a hash table.
FILTER_KEYS = 10_000_000
FILTER_BITS = 16


@dataclass(frozen=True)
class KeyFilter:
    """Words of a bitmap with one bit set per key; a foreign key meets a set bit one time in 16."""

    words: DataFrame
    bits: int
    keys: tuple[str, ...]


def _bit(keys: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits))


def key_filter(
    df: DataFrame, path: str, keys: Sequence[str] = DEFAULT_KEYS, most: int = FILTER_KEYS
) -> KeyFilter | None:
    """The keys of a table as a bitmap, kept at ``path``; None for a table of more than ``most`` rows.

    Its size follows the counted rows, so it is known before it is broadcast.
    """
    rows = df.count()
    if rows > most:
        return None
    bits = max(64, rows * FILTER_BITS // 64 * 64)
    placed = df.select(_bit(keys, bits).alias("_at"))
    words = placed.selectExpr("shiftright(_at, 6) AS _word", "shiftleft(1L, int(_at % 64)) AS _mask")
    words.groupBy("_word").agg(F.bit_or("_mask").alias("_mask")).write.parquet(path)
    return KeyFilter(df.sparkSession.read.schema("_word long, _mask long").parquet(path), bits, tuple(keys))


def with_likely_keys(df: DataFrame, known: KeyFilter | None) -> DataFrame:
    """Rows whose key may be among the known ones; all of them are, and few others.

    It needs no shuffle, so the rest never crosses the network.
    """
    if known is None:
        return df
    at = _bit(known.keys, known.bits)
    probed = df.withColumns({"_at": at}).withColumn("_word", F.shiftright("_at", 6))
    own = F.expr("(_mask & shiftleft(1L, int(_at % 64))) != 0")
    return probed.join(F.broadcast(known.words), "_word").where(own).select(*(F.col(f"`{c}`") for c in df.columns))


def distinct_rows(df: DataFrame, order: str = C.ROW_ORDER) -> DataFrame:
    """Whole-row distinct. If the rows carry their order, each keeps the first one."""
    if order not in df.columns:
        return df.distinct()
    columns = [c for c in df.columns if c != order]
    return df.groupBy(*columns).agg(F.min(order).alias(order))


def top1_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order; missing keys form one group.

    The filter on row_number makes Spark keep one row per key and task before the shuffle, so a
    hot key costs one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def first_copies(df: DataFrame, grouped: Sequence[str], order: str = C.ROW_ORDER) -> DataFrame:
    """Like ``distinct_rows``, by one sort of each task's rows that begins with ``grouped``.

    A task holds the sorted rows and no hash table of them beside; whoever groups by those columns
    next needs no further sort. The rows must be dealt by some of them already, or copies go only
    after a shuffle of whole rows.
    """
    if order not in df.columns:
        return df.distinct()
    columns = [c for c in df.columns if c != order]
    # As grouping would show them: no negative zero.
    plain = {name: F.col(f"`{name}`") + F.lit(0).cast(kind) for name, kind in df.dtypes if kind in ("double", "float")}
    keys = [*grouped, *(c for c in columns if c not in grouped)]
    first = top1_per_group(df.withColumns(plain) if plain else df, [f"`{c}`" for c in keys], [F.asc_nulls_last(f"`{order}`")])
    return first.select(*(f"`{c}`" for c in (*columns, order)))


def _tie(df: DataFrame) -> list[Column]:
    # The last row read wins a tie.
    return [F.desc(C.ROW_ORDER)] if C.ROW_ORDER in df.columns else []


def latest_master(
    df: DataFrame,
    keys: Sequence[str] = DEFAULT_KEYS,
    date: str = "FDT",
    tie: Sequence[Column] | None = None,
) -> DataFrame:
    return top1_per_group(df, keys, [F.desc_nulls_first(date), *(_tie(df) if tie is None else tie)])


def latest_consumption(
    df: DataFrame,
    keys: Sequence[str] = DEFAULT_KEYS,
    month: str = "BC_CD",
    tie: Sequence[Column] | None = None,
) -> DataFrame:
    """A row without a month counts as the latest."""
    return top1_per_group(df, keys, [F.desc_nulls_first(month), *(_tie(df) if tie is None else tie)])


def compare_latest(
    master: DataFrame,
    consumption: DataFrame,
    keys: Sequence[str] = DEFAULT_KEYS,
    value: str = "MNO",
) -> DataFrame:
    """Both sides' latest meter, as ``<value>_m`` and ``<value>_c``."""
    return master.select(*keys, F.col(value).alias(f"{value}_m")).join(
        consumption.select(*keys, F.col(value).alias(f"{value}_c")), list(keys)
    )


def is_different(left: Column, right: Column) -> Column:
    """A value missing on either side, or on both, counts as different."""
    return F.coalesce(left != right, F.lit(True))
