"""Monthly (or daily) series: aggregation by position, then one gap-aware list per key.

Positions are integers (see ``functions.dates``), so that one code path serves months and days.
Readings are first summed per key and position, with partial sums before the shuffle. What a key
then brings to one task is at most one row per calendar position, however many readings it has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.lists import let
from wattline.operators.rows import DEFAULT_KEYS

POSITION, VALUE, CODE = "pos", "units", "code"


def sum_or_zero(value: str) -> Column:
    """Sum that skips missing values; 0 where all are missing."""
    return F.expr(f"double(coalesce(sum({value}), 0))")


def first_code(code: str, order: str) -> Column:
    """The first code that is not missing, in row order."""
    return F.expr(f"min_by({code}, {order}) FILTER (WHERE {code} IS NOT NULL)")


def agg_month_span(df: DataFrame, month: str, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min(month).alias("min_month"), F.max(month).alias("max_month")
    )


def agg_month_sum(
    df: DataFrame, value: str, keys: Sequence[str] = DEFAULT_KEYS, position: str = POSITION
) -> DataFrame:
    """One sum per key and position; rows without a position are left out."""
    return (
        df.where(F.col(position).isNotNull())
        .groupBy(*keys, position)
        .agg(sum_or_zero(value).alias(VALUE))
    )


def agg_month_first_code(
    df: DataFrame,
    code: str,
    order: str,
    keys: Sequence[str] = DEFAULT_KEYS,
    position: str = POSITION,
) -> DataFrame:
    return (
        df.where(F.col(position).isNotNull())
        .groupBy(*keys, position)
        .agg(first_code(code, order).alias(CODE))
    )


def agg_months(
    df: DataFrame,
    value: str,
    code: str,
    order: str,
    keys: Sequence[str] = DEFAULT_KEYS,
    position: str = POSITION,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Sum and first code in one pass over the readings."""
    return df.groupBy(*keys, position).agg(
        sum_or_zero(value).alias(VALUE), first_code(code, order).alias(CODE), *extra
    )


def agg_global_range(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.agg(F.min(start).alias(start), F.max(end).alias(end))


def collect_entries(
    monthly: DataFrame,
    fields: Sequence[str],
    keys: Sequence[str] = DEFAULT_KEYS,
    position: str = POSITION,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Per key: its entries in order of position, and the first and last position.

    ``monthly`` must hold one row per key and position. Rows without a position give no entry.
    """
    entry = f"struct({position} AS {POSITION}, {', '.join(fields)})"
    entries = f"sort_array(collect_list({entry}) FILTER (WHERE {position} IS NOT NULL))"
    return monthly.groupBy(*keys).agg(
        F.expr(entries).alias("entries"),
        F.min(position).alias("first_pos"),
        F.max(position).alias("last_pos"),
        *extra,
    )


def dense_list(entries: str, field: str, start: str, kind: str = "double") -> Column:
    """One item per position from ``start`` to the last entry, NULL in the gaps.

    Empty when ``start`` is missing or after the last entry. Each entry brings the gap before it,
    so the list is laid out in one walk without a look-up per position.
    """
    before = f"coalesce(get(kept, i - 1).{POSITION}, {start} - 1)"
    gap = f"array_repeat(CAST(null AS {kind}), e.{POSITION} - {before} - 1)"
    laid_out = f"flatten(transform(kept, (e, i) -> concat({gap}, array(e.{field}))))"
    kept = f"filter({entries}, e -> e.{POSITION} >= {start})"
    return F.expr(f"coalesce({let(kept, 'kept', laid_out)}, CAST(array() AS array<{kind}>))")


def build_series(
    monthly: DataFrame,
    keys: Sequence[str] = DEFAULT_KEYS,
    with_codes: bool = False,
    start: str = "first_pos",
    position: str = POSITION,
) -> DataFrame:
    """Per key the list of readings, and of codes if asked; from its first reading by default."""
    fields = [VALUE, CODE] if with_codes else [VALUE]
    grouped = collect_entries(monthly, fields, keys, position)
    lists = [dense_list("entries", VALUE, start).alias("adv_ut_list")]
    if with_codes:
        lists.append(dense_list("entries", CODE, start, "string").alias("ent_cd_list"))
    return grouped.select(*keys, "first_pos", "last_pos", *lists)


def explode_series(df: DataFrame, items: str, keep: Sequence[str], value: str = VALUE) -> DataFrame:
    """A row per item with its index; a key with an empty list keeps one row."""
    return df.select(*keep, F.posexplode_outer(items).alias("idx", value))


def pivot_months(
    df: DataFrame, value: str, date: str, keys: Sequence[str] = DEFAULT_KEYS
) -> DataFrame:
    """Matrix view: a row per key and year, a column per month of that year.

    The month columns are fixed, so Spark needs no extra pass to find them, and the width does not
    grow with the length of the history.
    """
    named = df.withColumn("year", F.year(date)).withColumn("month", F.month(date))
    wide = named.groupBy(*keys, "year").pivot("month", list(range(1, 13))).agg(F.sum(value))
    return wide.toDF(*keys, "year", *(f"m{m:02d}" for m in range(1, 13)))
