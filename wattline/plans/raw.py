"""Raw tables to screened rows with one list of readings per consumer."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline import constants as C
from wattline.functions import dates
from wattline.functions.labels import label_from_current_meter, label_from_flags
from wattline.functions.lists import cycle_dispatch, nan_to_null, tail
from wattline.operators import screens, series
from wattline.operators.combine import join_history, relabel_on_report
from wattline.operators.lookup import StoredModels, StoredRanges, join_mcd_properties, range_defect_lookup
from wattline.operators.rows import (
    distinct_rows,
    first_copies,
    is_different,
    latest_master,
    with_common_keys,
)


@dataclass(frozen=True)
class Screened:
    """``consumers``: a row per consumer with its lists and REMARKS, NULL for those kept.

    Write it once when both the kept and the rejected rows are needed. ``early`` holds the rejects
    that have no series.
    """

    consumers: DataFrame
    early: DataFrame | None = None

    def kept(self) -> DataFrame:
        return screens.kept_rows(self.consumers).select(*C.RAW_COLUMNS)

    def rejects(self) -> DataFrame:
        late = screens.rejected_rows(self.consumers)
        # A consumer whose meters differ is rejected by key alone.
        named = F.col(C.REMARKS) != C.DIFFERENT_MNO
        late = late.withColumns({c: F.when(named, F.col(c)) for c in ("CNO", "MNO")})
        return screens.collect_rejects([late] if self.early is None else [self.early, late])


# Readings without a month are dealt to this many places per consumer, by what they hold.
NO_MONTH_PLACES = 256
PLACE = "_place"
PLACE_KEYS = [*C.KEYS, PLACE]


def read_months(consumption: DataFrame) -> DataFrame:
    """Distinct readings with the position of their bill month."""
    return placed_months(consumption).drop(PLACE)


def placed_months(consumption: DataFrame, many_copies: bool = False) -> DataFrame:
    """Distinct readings with the position of their bill month, all of a consumer's month in one place.

    They cross the network once, dealt by consumer, month and place; whatever groups by ``PLACE_KEYS``
    and the position needs no further shuffle, and no further sort. A reading with a month has place 0. A consumer that holds a third of all readings is spread over its months, and its
    readings without a month over ``NO_MONTH_PLACES``. With ``many_copies`` the readings are dealt as
    whole rows instead, copies dropped before: for a source in which one reading may be repeated so
    often that its copies don't fit one task.
    """
    month = F.expr(f"int({dates.bill_month_position('BC_CD')})")
    if many_copies:
        return distinct_rows(consumption).withColumns({series.POSITION: month, PLACE: F.lit(0)})
    content = [c for c in consumption.columns if c != C.ROW_ORDER]
    spread = F.pmod(F.xxhash64(*content), F.lit(NO_MONTH_PLACES)).cast("int")
    placed = consumption.withColumn(series.POSITION, month).withColumn(
        PLACE, F.when(F.col(series.POSITION).isNull(), spread).otherwise(0)
    )
    return first_copies(placed.repartition(*C.KEYS, series.POSITION, PLACE), [*PLACE_KEYS, series.POSITION])


def summarise_consumption(consumption: DataFrame, many_copies: bool = False) -> DataFrame:
    """A row per consumer: its monthly entries, their span, and the meter read last.

    The readings are shuffled once, to their consumer and month. What goes on to the consumer is a row
    per month, and at most ``NO_MONTH_PLACES`` for the readings without one: those count as the latest
    and give no entry.
    """
    last = F.max(C.ROW_ORDER).alias("month_order")
    monthly = series.agg_months(
        placed_months(consumption, many_copies),
        "ADV_UT",
        "ENT_CD",
        C.ROW_ORDER,
        PLACE_KEYS,
        extra=[F.max_by("MNO", C.ROW_ORDER).alias("month_mno"), last],
    )
    return summary_of_months(monthly)


def summary_of_months(monthly: DataFrame) -> DataFrame:
    """A row per consumer from its rows per month and place."""
    recency = F.struct(F.col(series.POSITION).isNull(), F.col(series.POSITION), F.col("month_order"))
    return series.collect_entries(
        monthly,
        [series.VALUE, series.CODE],
        extra=[F.max_by("month_mno", recency).alias("read_mno")],
    )


def prepare_master(master: DataFrame) -> DataFrame:
    """Distinct master rows with parsed fix date, and a label if the flags are there."""
    rows = distinct_rows(master).withColumn("FDT", F.expr(dates.parse_fix_date("FDT")))
    if {"XCHG", "ADV"} <= set(master.columns):
        rows = rows.withColumn("LABEL", F.expr(label_from_flags("XCHG", "ADV")))
    return rows


def with_lists(summary: DataFrame) -> DataFrame:
    start = dates.series_start("first_pos", dates.month_position("FDT"))
    readings = series.dense_list("entries", series.VALUE, "start_pos")
    codes = series.dense_list("entries", series.CODE, "start_pos", "string")
    return (
        summary.withColumn("start_pos", F.expr(start))
        .withColumns({"adv_ut_list": readings, "ent_cd_list": codes})
        .drop("entries")
    )


def recent_lists(df: DataFrame) -> DataFrame:
    """Readings split by billing cycle, then the last 36 of both lists.

    The code list stays aligned to months even where a split shortens the readings.
    """
    return df.withColumns(
        {
            "adv_ut_list": F.expr(tail(cycle_dispatch("CNO", "adv_ut_list"))),
            "ent_cd_list": F.expr(tail("ent_cd_list")),
        }
    )


def _look_up(
    df: DataFrame,
    models: DataFrame | StoredModels,
    ranges: DataFrame | StoredRanges,
    reason: Column,
    counts: Mapping[int, int] | None,
) -> DataFrame:
    known = join_mcd_properties(df, models)
    return range_defect_lookup(known, ranges, counts=counts).withColumn(C.REMARKS, reason)


def screen_master_path(
    master: DataFrame,
    summary: DataFrame,
    models: DataFrame | StoredModels,
    ranges: DataFrame | StoredRanges,
    counts: Mapping[int, int] | None = None,
) -> Screened:
    """Consumer master and summarised readings to one screened row per consumer.

    Readings without a master row, and master rows without readings, fall out at the one join of
    the two sides, which are both down to a row per consumer by then. ``summary`` comes from
    ``summarise_consumption`` and holds every consumer with readings, so the early rejects take its
    keys as well. Write it once where both kept and rejected rows are wanted: the readings are then
    read once.
    """
    rows = prepare_master(master)
    latest = latest_master(rows.where(F.col("FDT").isNotNull()))
    consumers = recent_lists(with_lists(latest.join(summary, C.KEYS)))
    different = is_different(F.col("MNO"), F.col("read_mno"))
    reason = F.when(different, C.DIFFERENT_MNO).otherwise(screens.master_path_reason())
    undated = with_common_keys(screens.screen_missing_fdt(rows), summary)
    early = screens.collect_rejects([screens.screen_no_consumption(master, summary), undated])
    return Screened(_look_up(consumers, models, ranges, reason, counts), early)


def screen_history_path(
    names: DataFrame,
    life: DataFrame,
    models: DataFrame | StoredModels,
    ranges: DataFrame | StoredRanges,
    counts: Mapping[int, int] | None = None,
) -> Screened:
    """Meter-life lists to one screened row per meter."""
    meters = recent_lists(
        join_history(life, names).withColumn("adv_ut_list", F.expr(nan_to_null("adv_ut_list")))
    )
    screened = _look_up(meters, models, ranges, screens.history_path_reason(), counts)
    label = F.expr(label_from_current_meter("is_current_meter"))
    return Screened(screened.withColumn("LABEL", label))


def apply_report(kept: DataFrame, report: DataFrame | None) -> DataFrame:
    """Labels corrected by a field report; without one, or with an empty one, rows stay as they are."""
    if report is None or report.isEmpty():
        return kept
    return relabel_on_report(kept, report).select(*C.RAW_COLUMNS)
