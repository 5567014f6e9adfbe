"""Screens. Each turns rows away with a reason; a few drop them silently."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline import constants as C
from wattline.functions.labels import is_supported_model
from wattline.functions.lists import missing_ratio
from wattline.operators.rows import (
    DEFAULT_KEYS,
    compare_latest,
    is_different,
    with_missing_keys,
)


def rejected(df: DataFrame, reason: str) -> DataFrame:
    return df.withColumn(C.REMARKS, F.lit(reason))


def screen_no_consumption(
    master: DataFrame, consumption: DataFrame, keys: Sequence[str] = DEFAULT_KEYS
) -> DataFrame:
    """Master rows without any reading."""
    return rejected(with_missing_keys(master, consumption, keys), C.NO_CONSUMPTION)


def screen_missing_fdt(master: DataFrame, date: str = "FDT") -> DataFrame:
    return rejected(master.where(F.col(date).isNull()), C.MISSING_FDT)


def screen_different_mno(
    latest_master: DataFrame,
    latest_consumption: DataFrame,
    keys: Sequence[str] = DEFAULT_KEYS,
    value: str = "MNO",
) -> DataFrame:
    """Keys whose latest meters differ. Such a reject names the key only."""
    pairs = compare_latest(latest_master, latest_consumption, keys, value)
    different = is_different(F.col(f"{value}_m"), F.col(f"{value}_c"))
    return rejected(pairs.where(different).select(*keys), C.DIFFERENT_MNO)


def exclude_keys(df: DataFrame, turned_away: DataFrame, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """Rows whose key was not turned away."""
    return with_missing_keys(df, turned_away, keys)


def is_short_series(readings: str) -> str:
    return f"size({readings}) <= {C.SHORT_SERIES}"


def is_low_max(readings: str) -> str:
    """No reading above 1, or none at all."""
    return f"NOT coalesce(array_max({readings}) > {C.LOW_MAX}D, false)"


def is_sparse(readings: str) -> str:
    return f"coalesce({missing_ratio(readings)} > {C.MISSING_RATIO_LIMIT}D, false)"


def first_reason(*screens: tuple[str, str]) -> Column:
    """The reason of the first condition that holds, NULL if none does."""
    cases = " ".join(f"WHEN {condition} THEN '{reason}'" for condition, reason in screens)
    return F.expr(f"CASE {cases} END")


def master_path_reason(
    readings: str = "adv_ut_list", mcd: str = "MCD", defect: str = "defect_range"
) -> Column:
    """The first screen of the master path that turns a consumer away, NULL if none."""
    return first_reason(
        (is_short_series(readings), C.LESS_CONSUMPTION),
        (f"{defect} = 1", C.DEFECT_RANGE),
        (is_low_max(readings), C.SILENT_LOW_MAX),
        (f"NOT {is_supported_model(mcd)}", C.UNSUPPORTED_MCD),
    )


def history_path_reason(
    readings: str = "adv_ut_list", mcd: str = "MCD", defect: str = "defect_range"
) -> Column:
    """The same for the history path, whose screens come in another order."""
    return first_reason(
        (is_short_series(readings), C.LESS_CONSUMPTION),
        (is_low_max(readings), C.SILENT_LOW_MAX),
        (is_sparse(readings), C.SILENT_SPARSE),
        (f"{defect} = 1", C.DEFECT_RANGE),
        (f"NOT {is_supported_model(mcd)}", C.UNSUPPORTED_MCD),
    )


def kept_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(C.REMARKS).isNull()).drop(C.REMARKS)


def rejected_rows(df: DataFrame) -> DataFrame:
    """Rows turned away with a reason, silent drops left out."""
    return df.where(F.col(C.REMARKS).isNotNull() & ~F.col(C.REMARKS).isin(C.SILENT_REASONS))


def collect_rejects(parts: Sequence[DataFrame], columns: Sequence[str] = C.REJECT_COLUMNS) -> DataFrame:
    """All rejects in one table; a column that a part lacks is NULL there."""
    narrow = [p.select(*(c for c in columns if c in p.columns)) for p in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), narrow).select(*columns)
