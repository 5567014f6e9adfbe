"""Model features of each consumer, all computed inside its row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline import constants as C
from wattline.functions import rules, stats
from wattline.functions.lists import fill_zero, tail_desc

READINGS = "adv_ut_list"


def _add(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.withColumns({name: F.expr(text) for name, text in columns.items()})


def zscore_features(z: str) -> dict[str, str]:
    """The six latest z-scores, newest first, and the largest |z|."""
    latest = dict(zip(C.Z_COLUMNS, tail_desc(z, 6)))
    return {**latest, "max_abs_zscore": f"coalesce({stats.max_abs(z)}, 0D)"}


def zscore_features_v1(z: str) -> dict[str, str]:
    """Older variant: the tail is 0 unless there are more than five readings."""
    latest = {
        name: f"if(size({z}) > 5, try_element_at({z}, -{i}), 0D)"
        for i, name in enumerate(C.Z_COLUMNS, 1)
    }
    return {**latest, "max_abs_zscore": stats.max_abs(z)}


def range_features(readings: str, low: str) -> dict[str, str]:
    high = f"array_max({readings})"
    return {
        "max_consumption": high,
        "min_consumption": low,
        "consumption_range": f"{high} - {low}",
    }


def add_log_scale(df: DataFrame) -> DataFrame:
    columns = ["min_consumption", "max_consumption", "consumption_range"]
    return _add(df, {c: stats.log1p_scale(c) for c in columns})


def add_statistics(df: DataFrame) -> DataFrame:
    """The 11 statistics of zero-filled readings; all 0 for an empty list."""
    filled = _add(df, {READINGS: fill_zero(READINGS)})
    scored = _add(filled, {"z": stats.zscores(READINGS)})
    features = {
        **zscore_features("z"),
        "max_residual_zscore": stats.residual_z(READINGS),
        **range_features(READINGS, stats.positive_min(READINGS)),
    }
    guarded = {name: f"if(size({READINGS}) = 0, 0D, {text})" for name, text in features.items()}
    return add_log_scale(_add(scored, guarded).drop("z"))


def add_statistics_v1(df: DataFrame) -> DataFrame:
    """Older variant of the statistics. The readings column itself stays as it is."""
    filled = _add(df, {"filled": fill_zero(READINGS)})
    scored = _add(filled, {"z": stats.zscores_or_null("filled")})
    features = {
        **zscore_features_v1("z"),
        "max_residual_zscore": stats.residual_z_v1("filled"),
        **range_features("filled", stats.nonzero_min("filled")),
    }
    return add_log_scale(_add(scored, features).drop("filled", "z"))


def add_weights(df: DataFrame) -> DataFrame:
    return _add(
        df,
        {
            "electronic_weight": rules.electronic_weight(),
            "electromechanical_weight": rules.electromechanical_weight(),
            "common_weight": rules.common_weight(),
        },
    )


def agg_mean_std(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: mean and population deviation of each column."""
    return df.agg(
        *(F.avg(c).alias(f"{c}_mean") for c in columns),
        *(F.stddev_pop(c).alias(f"{c}_std") for c in columns),
    )


def sigmoid(value: Column, mean: Column, std: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp((value - mean) * (-C.SIGMOID_STEEPNESS) / std))


def normalise_sigmoid(df: DataFrame, mode: str = "fit", columns: list[str] | None = None) -> DataFrame:
    """Squash each weight around its mean.

    ``fit`` takes mean and deviation from ``df`` (a scalar subquery of one row, which reads only
    what the weights need); ``fixed`` takes the constants that scoring uses.
    """
    columns = columns or C.WEIGHT_COLUMNS
    if mode == "fixed":
        known = {c: tuple(map(F.lit, C.FIXED_WEIGHT_STATS[c])) for c in columns}
    elif mode == "fit":
        row = agg_mean_std(df, columns)
        row = row.select(F.struct(*row.columns)).scalar()
        known = {c: (row[f"{c}_mean"], row[f"{c}_std"] + C.FLAT_STD) for c in columns}
    else:
        raise ValueError(f"mode is 'fit' or 'fixed', not {mode!r}")
    return df.withColumns(
        {f"{c}_normalized": sigmoid(F.col(c), mean, std) for c, (mean, std) in known.items()}
    )
