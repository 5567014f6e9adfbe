"""Screened rows of several datasets to the table the model trains on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline import constants as C
from wattline.functions import rules
from wattline.operators import features
from wattline.operators.combine import dedup_priority, union_sources
from wattline.operators.training import label_encode


def combine(datasets: Mapping[str, DataFrame], priority: Mapping[str, int]) -> DataFrame:
    """All datasets, one row per meter from the source of highest priority."""
    return dedup_priority(union_sources(datasets), list(datasets), priority)


def model_input(combined: DataFrame, mode: str = "fit") -> DataFrame:
    """Statistics, rules and normalised weights. No shuffle but the one-row fit of the weights."""
    described = features.add_statistics(combined.select(*C.RAW_COLUMNS))
    ruled = features.add_weights(rules.apply_rules(described))
    return features.normalise_sigmoid(ruled, mode).select(
        *C.BASE_COLUMNS,
        *C.STAT_COLUMNS,
        *rules.LIVE_RULES,
        *C.WEIGHT_COLUMNS,
        *(f"{c}_normalized" for c in C.WEIGHT_COLUMNS),
    )


def encode_elc(table: DataFrame) -> DataFrame:
    """The table with ELC as an integer, for models that take numbers only."""
    return label_encode(table, "ELC", "code").withColumn("ELC", F.col("code")).drop("code")


def model_input_v1(combined: DataFrame) -> DataFrame:
    """Older variant: integer score on unfilled readings, no weights."""
    scored = combined.select(*C.RAW_COLUMNS).withColumns(
        {
            "has_consecutive_NR_in_ENT_CD": F.expr(rules.fires(rules.RULES["consecutive_NR"])),
            "computed_score": F.expr(rules.computed_score()),
        }
    )
    return features.add_statistics_v1(scored).select(
        *C.BASE_COLUMNS, "has_consecutive_NR_in_ENT_CD", "computed_score", *C.STAT_COLUMNS
    )
