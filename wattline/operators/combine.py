"""Stacking labelled datasets and keeping the best row per meter."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline import constants as C
from wattline.functions.labels import is_other_meter, relabel_from_remark
from wattline.operators.rows import top1_per_group

METER = ("CNO", "MNO")


def sql_text(value: str) -> str:
    """A string literal of SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def with_source(df: DataFrame, source: str) -> DataFrame:
    return df.withColumn("SOURCE", F.lit(source))


def union_sources(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Stack the datasets, each tagged with its name."""
    tagged = [with_source(df, name) for name, df in datasets.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def source_rank(names: Sequence[str], priority: Mapping[str, int]) -> list[Column]:
    """Highest priority first, sources without one last, then in the order given."""
    chosen = " ".join(f"WHEN {sql_text(n)} THEN {priority[n]}" for n in names if n in priority)
    place = " ".join(f"WHEN {sql_text(n)} THEN {i}" for i, n in enumerate(names))
    return [
        F.expr(f"CASE SOURCE {chosen or 'WHEN null THEN 0'} END").desc_nulls_last(),
        F.expr(f"CASE SOURCE {place} END").asc_nulls_last(),
    ]


def dedup_priority(
    df: DataFrame,
    names: Sequence[str],
    priority: Mapping[str, int],
    keys: Sequence[str] = METER,
    tie: Sequence[str] = tuple(C.KEYS),
) -> DataFrame:
    """One row per meter, from the source of highest priority; missing keys group together.

    Ties within a source go to the smallest consumer key, which is the order the raw datasets are
    kept in, and then to the smallest values of the other columns, so that equal inputs in any order
    give equal results.
    """
    rest = [c for c in df.columns if c not in (*keys, *tie, "SOURCE")]
    ties = [F.asc(f"`{c}`") for c in (*tie, *rest)]
    return top1_per_group(df, keys, [*source_rank(names, priority), *ties])


def join_report(df: DataFrame, report: DataFrame, keys: Sequence[str] = ("CONS_ID", "CSQ", "MNO", "CNO")) -> DataFrame:
    """Rows that the field report names; a consumer it names twice appears twice."""
    return df.join(report, list(keys))


def drop_other_meter_remark(df: DataFrame, remark: str = "TD REMARKS") -> DataFrame:
    return df.where(f"NOT ({is_other_meter(f'`{remark}`')})")


def relabel_on_report(df: DataFrame, report: DataFrame) -> DataFrame:
    """Labels corrected by the inspectors' findings."""
    remark = "TD REMARKS"
    joined = drop_other_meter_remark(join_report(df, report), remark)
    return joined.withColumn("LABEL", F.expr(relabel_from_remark("LABEL", f"`{remark}`"))).drop(remark)


def join_history(life: DataFrame, names: DataFrame, keys: Sequence[str] = tuple(C.KEYS)) -> DataFrame:
    """Meter-life rows with the consumer number of their key."""
    return life.join(names, list(keys))


def union_pred_rejects(predictions: DataFrame, rejects: DataFrame) -> DataFrame:
    return predictions.unionByName(rejects, allowMissingColumns=True)
