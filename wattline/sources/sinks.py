"""Sinks. The tables between the stages are Parquet, so that lists need no text form.

A table is written beside the one that it replaces, which stays until the new one is whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from wattline import constants as C
from wattline.session import remove_dir, replace_dir, restore_dir


def write_table(df: DataFrame, path: str, *by: str) -> None:
    """Write a table to ``path``, in folders by the given columns; a failure leaves the one that was there.

    The table may be made from the one that it replaces.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    restore_dir(spark, path)
    fresh = f"{path}.new-{uuid.uuid4().hex}"
    try:
        (df.write.partitionBy(*by) if by else df.write).parquet(fresh)
    except BaseException:
        remove_dir(spark, fresh)
        raise
    replace_dir(spark, path, fresh)


def _typed_raw(df: DataFrame, columns: list[str]) -> DataFrame:
    from wattline.sources import schemas

    types = {f.name: f.dataType for f in schemas.COMBINED.fields}
    return df.select(*(df[c].cast(types[c]).alias(c) for c in columns))


def write_raw(df: DataFrame, root: str, dataset: str) -> str:
    path = f"{root.rstrip('/')}/{dataset}_raw"
    write_table(_typed_raw(df, C.RAW_COLUMNS), path)
    return path


def write_combined(df: DataFrame, root: str, names: list[str]) -> str:
    path = f"{root.rstrip('/')}/{'_'.join(names)}"
    write_table(_typed_raw(df, [*C.RAW_COLUMNS, "SOURCE"]), path)
    return path


def write_model_input(df: DataFrame, root: str, name: str) -> str:
    path = f"{root.rstrip('/')}/{name}_model_input"
    write_table(df, path)
    return path


def write_rejects(df: DataFrame, root: str, name: str) -> str:
    """One folder per reason."""
    path = f"{root.rstrip('/')}/{name}_rejects"
    write_table(df, path, C.REMARKS)
    return path


def write_keyless(spark: SparkSession, counted: Sequence[tuple[str, int]], root: str, name: str) -> None:
    """How many rows of each source of a dataset belong to no consumer."""
    table = spark.createDataFrame(list(counted), "source string, rows_without_key long")
    write_table(table.coalesce(1), f"{root.rstrip('/')}/{name}_keyless")


def write_predictions(df: DataFrame, path: str) -> None:
    write_table(df, path)


def write_model(model: PipelineModel, root: str, now: datetime | None = None) -> str:
    """Save under a timestamped name."""
    stamp = (now or datetime.now()).strftime("%Y%m%d_%H%M%S")
    path = f"{root.rstrip('/')}/models/gbt_model_{stamp}"
    model.write().overwrite().save(path)
    return path


def log_run(spark: SparkSession, path: str, run: str, values: Mapping[str, float | str]) -> None:
    """Append a run's parameters, metrics and dataset name, a row each."""
    rows = [(run, k, str(v)) for k, v in values.items()]
    spark.createDataFrame(rows, "run string, name string, value string").coalesce(1).write.mode(
        "append"
    ).parquet(path)
