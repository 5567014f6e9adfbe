"""Train, select features, train again, evaluate, keep the run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline import constants as C
from wattline.operators import metrics
from wattline.operators import training as T
from wattline.session import fresh_dir


@dataclass(frozen=True)
class ModelRun:
    full: PipelineModel
    selected: PipelineModel
    features: T.Features
    chosen: T.Features
    metrics: dict[str, float | str]
    prepared: DataFrame | None = None


def _flat(prefix: str, table: DataFrame) -> dict[str, float]:
    # Two rows: training and held-out part.
    return {
        f"{name}_{row['part']}_{prefix}": row[name]
        for row in table.collect()
        for name in ("f1", "logloss", "accuracy")
    }


def prepared_rows(
    model_input: DataFrame, keys: Sequence[str] = ("CNO", "MNO"), path: str | None = None
) -> DataFrame:
    """Training rows with weight and held-out flag, stored."""
    path = path or fresh_dir(model_input.sparkSession, "training-rows")
    T.prepare_training(model_input, keys).write.parquet(path)
    return model_input.sparkSession.read.parquet(path)


def class_weights(prepared: DataFrame, label: str = "LABEL") -> dict[str, float]:
    """The weight of each class, two rows at most."""
    rows = prepared.select(label, T.WEIGHT).distinct().collect()
    return {f"class_weight_{r[label]}": r[T.WEIGHT] for r in rows}


def held_out_tables(
    model: PipelineModel, prepared: DataFrame, features: T.Features = T.Features(), label: str = "LABEL"
) -> dict[str, DataFrame]:
    """Confusion, scores and report of the model's own predictions of the held-out rows."""
    rows = model.transform(T.fill_numeric(prepared.where(T.HELD_OUT), features))
    pair = rows.select(F.col(label).cast("int").alias("actual"), F.col("prediction").cast("int").alias("predicted"))
    tables = {"confusion": metrics.metric_confusion, "prf": metrics.metric_prf, "report": metrics.metric_report}
    return {name: build(pair, "actual", "predicted") for name, build in tables.items()}


def train_and_select(
    model_input: DataFrame,
    keys: Sequence[str] = ("CNO", "MNO"),
    features: T.Features = T.Features(),
    params: T.TreeParams = T.TreeParams(),
    path: str | None = None,
) -> ModelRun:
    """Fit on all features, keep those of at least median importance, fit again.

    The prepared rows are read once per tree level, so they are written to the shared folder: an
    executor lost during boosting costs no recomputation of the features, and a level reads only the
    columns it needs. ``path`` is where to, a new folder if left out.
    """
    prepared = prepared_rows(model_input, keys, path)
    full = T.train_gbt(prepared, features, params)
    marked = T.marked_features(full, features, model_input.sparkSession)
    chosen = T.chosen_features(marked, features)
    selected = T.train_gbt(prepared, chosen, params)
    record = {
        **T.params_row(params),
        **{name: float(value) for name, value in T.reduction(marked).first().asDict().items()},
        "rounds": float(T.booster(full).getNumTrees),
        "selected_names": ",".join(chosen.names),
        **class_weights(prepared),
        **_flat("original", T.evaluate(full, prepared, features)),
        **_flat("selected", T.evaluate(selected, prepared, chosen)),
    }
    return ModelRun(full, selected, features, chosen, record, prepared)


def predict_all(model: PipelineModel, model_input: DataFrame, features: T.Features = T.Features()) -> DataFrame:
    """The scoring input with score and bin beside it."""
    return T.score(model, model_input, features)


def predict(model: PipelineModel, model_input: DataFrame, features: T.Features = T.Features()) -> DataFrame:
    """Identifiers with score and bin."""
    return T.score(model, model_input, features).select(*C.REJECT_COLUMNS[:4], T.SCORE, "CATEGORY")
