"""Gradient-boosted trees over the model features with MLlib: fit, select, score, save."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import constants as C
from wattline.functions.rules import score_bin
from wattline.operators import boosting
from wattline.operators.ranking import stratified_split, with_class_weights

WEIGHT, HELD_OUT, SCORE = "class_weight", "is_validation", "PREDICTION_SCORE"
EPSILON = 1e-15


@dataclass(frozen=True)
class TreeParams:
    """Depth, step, borders, L2 term and bootstrap of the production model.

    ``patience`` rounds without a better held-out F1, or log-loss where ``by_f1`` is false, end the fit.
    ``bagging`` is the power of the bootstrap weights; 0 takes the rows as they are.
    """

    trees: int = 700
    step: float = 0.05
    depth: int = 6
    borders: int = 64
    patience: int = 100
    seed: int = 42
    l2: float = 1.0
    bagging: float = 0.5
    by_f1: bool = True


@dataclass(frozen=True)
class Features:
    categorical: tuple[str, ...] = tuple(C.CATEGORICAL_FEATURES)
    numeric: tuple[str, ...] = tuple(C.NUMERIC_FEATURES)

    @property
    def names(self) -> list[str]:
        return [*self.categorical, *self.numeric]

    def only(self, chosen: Sequence[str]) -> Features:
        return Features(
            tuple(c for c in self.categorical if c in chosen),
            tuple(c for c in self.numeric if c in chosen),
        )


def _index(name: str) -> str:
    return f"{name}_index"


def encode_categoricals(df: DataFrame, columns: Sequence[str]) -> StringIndexerModel:
    """Fitted indexer: most frequent value first, ties by value; unseen and missing get one more.

    It keeps one entry per distinct value on the driver, so it is for categories, not identifiers.
    """
    return StringIndexer(
        inputCols=list(columns), outputCols=[_index(c) for c in columns], handleInvalid="keep"
    ).fit(df.select(*columns))


def label_encode(df: DataFrame, column: str, output: str) -> DataFrame:
    """Integer of each category in sorted order; a missing one comes last."""
    indexer = StringIndexer(
        inputCol=column, outputCol=output, stringOrderType="alphabetAsc", handleInvalid="keep"
    )
    return indexer.fit(df.select(column)).transform(df).withColumn(output, F.col(output).cast("int"))


def prepare_training(
    df: DataFrame, keys: Sequence[str], label: str = "LABEL", share: float = 0.2
) -> DataFrame:
    """Add class weight and held-out flag; rows whose label is not 0 or 1 cannot train."""
    weighted = with_class_weights(df.withColumn(label, F.col(label).cast("int")), label, share)
    return stratified_split(weighted, label, keys, share, HELD_OUT)


def fill_numeric(df: DataFrame, features: Features) -> DataFrame:
    """Missing numbers go below all others, as the trees' missing-value rule."""
    return df.fillna(C.NO_RESIDUAL, subset=list(features.numeric))


def train_gbt(
    df: DataFrame, features: Features = Features(), params: TreeParams = TreeParams(), label: str = "LABEL"
) -> PipelineModel:
    """Fit on the rows that are not held out, up to the best held-out round.

    The rounds end ``patience`` after the best one; see ``boosting``. A categorical may have more values
    than there are borders.
    """
    columns = [*features.names, label, WEIGHT, HELD_OUT]
    rows = fill_numeric(df.select(*columns), features)
    learn = rows.where(~F.col(HELD_OUT))
    stages: list = []
    most_values = 0
    if features.categorical:
        indexer = encode_categoricals(learn, features.categorical)
        most_values = max(map(len, indexer.labelsArray)) + 1  # unseen values share one more
        stages.append(indexer)
    inputs = [*map(_index, features.categorical), *features.numeric]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    ready = PipelineModel(stages)
    estimator = GBTClassifier(
        labelCol=label, weightCol=WEIGHT, maxIter=params.trees, stepSize=params.step, maxDepth=params.depth,
        maxBins=max(params.borders, most_values + 1), seed=params.seed,
    )
    table = ready.transform(rows).select("features", label, WEIGHT, HELD_OUT)
    model, _ = boosting.fit(table, estimator, params, label, WEIGHT, HELD_OUT)
    return PipelineModel([*stages, model])


best_round = boosting.best_round


def booster(model: PipelineModel) -> GBTClassificationModel:
    return model.stages[-1]


def importances(model: PipelineModel, features: Features) -> dict[str, float]:
    return dict(zip(features.names, map(float, booster(model).featureImportances.toArray())))


def marked_features(model: PipelineModel, features: Features, spark: SparkSession) -> DataFrame:
    """The model's features with their importances, and which are to stay; one row per feature."""
    rows = list(importances(model, features).items())
    return select_from(spark.createDataFrame(rows, "feature string, importance double"))


def select_from(df: DataFrame, importance: str = "importance") -> DataFrame:
    """Mark the features of a table whose importance reaches the median."""
    threshold = df.agg(F.median(importance)).scalar()
    return df.withColumn("is_selected", F.col(importance) >= threshold)


def chosen_features(marked: DataFrame, features: Features) -> Features:
    return features.only([r["feature"] for r in marked.where("is_selected").collect()])


def reduction(marked: DataFrame) -> DataFrame:
    """One row: how many features there were, how many stay, and their ratio."""
    kept, all_rows = F.count_if("is_selected"), F.count(F.lit(1))
    return marked.agg(
        all_rows.alias("original_features"), kept.alias("selected_features"), (kept / all_rows).alias("feature_reduction_ratio")
    )


def score(model: PipelineModel, df: DataFrame, features: Features = Features()) -> DataFrame:
    """Add the probability of class 1 and its bin; the identifiers stay on the row."""
    scored = model.transform(fill_numeric(df, features))
    added = {"rawPrediction", "probability", "features", *map(_index, features.categorical)}
    return (
        scored.withColumn(SCORE, vector_to_array("probability")[1])
        .withColumn("CATEGORY", F.expr(score_bin(SCORE)))
        .drop(*added)
    )


def evaluate(
    model: PipelineModel, df: DataFrame, features: Features = Features(), label: str = "LABEL"
) -> DataFrame:
    """F1 of class 1, log-loss and accuracy of the training and the held-out rows, in one pass."""
    scored = model.transform(fill_numeric(df, features))
    return evaluate_scores(scored.withColumn(SCORE, vector_to_array("probability")[1]), label)


def evaluate_scores(df: DataFrame, label: str, score: str = SCORE) -> DataFrame:
    """The same from labels of 0 and 1 and the probability of class 1, which is claimed above a half."""
    actual, claimed = F.col(label) == 1, F.col(score) > 0.5
    likelihood = F.when(actual, F.col(score)).otherwise(1 - F.col(score))
    clipped = F.greatest(F.least(likelihood, F.lit(1 - EPSILON)), F.lit(EPSILON))
    sums = df.groupBy(HELD_OUT).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(actual == claimed).alias("hits"),
        F.count_if(actual & claimed).alias("tp"),
        (F.count_if(actual) + F.count_if(claimed)).alias("marked"),
        F.avg(-F.log(clipped)).alias("logloss"),
    )
    return sums.select(
        F.when(F.col(HELD_OUT), "validation").otherwise("learn").alias("part"),
        F.coalesce(F.try_divide(F.col("tp") * 2, F.col("marked")), F.lit(0.0)).alias("f1"),
        "logloss",
        (F.col("hits") / F.col("n")).alias("accuracy"),
    )


def params_row(params: TreeParams) -> dict[str, float]:
    return {k: float(v) for k, v in asdict(params).items()}
