"""Evaluation tables from actual and predicted classes. One pass with partial sums each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ratio(top: Column, bottom: Column) -> Column:
    """0 where the ratio is undefined."""
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(precision * recall * 2, precision + recall)


def confusion_pairs(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows of each pair of actual and predicted class, whatever the classes are."""
    pair = [F.col(actual).alias("actual"), F.col(predicted).alias("predicted")]
    return df.groupBy(*pair).agg(F.count(F.lit(1)).alias("n"))


def metric_confusion(df: DataFrame, actual: str, predicted: str, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """A row per class, also of classes that are only predicted, and a column per predicted class.

    One pass; ``confusion_pairs`` is for classes that are not known beforehand.
    """
    a, p = F.col(actual), F.col(predicted)
    names = [f"predicted_{c}" for c in classes]
    counts = {
        (row, c): F.count_if((a == row) & (p == c)) for row in classes for c in classes
    }
    rows = F.array(
        *(
            F.struct(F.lit(row).alias("actual"), *(counts[row, c].alias(n) for c, n in zip(classes, names)))
            for row in classes
        )
    )
    return df.agg(rows.alias("rows")).select(F.inline("rows"))


def metric_prf(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1."""
    a, p = F.col(actual), F.col(predicted)
    sums = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(a == p).alias("hits"),
        F.count_if((a == 1) & (p == 1)).alias("tp"),
        F.count_if(p == 1).alias("claimed"),
        F.count_if(a == 1).alias("relevant"),
    )
    return sums.select(
        _ratio(F.col("hits"), F.col("n")).alias("accuracy"),
        _ratio(F.col("tp"), F.col("claimed")).alias("precision"),
        _ratio(F.col("tp"), F.col("relevant")).alias("recall"),
    ).withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def metric_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted averages."""
    pairs = df.groupBy(F.col(actual).alias("a"), F.col(predicted).alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # Each pair counts once for its actual and once for its predicted class.
    sides = pairs.select(
        "n",
        F.explode(
            F.array(
                F.struct(F.col("a").alias("cls"), F.lit(True).alias("is_actual")),
                F.struct(F.col("p").alias("cls"), F.lit(False).alias("is_actual")),
            )
        ).alias("side"),
        (F.col("a") == F.col("p")).alias("hit"),
    ).select("n", "hit", "side.*")
    classes = (
        sides.groupBy("cls")
        .agg(
            F.sum(F.when(F.col("is_actual") & F.col("hit"), F.col("n")).otherwise(0)).alias("tp"),
            F.sum(F.when(~F.col("is_actual"), F.col("n")).otherwise(0)).alias("claimed"),
            F.sum(F.when(F.col("is_actual"), F.col("n")).otherwise(0)).alias("support"),
        )
        .select(
            F.col("cls").cast("string").alias("class"),
            "tp",
            "support",
            _ratio(F.col("tp"), F.col("claimed")).alias("precision"),
            _ratio(F.col("tp"), F.col("support")).alias("recall"),
        )
        .withColumn("f1", _f1(F.col("precision"), F.col("recall")))
    )
    scores = ["precision", "recall", "f1"]
    weight = F.sum("support")
    averages = classes.agg(
        F.struct(*(F.avg(s).alias(s) for s in scores), weight.alias("support")).alias("macro avg"),
        F.struct(
            *(_ratio(F.sum(F.col(s) * F.col("support")), weight).alias(s) for s in scores),
            weight.alias("support"),
        ).alias("weighted avg"),
        F.struct(
            *(_ratio(F.sum("tp"), weight).alias(s) for s in scores), weight.alias("support")
        ).alias("accuracy"),
    )
    names = ["macro avg", "weighted avg", "accuracy"]
    summary = averages.select(
        F.explode(
            F.array(*(F.struct(F.lit(n).alias("class"), F.col(f"`{n}`").alias("s")) for n in names))
        ).alias("row")
    ).select("row.class", "row.s.*")
    return classes.drop("tp").select("class", *scores, "support").unionByName(summary)
