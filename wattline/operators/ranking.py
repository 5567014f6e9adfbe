"""Split by label and class weights, without gathering a class in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Hex digits of the hash that name a bucket: 65,536 buckets per label.
BUCKET_DIGITS = 4


def row_hash(keys: Sequence[str]) -> Column:
    return F.md5(F.concat_ws("|", *(F.col(k).cast("string") for k in keys)))


def label_cuts(df: DataFrame, label: str, keys: Sequence[str], share: float) -> DataFrame:
    """``label, cut``: the hash of the last held-out row of each label, NULL if none is held out.

    Counts per hash bucket, at most 65,536 per label, tell the bucket in which the share ends. Only
    that bucket's rows are then ranked. Nothing but labels and hashes is read. ``keys`` must identify
    a row.
    """
    hashed = df.where(F.col(label).isNotNull()).select(label, row_hash(keys).alias("_hash"))
    hashed = hashed.withColumn("_bucket", F.substring("_hash", 1, BUCKET_DIGITS))
    buckets = Window.partitionBy(label)
    through = buckets.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    sizes = hashed.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    summed = sizes.select(
        label,
        "_bucket",
        (F.sum("_n").over(through) - F.col("_n")).alias("_before"),
        F.sum("_n").over(through).alias("_through"),
        held_out_rows(F.sum("_n").over(buckets), share).alias("_limit"),
    )
    ends = summed.where("_before < _limit AND _limit <= _through")
    ends = ends.select(label, "_bucket", (F.col("_limit") - F.col("_before")).alias("_place"))
    inside = Window.partitionBy(label, "_bucket").orderBy("_hash")
    ranked = hashed.join(ends, [label, "_bucket"]).withColumn("_rank", F.row_number().over(inside))
    cuts = ranked.where("_rank = _place").select(label, F.col("_hash").alias("cut"))
    return sizes.select(label).distinct().join(cuts, label, "left")


def held_out_rows(size: Column, share: float) -> Column:
    return F.floor(size * share)


def stratified_split(
    df: DataFrame, label: str, keys: Sequence[str], share: float = 0.2, flag: str = "is_validation"
) -> DataFrame:
    """Mark the first ``share`` of each label, in hash order, as validation rows.

    The table itself is neither shuffled nor sorted: it meets one cut per label. The same rows are chosen on every run and every cluster. Rows without a label are left out.
    """
    cuts = label_cuts(df, label, keys, share).withColumnRenamed("cut", "_cut")
    chosen = F.coalesce(row_hash(keys) <= F.col("_cut"), F.lit(False))
    return df.join(cuts, label).withColumn(flag, chosen).drop("_cut")


def agg_value_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def balanced_weights(counts: DataFrame) -> DataFrame:
    """Weight n / (k * n_c) of each class from its count ``n``."""
    whole = counts.agg(
        F.struct(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))
    ).scalar()
    return counts.withColumn("class_weight", whole["rows"] / (whole["classes"] * F.col("n")))


def agg_class_weight(df: DataFrame, label: str) -> DataFrame:
    return balanced_weights(agg_value_counts(df.where(F.col(label).isNotNull()), label))


def with_class_weights(df: DataFrame, label: str, share: float = 0.0) -> DataFrame:
    """Attach each row's class weight, counted without the held-out ``share`` of each class.

    Only labels 0 and 1 are kept, so what is broadcast has two rows.
    """
    binary = df.where(F.col(label).isin(0, 1))
    counts = agg_value_counts(binary, label).withColumn(
        "n", F.col("n") - held_out_rows(F.col("n"), share)
    )
    return binary.join(F.broadcast(balanced_weights(counts).drop("n")), label)
