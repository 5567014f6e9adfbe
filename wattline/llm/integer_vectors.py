"""Vectors as whole numbers: ``floor(scale * c) + shift`` for every component ``c``.

A vector that is null, or holds a null or non-finite component, has no such form and goes. So does one
with a component as large as ``bound``, and one whose length isn't the usual one: the length that most
vectors have, the larger of two equally frequent ones. A table without a usable vector has width 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.tables import picked


def usual_width(rows: DataFrame, vector: str = "vector") -> int:
    """Length that most vectors without a null have; one row per distinct length is counted."""
    sizes = rows.where(f"forall({vector}, c -> c is not null)").groupBy(F.size(vector).alias("width"))
    top = sizes.agg(F.count(F.lit(1)).alias("rows")).where("width > 0").orderBy(F.desc("rows"), F.desc("width")).first()
    return top["width"] if top else 0


def as_integers(rows: DataFrame, width: int, scale: int, shift: int, bound: float) -> DataFrame:
    """The usable rows, with ``x array<int>`` in place of ``vector``."""
    kept = rows.where(f"size(vector) = {width} and forall(vector, c -> c is not null and abs(double(c)) < {bound!r}D)")
    whole = F.expr(f"transform(vector, c -> int(floor({scale} * double(c)) + {shift}))")
    return kept.withColumn("x", whole).drop("vector")


def vectors_of(table: DataFrame, embedding: str, **columns: str) -> DataFrame:
    """The named columns, and the vector as ``vector``."""
    return picked(table, vector=embedding, **columns)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
