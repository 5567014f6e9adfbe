"""Column handling and scratch tables that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.session import fresh_dir


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: a lost executor costs no recomputation."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quoted(name: str) -> Column:
    """The column of exactly that name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def picked(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, under the operator's own names. Whatever else is there stays out."""
    return df.select(*(quoted(given).alias(own) for own, given in names.items()))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether crc32 of the id's text is divisible by ``folds``; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def share_below(bound: int, rows: int) -> int:
    """Limit for a uniform 32-bit hash that lets about ``bound`` of ``rows`` rows pass."""
    return min(1 << 32, int((1 << 32) * bound / max(rows, 1)))


def hash32(*columns: Column) -> Column:
    """0 to 2^32 - 1, the same on every run."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 32))
