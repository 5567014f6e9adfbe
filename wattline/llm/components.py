"""Connected components of a link table by alternating star steps.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Each round replaces links
by links to smaller neighbours until every node points at the smallest node of its component.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.tables import stored


def _smallest(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("least"))


def _with_smallest(links: DataFrame) -> DataFrame:
    """Each link with the smallest neighbour of its ``u``.

    Joined on the node and its hash: the aggregate is then dealt anew, so that AQE may split a
    node with very many links.
    """
    keyed = links.withColumn("k", F.hash("u"))
    least = _smallest(links).withColumn("k", F.hash("u"))
    return keyed.join(least, ["u", "k"]).drop("k")


def _step(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Large star: larger neighbours go to the smallest of the neighbours and the node.
    large = (
        _with_smallest(both)
        .where("v > u")
        .select(F.col("v").alias("u"), F.least("least", "u").alias("v"))
        .distinct()
    )
    # Small star: the node and its smaller neighbours go to the smallest.
    pairs = _with_smallest(large)
    small = pairs.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
        pairs.select("u", F.col("least").alias("v"))
    )
    return small.where("u != v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node that has a link; the root is the smallest node it reaches.

    Nodes may be of any type that Spark can order. Loops and null ends are ignored; repeated links
    and an empty table are fine. Every round ends in a table in the shared folder.
    """
    left, right = F.col(a), F.col(b)
    now = stored(
        links.where(left != right)
        .select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .distinct(),
        "links",
    )
    mark = _mark(now)
    while mark[0]:
        now = stored(_step(now), "links")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _mark(links: DataFrame) -> tuple:
    """Number of links, and a sum and a parity of their hashes that change with them.

    The sum is over the upper 32 bits, as a sum of whole hashes passes 64 bits and fails the job.
    """
    code: Column = F.xxhash64("u", "v")
    row = links.agg(F.count(F.lit(1)), F.sum(F.shiftright(code, 32)), F.bit_xor(code)).first()
    return tuple(row)
