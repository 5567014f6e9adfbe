"""Bounded groups of rows for Python: groups dealt into blocks, many small groups per call.

A group of any size is cut into blocks, and every two blocks meet in one cell. A cell is the unit
that must be in memory at once. One call of the Python function sees all cells of an Arrow batch,
so that a million groups of two rows do not cost a million calls.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.words import release

PORTION = 16 << 20

def block_counts(members: DataFrame, group: str, block: int, least: int = 1) -> DataFrame:
    """``group, blocks`` for groups of at least ``least`` rows."""
    rows = members.groupBy(group).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= least)
    return rows.select(group, F.ceil(F.col("rows") / block).cast("int").alias("blocks"))


def with_blocks(members: DataFrame, group: str, block: int, least: int = 1) -> DataFrame:
    """Members with the number of blocks of their group; groups of fewer rows than ``least`` go.

    Joined on the group and its hash, so that the counts are dealt anew and AQE may split a group
    with very many members.
    """
    counts = block_counts(members, group, block, least).withColumn("k", F.hash(group))
    return members.withColumn("k", F.hash(group)).join(counts, [group, "k"]).drop("k")


def cells(members: DataFrame, own: Column) -> DataFrame:
    """Every two blocks as one cell ``i, j``; ``own`` is a hash that deals a row to a block."""
    dealt = members.withColumn("own", F.pmod(own, F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return (
        dealt.withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .drop("other", "blocks")
    )


def in_blocks(members: DataFrame, own: Column) -> DataFrame:
    """Each row in its one block ``own``, out of ``blocks``; ``own`` is a hash that deals it."""
    return members.withColumn("own", F.pmod(own, F.col("blocks")))


def cross_cells(members: DataFrame) -> DataFrame:
    """Every two different blocks of a group as one cell ``i, j``."""
    others = F.expr("filter(sequence(0, blocks - 1), b -> b != own)")
    dealt = members.where("blocks > 1").withColumn("other", F.explode(others))
    return (
        dealt.withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .drop("other", "blocks")
    )


def _limits(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """First row of each run of equal keys, and the number of rows."""
    fresh = np.zeros(table.num_rows, bool)
    fresh[0] = True
    for key in keys:
        column = table.column(key).combine_chunks()
        if pa.types.is_struct(column.type):
            parts = column.flatten()
        else:
            parts = [column]
        for part in parts:
            fresh[1:] |= pc.not_equal(part[1:], part[:-1]).to_numpy(zero_copy_only=False)
    return np.append(np.flatnonzero(fresh), table.num_rows)


def _portions(table: pa.Table, limits: np.ndarray) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Runs of whole groups of about PORTION bytes, one group at least, each with its own limits."""
    rows = max(1, PORTION * table.num_rows // max(1, table.nbytes))
    low = 0
    while low < len(limits) - 1:
        high = max(low + 1, int(np.searchsorted(limits, limits[low] + rows, "right")) - 1)
        part = table.slice(limits[low], limits[high] - limits[low])
        yield part.combine_chunks(), limits[low : high + 1] - limits[low]
        low = high


def grouped(run: Callable[[pa.Table, np.ndarray], pa.Table], keys: Sequence[str]):
    """For ``mapInArrow`` on rows sorted by ``keys``: ``run`` gets whole groups and their limits.

    What ``run`` builds from wide rows is a multiple of them, so it sees a portion of a batch at a time.
    """

    def go(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in source:
            if not batch.num_rows:
                continue
            fresh = pa.Table.from_batches([batch])
            held = fresh if held is None else pa.concat_tables([held, fresh])
            limits = _limits(held, keys)
            if len(limits) > 2:
                for part, own in _portions(held.slice(0, limits[-2]), limits[:-1]):
                    yield from run(part, own).to_batches()
                held = held.slice(limits[-2])
                release()
        if held is not None and held.num_rows:
            yield from run(held.combine_chunks(), np.array([0, held.num_rows])).to_batches()
        held = None
        release()

    return go


def per_cell(df: DataFrame, keys: Sequence[str], run, schema: str, order: Sequence[str] = ()) -> DataFrame:
    """Each cell's rows together, in the given order."""
    dealt = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    return dealt.mapInArrow(grouped(run, keys), schema)


class Forest:
    """Union-find over row numbers, with the labels as an array for whole-array comparisons."""

    def __init__(self, size: int):
        self.up = np.arange(size)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return int(i)

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j

    def roots(self) -> np.ndarray:
        """The root of every row."""
        while not np.array_equal(self.up, settled := self.up[self.up]):
            self.up = settled
        return self.up

    def apart(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` that are not known to be connected with ``i``."""
        self.up[others] = self.up[self.up[others]]
        settled = self.up[others]
        while not np.array_equal(settled, self.up[settled]):
            settled = self.up[settled]
        self.up[others] = settled
        return others[settled != self.root(i)]


def small_pairs(limits: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows inside each group of 2 to ``most`` rows."""
    first, size = limits[:-1], np.diff(limits)
    left, right = [np.zeros(0, int)], [np.zeros(0, int)]
    for g in np.unique(size[(size > 1) & (size <= most)]):
        a, b = np.triu_indices(int(g), 1)
        at = first[size == g][:, None]
        left.append((at + a).ravel())
        right.append((at + b).ravel())
    return np.concatenate(left), np.concatenate(right)
