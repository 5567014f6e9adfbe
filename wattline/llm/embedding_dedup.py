"""Near-equal embeddings by a forest of random-projection trees.

Each tree splits the unit vectors by random directions until a leaf holds about LEAF of them. A cut is
the median, unless a group is crowded there, with more than CROWDED of the vectors near the median. Then
it lies where the fewest vectors are near it, between the fifths at both ends; and if those are more than
DENSE, as in a group of copies, the node stays a leaf. A vector within SPILL
of a cut goes to both sides. Vectors that share a leaf of some tree are compared exactly. Trees are
grown on the driver on a bounded sample of about SAMPLE vectors; where the sample has run out, cuts go
through the mean of the last vectors above, so the depth follows the number of all vectors.

With the threshold at cosine 0.9 two linked unit vectors are at most 0.447 apart, about 0.056 along a
random direction of 64. A split parts them with a probability near 0.04, and a pair is lost only if
every tree parts it; ``trees_for`` takes as many trees as bring that below MISS. Closer pairs are safer.

Equal vectors become one class, compared once. A leaf of any size is dealt into blocks, and every two
blocks meet in a cell of at most two blocks of vectors; a pair that shares leaves of several trees
counts in the first. A cell gives link counts and the links of a spanning forest, never its pairs. A
group of g different vectors that all lie within the threshold still costs g * g comparisons, as each
vector's number of links is asked for.

Null, zero, and empty vectors and those with null or non-finite components link with nothing. Vectors
of different lengths do not link. Repeated rows are copies and link with each other. A null id takes
part in links; a component whose ids are all null has no id. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.cells import Forest, block_counts, cells, per_cell, small_pairs
from wattline.llm.components import components
from wattline.llm.tables import hash32, picked, share_below, stored

COSINE = 0.9
LEAF = 200
SPILL = 0.02
SAMPLE = 10_000
BLOCK = 512
CROWDED, DENSE = 0.42, 0.5
FEW_ROWS = 16
FEW_LEAVES = 10_000
MISS = 1e-4
NO_ID = (1 << 63) - 1


def depth_for(rows: int) -> int:
    return max(0, math.ceil(math.log2(max(rows, 1) / LEAF)))


def loss_per_split(width: int, cosine: float = COSINE) -> float:
    """Probability that a split parts two vectors at the threshold: both ends normal along a direction."""
    gap = math.sqrt(2 - 2 * cosine) / math.sqrt(width)
    spread = 1 / math.sqrt(width)
    steps = np.linspace(0, 6, 2001)
    density = np.exp(-(steps**2) / 2) * 2 / math.sqrt(2 * math.pi)
    excess = np.maximum(steps * gap - 2 * SPILL, 0)
    return float((density * excess).sum() * (steps[1] - steps[0]) / (spread * math.sqrt(2 * math.pi)))


def trees_for(rows: int, width: int) -> int:
    lost = 1 - (1 - min(loss_per_split(width), 0.9)) ** depth_for(rows)
    return max(2, math.ceil(math.log(MISS) / math.log(lost))) if lost > 0 else 1


@dataclass
class Tree:
    """Directions and thresholds by node; node k has the children 2k + 1 and 2k + 2."""

    seed: int
    depth: int
    cut: np.ndarray

    def direction(self, node: int, width: int) -> np.ndarray:
        found = np.random.default_rng([self.seed, node]).standard_normal(width)
        return found / np.linalg.norm(found)

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and leaf of every vector; more than one leaf where it lies near splits."""
        done: list[tuple[np.ndarray, int]] = []
        work = [(np.arange(len(x)), 0, 0)]
        while work:
            rows, node, level = work.pop()
            if level == self.depth or np.isnan(self.cut[node]):
                done.append((rows, node))
                continue
            height = x[rows] @ self.direction(node, x.shape[1]) - self.cut[node]
            for side, child in ((height <= SPILL, 2 * node + 1), (height >= -SPILL, 2 * node + 2)):
                if side.any():
                    work.append((rows[side], child, level + 1))
        row = np.concatenate([r for r, _ in done]) if done else np.zeros(0, int)
        leaf = np.concatenate([np.full(len(r), n) for r, n in done]) if done else np.zeros(0, int)
        return row, leaf


def _cut(height: np.ndarray, near: float) -> float:
    """The median, or where the fewest heights are near if a group lies there; NaN if they are too many."""
    height = np.sort(height)
    places = np.quantile(height, np.linspace(0.2, 0.8, 25))
    crowd = np.searchsorted(height, places + near, "right") - np.searchsorted(height, places - near, "left")
    middle = len(places) // 2
    if crowd[middle] <= CROWDED * len(height):
        return float(places[middle])
    best = np.flatnonzero(crowd == crowd.min())
    return float(places[best[len(best) // 2]]) if crowd.min() <= DENSE * len(height) else float("nan")


def grow(seed: int, sample: np.ndarray, depth: int, cosine: float = COSINE) -> Tree:
    """Cut every node by its sample rows; where few are left, at the mean of the last node that had enough."""
    tree = Tree(seed, depth, np.zeros((1 << depth) - 1 if depth else 0))
    width = max(sample.shape[1], 1)
    near = math.sqrt(2 - 2 * cosine) / math.sqrt(width)
    work = [(sample, sample.mean(0) if len(sample) else np.zeros(width), 0, 0)]
    while work:
        x, mean, node, level = work.pop()
        if level == depth:
            continue
        direction = tree.direction(node, width)
        height = x @ direction
        if len(x) >= FEW_ROWS:
            mean = x.mean(0)
            tree.cut[node] = _cut(height, near)
        else:
            tree.cut[node] = mean @ direction
        if not np.isnan(tree.cut[node]):
            low = height <= tree.cut[node]
            work += [(x[low], mean, 2 * node + 1, level + 1), (x[~low], mean, 2 * node + 2, level + 1)]
    return tree


def classes(vectors: DataFrame) -> DataFrame:
    """One row per different usable vector: the smallest id, a hash, how many rows have it."""
    usable = (
        (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    found = (
        vectors.where(F.coalesce(usable, F.lit(False)))
        .groupBy("embedding")
        .agg(F.coalesce(F.min("id"), F.lit(NO_ID)).alias("lo"), F.count(F.lit(1)).alias("copies"))
        .withColumn("h", F.xxhash64("embedding"))
        .withColumn("width", F.size("embedding"))
    )
    return stored(found, "vectors")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that squares neither overflow nor vanish."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


NODES = ("lo", "h")
LINKED = pa.schema(
    [("lo", pa.int64()), ("h", pa.int64()), ("links", pa.int64()), ("to_lo", pa.int64()), ("to_h", pa.int64())]
)
LINKED_SQL = "lo long, h long, links long, to_lo long, to_h long"


def _leaf_type(trees: list[Tree]) -> pa.DataType:
    return pa.int32() if sum(2 << t.depth for t in trees) < 1 << 31 else pa.int64()


def _planter(trees: list[Tree], width: int, element: pa.DataType | None):
    """Each vector once per leaf, with all its leaves; with ``element`` None the leaves alone."""
    base = np.cumsum([0] + [(2 << t.depth) for t in trees])
    kind = _leaf_type(trees)
    schema = pa.schema(
        [("leaf", kind), ("lo", pa.int64()), ("h", pa.int64()), ("copies", pa.int64())]
        + [("embedding", pa.list_(element or pa.null())), ("leaves", pa.list_(kind))]
    )

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for low in range(0, batch.num_rows, 2000):
                part = batch.slice(low, 2000)
                x = _matrix(part.column("embedding"), width)
                found = [t.leaves(x) for t in trees]
                row = np.concatenate([r for r, _ in found])
                leaf = np.concatenate([n + b for (_, n), b in zip(found, base)])
                order = np.lexsort([leaf, row])
                row, leaf = row[order], leaf[order]
                if element is None:
                    yield pa.record_batch([pa.array(leaf, kind)], names=["leaf"])
                    continue
                limits = np.searchsorted(row, np.arange(len(x) + 1))
                own = pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(leaf, kind))
                index = pa.array(row)
                yield pa.record_batch(
                    [pa.array(leaf, kind)]
                    + [part.column(c).take(index) for c in ("lo", "h", "copies")]
                    + [part.column("embedding").cast(pa.list_(element)).take(index), own.take(index)],
                    schema=schema,
                )

    return run


def _linker(width: int, cosine: float):
    def run(table: pa.Table, limits: np.ndarray) -> pa.Table:
        x = _matrix(table.column("embedding"), width)
        nodes = np.stack([table.column(c).to_numpy() for c in NODES], 1)
        copies, leaf = table.column("copies").to_numpy(), table.column("leaf").to_numpy()
        own, one = table.column("own").to_numpy(), table.column("i").to_numpy() == table.column("j").to_numpy()
        lists = table.column("leaves").combine_chunks()
        ends, flat = lists.offsets.to_numpy(), lists.flatten().to_numpy()
        most = int(np.diff(ends).max())
        planted = np.full((len(x), most), -1, flat.dtype)
        planted[np.repeat(np.arange(len(x)), np.diff(ends)), np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], np.diff(ends))] = flat
        forest, count = Forest(len(x)), np.zeros(len(x), np.int64)
        edges: list[tuple[int, int]] = []

        def settle(a: np.ndarray, b: np.ndarray) -> None:
            """Count the linked pairs that share no leaf before this one."""
            for low in range(0, len(a), 8192):
                p, q = a[low : low + 8192], b[low : low + 8192]
                fresh, open_ = np.ones(len(p), bool), np.arange(len(p))
                for k in range(most):  # leaves ascend, and most pairs share their first
                    mine = planted[p[open_], k]
                    open_ = open_[(mine >= 0) & (mine < leaf[p[open_]])]
                    if not len(open_):
                        break
                    shared = (planted[q[open_]] == planted[p[open_], k][:, None]).any(1)
                    fresh[open_[shared]] = False
                    open_ = open_[~shared]
                p, q = p[fresh], q[fresh]
                np.add.at(count, p, copies[q])
                np.add.at(count, q, copies[p])
                edges.extend(e for e in zip(p.tolist(), q.tolist()) if forest.join(*e))

        left, right = small_pairs(limits, 12)
        for low in range(0, len(left), 65536):
            a, b = left[low : low + 65536], right[low : low + 65536]
            fit = (one[a] | (own[a] != own[b])) & (np.einsum("ij,ij->i", x[a], x[b]) >= cosine)
            settle(a[fit], b[fit])
        for low, high in zip(limits[:-1].tolist(), limits[1:].tolist()):
            if high - low > 12:
                near = np.triu(x[low:high] @ x[low:high].T >= cosine, 1)
                a, b = (v + low for v in np.nonzero(near))
                fit = one[a] | (own[a] != own[b])
                settle(a[fit], b[fit])
        some = np.flatnonzero(count)
        a, b = (np.array([e[k] for e in edges], int) for k in (0, 1))
        none = pa.nulls(len(some), pa.int64())
        counted = [pa.array(nodes[some, 0]), pa.array(nodes[some, 1]), pa.array(count[some]), none, none]
        linked = [pa.array(v) for v in (nodes[a, 0], nodes[a, 1], np.zeros(len(a), np.int64), nodes[b, 0], nodes[b, 1])]
        return pa.concat_tables([pa.Table.from_arrays(c, schema=LINKED) for c in (counted, linked)])

    return run


def _of_one_width(found: DataFrame, width: int, rows: int, cosine: float, trees: int | None) -> DataFrame:
    """Link counts and forest links of the classes of one vector length."""
    own = found.where(F.col("width") == width).select("lo", "h", "copies", "embedding")
    drawn = own.where(hash32("h") < share_below(SAMPLE, rows)).select("embedding").toArrow()
    sample = _matrix(drawn.column(0), width) if drawn.num_rows else np.zeros((0, width))
    depth = depth_for(rows)
    forest = [grow(seed, sample, depth, cosine) for seed in range(trees or trees_for(rows, width))]
    single = dict(found.dtypes)["embedding"] == "array<float>"
    kind = "int" if _leaf_type(forest) == pa.int32() else "bigint"
    number = "float" if single else "double"
    schema = f"leaf {kind}, lo long, h long, copies long, embedding array<{number}>, leaves array<{kind}>"
    # Planted twice: the leaves alone to count them, then with the vectors. Only leaves of more than one
    # block come out of the count; they go to every task if they are few, else they are joined by shuffle.
    leaves = own.mapInArrow(_planter(forest, width, None), f"leaf {kind}")
    large = stored(block_counts(leaves, "leaf", BLOCK, least=BLOCK + 1), "large-leaves")
    few = F.broadcast(large) if large.count() <= FEW_LEAVES else large
    element = pa.float32() if single else pa.float64()
    planted = own.mapInArrow(_planter(forest, width, element), schema).join(few, "leaf", "left")
    dealt = cells(planted.withColumn("blocks", F.coalesce("blocks", F.lit(1))), F.hash("lo", "h"))
    return per_cell(dealt, ["leaf", "i", "j"], _linker(width, cosine), LINKED_SQL)


def near_duplicates(
    vectors: DataFrame, id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE,
    trees: int | None = None,
) -> DataFrame:
    """``id, n_links, component_id`` of every row."""
    rows = picked(vectors, id=id, embedding=embedding)
    rows = rows.withColumn("id", F.col("id").cast("long"))
    found = classes(rows)
    widths = {r["width"]: r["n"] for r in found.groupBy("width").agg(F.count(F.lit(1)).alias("n")).collect()}
    linked = None
    for width, n in widths.items():
        more = _of_one_width(found, width, n, cosine, trees)
        linked = more if linked is None else linked.unionByName(more)
    if linked is None:
        return rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    linked = stored(linked, "vector-links")
    counts = linked.where("to_h is null").groupBy("lo", "h").agg(F.sum("links").alias("links"))
    ends = linked.where("to_h is not null").select(
        F.struct("lo", "h").alias("a"), F.struct(F.col("to_lo").alias("lo"), F.col("to_h").alias("h")).alias("b")
    )
    roots = components(ends).select("node.lo", "node.h", F.col("root.lo").alias("up"))
    one = (
        found.select("lo", "h", "copies", "embedding")
        .join(counts, ["lo", "h"], "left")
        .join(roots, ["lo", "h"], "left")
        .select(
            "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.nullif(F.coalesce("up", "lo"), F.lit(NO_ID)).alias("component_id"),
        )
    )
    usable = rows.join(one, "embedding", "left")
    return usable.select(
        "id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )
