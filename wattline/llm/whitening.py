"""PCA whitening of embeddings: distributed covariance, eigenvectors refined from single precision.

Ogita and Aishima, "Iterative refinement for symmetric eigenvalue decomposition" (2018), and its second
part on clustered eigenvalues (2019).

1. Every component c becomes ``x = floor(64 * c) + 1000000``. The distinct x vectors are the fit list.
2. One pass over the list gives the number n and the exact sums S, a second one the covariance of the
   centred vectors. A task sends one number per pair of dimensions, however many rows it has read; the
   driver gets one symmetric matrix of the vectors' width.
3. Eigenvectors of the matrix in single precision start the refinement. A step takes products of the
   matrices in extended precision and corrects each pair of eigenvectors by its gap, which squares the
   error. Pairs whose eigenvalues are nearer than the step can tell apart form clusters; within the
   space that a cluster spans, the shifted matrix is a small problem of its own, solved in double
   precision, and the refinement goes on from there.
4. A third pass measures the covariance of the whitened list, the fourth whitens all rows.

Rows are dropped as told in ``integer_vectors``; components of 2^24 or more count as non-finite. A null
id stays null, repeated rows and copies stay as rows and count once in the fit. Equal eigenvalues share
a space, of which any orthonormal basis is right. A component without variance, as with fewer different
vectors than components, has ``whitened`` null and takes no part in ``identity_error``; without any
variance ``explained`` and ``identity_error`` are null. Vectors of fewer than ``components`` dimensions
give one row per dimension. A deviation beyond 64 bits is null. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.integer_vectors import as_integers, matrix, usual_width, vectors_of
from wattline.session import scratch_dir

SCALE, SHIFT = 64, 1_000_000
BOUND = float(1 << 24)
COMPONENTS = 16
STEPS = 30
ROWS = 4096  # rows whose outer products are taken at once

Wide = np.longdouble


def _refined(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], float]:
    """One step: better eigenvectors, eigenvalues, clusters that it can't part, size of the correction."""
    lost = np.eye(len(a), dtype=Wide) - x.T @ x
    product = x.T @ (a @ x)
    product = (product + product.T) / 2
    values = np.diag(product) / (1 - np.diag(lost))
    off = product - np.diag(np.diag(product))
    blur = 2 * (np.sqrt((off**2).sum()) + np.sqrt((a**2).sum()) * np.sqrt((lost**2).sum()))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > blur
    # Half of what orthogonality lacks, and a turn that has no such part, whatever its rounding.
    turn = (product + (values[None, :] + values[:, None]) / 2 * lost) / np.where(apart, gap, 1)
    correction = lost / 2 + np.where(apart, turn, 0)
    order = np.argsort(values)
    parts = np.split(order, np.flatnonzero(np.diff(values[order]) > blur) + 1)
    return x + x @ correction, values, [p for p in parts if len(p) > 1], float(np.abs(correction).max(initial=0))


def _parted(a: np.ndarray, x: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    """A cluster's vectors turned, within their space, to eigenvectors of the shifted matrix."""
    own = x[:, cluster]
    images = a @ own
    middle = np.trace(own.T @ images) / len(cluster)
    small = own.T @ (images - middle * own)
    size = np.abs(small).max()
    if size == 0:
        return own
    turn = np.linalg.eigh(((small + small.T) / (2 * size)).astype(float))[1]
    return own @ turn.astype(Wide)


def eigenpairs(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit eigenvectors, as columns, of a symmetric matrix.

    The largest entry of a vector is positive.
    """
    size = np.abs(covariance).max(initial=0) or 1.0
    a = covariance.astype(Wide) / Wide(size)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(Wide)
    before = np.inf
    for _ in range(STEPS):
        x, _, clusters, change = _refined(a, x)
        # The error has been squared; what stops falling is rounding, larger where eigenvalues are close.
        if change < 1e-18 or (change < 1e-6 and change > before / 4):
            break
        for cluster in clusters:
            x[:, cluster] = _parted(a, x, cluster)
        before = change
    values = np.diag(x.T @ a @ x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    x = x * np.sign(x[np.abs(x).argmax(0), np.arange(x.shape[1])])
    return (values[order] * Wide(size)).astype(float), x.astype(float)


@dataclass(frozen=True)
class Whitening:
    """What whitens a row: centre, vectors and eigenvalues. Its size is bounded by the width squared."""

    rows: int
    near: np.ndarray  # whole number next to the mean, per dimension
    rest: np.ndarray  # rows * near - S, in whole numbers
    vectors: np.ndarray  # width x components
    values: np.ndarray
    total: float
    identity_error: float | None = None

    @property
    def solid(self) -> np.ndarray:
        """Components that have variance."""
        return self.values > len(self.near) * np.finfo(float).eps * max(self.total, 0)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.near) + self.rest / self.rows

    def whitened(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return self.centred(x) @ self.vectors / np.sqrt(np.maximum(self.values, 0))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (rows * x - S)^2, exact: with y = x - near it is |rows * y + rest|^2."""
        y = x.astype(object) if np.abs(x - self.near).max(initial=0) > 1 << 20 else x - self.near
        y = y - self.near if y.dtype == object else y
        rest = self.rest.astype(object) if len(self.rest) * self.rows > 1 << 40 else self.rest
        square = (y * y).sum(1).tolist()
        cross = (y * rest).sum(1).tolist()
        last = sum(r * r for r in self.rest.tolist())
        exact = [self.rows * self.rows * a + 2 * self.rows * b + last for a, b in zip(square, cross)]
        return [e if e < 1 << 63 else None for e in exact]


def _sums(rows: DataFrame, width: int, kind: str, step: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of the flat array that ``step`` gives for a block of rows of ``x``.

    Each task sends one array. ``kind`` is the SQL type to add up in.
    """
    sent = pa.schema([("at", pa.int32()), ("value", pa.int64() if kind != "double" else pa.float64())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in source:
            x = matrix(batch.column(0), width).astype(np.int64)
            for low in range(0, len(x), ROWS):
                part = step(x[low : low + ROWS])
                total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch([np.arange(len(total), dtype=np.int32), total], schema=sent)

    schema = "at int, value " + ("double" if kind == "double" else "long")
    found = rows.select("x").mapInArrow(run, schema).groupBy("at").agg(F.sum(F.col("value").cast(kind)).alias("value"))
    return np.array([int(r["value"]) if kind != "double" else r["value"] for r in found.orderBy("at").collect()])


def covariance(rows: DataFrame, width: int, values: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum of the outer products of what ``values`` makes of each row, as one matrix."""
    upper = np.triu_indices(size)

    def step(x: np.ndarray) -> np.ndarray:
        own = values(x)
        return (own.T @ own)[upper]

    found = np.zeros((size, size))
    found[upper] = _sums(rows, width, "double", step)
    return found + np.triu(found, 1).T


def fit(whole: DataFrame, width: int, components: int = COMPONENTS) -> Whitening | None:
    """Fit on the distinct vectors of ``x``; None if there is none."""
    with scratch_dir(whole.sparkSession, "fit-list") as path:
        whole.select("x").distinct().write.parquet(path)
        listed = whole.sparkSession.read.schema("x array<int>").parquet(path)
        rows = listed.count()
        if not rows:
            return None
        sums = [int(s) for s in _sums(listed, width, "decimal(38,0)", lambda x: x.sum(0))]
        near = np.array([(2 * s + rows) // (2 * rows) for s in sums], np.int64)
        rest = np.array([rows * int(m) - s for m, s in zip(near, sums)], np.int64)
        plain = Whitening(rows, near, rest, np.zeros((width, 0)), np.zeros(0), 0.0)
        spread = covariance(listed, width, plain.centred, width) / rows
        values, vectors = eigenpairs(spread)
        count = min(components, width)
        found = Whitening(rows, near, rest, vectors[:, :count], values[:count], float(np.trace(spread)))
        solid = np.flatnonzero(found.solid)
        error = None
        if len(solid):
            # The whitened list has mean 0, as its rows are centred before they are turned.
            measured = covariance(listed, width, lambda x: found.whitened(x)[:, solid], len(solid)) / rows
            error = float(np.abs(measured - np.eye(len(solid))).max())
        return Whitening(rows, near, rest, found.vectors, found.values, found.total, error)


WHITENED = pa.schema(
    [("id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64())]
    + [(c, pa.float64()) for c in ("whitened", "explained", "identity_error")]
)
WHITENED_SQL = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _projector(model: Whitening, width: int):
    solid, count = model.solid, len(model.values)
    explained = [v / model.total if model.total > 0 else None for v in np.maximum(model.values, 0).tolist()]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                x = matrix(part.column(1), width).astype(np.int64)
                rows = len(x)
                hidden = np.tile(~solid, rows)
                each = np.repeat(np.arange(rows), count)
                yield pa.record_batch(
                    [
                        part.column(0).take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * count, model.rows)),
                        pa.array(model.deviations(x), pa.int64()).take(pa.array(each)),
                        pa.array(model.whitened(x).ravel(), pa.float64(), mask=hidden),
                        pa.array(explained * rows, pa.float64()),
                        pa.array([model.identity_error] * (rows * count), pa.float64()),
                    ],
                    schema=WHITENED,
                )

    return run


def whiten(
    vectors: DataFrame, id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error`` per usable row and component."""
    rows = vectors_of(vectors, embedding, id=id).withColumn("id", F.col("id").cast("long"))
    width = usual_width(rows)
    whole = as_integers(rows, width, SCALE, SHIFT, BOUND).select("id", "x")
    model = fit(whole, width, components) if width else None
    if model is None:
        return rows.sparkSession.createDataFrame([], WHITENED_SQL)
    return whole.mapInArrow(_projector(model, width), WHITENED_SQL)
