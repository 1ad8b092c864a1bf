"""Whitening of embeddings by their leading principal components.

Entries become whole numbers, so counts and sums are exact and the scatter about the rounded mean is a sum of whole
numbers too; what rounding left is put right afterwards. Tasks send sums of their rows, never rows. The driver gets the
scatter, whose size depends on the dimension alone: a pivoted Cholesky factor of it is rotated by one-sided Jacobi until its
columns are orthogonal. Their squared norms are the eigenvalues, and the columns at unit length the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.llm.blocks import bounded_batches

SCALE, OFFSET = 1024.0, 100_000  # entry c becomes floor(SCALE * c) + OFFSET
ENTRY_LIMIT = 2.0**52  # entries from here on have no such long
SWEEPS = 60  # of Jacobi; some ten suffice


@dataclass(frozen=True)
class Model:
    """Exact mean of the whole numbers, and the components in order of falling eigenvalue."""

    dims: int
    n: int
    sums: tuple[int, ...]
    components: np.ndarray  # one row each
    eigenvalues: np.ndarray
    trace: float

    @property
    def centre(self) -> list[int]:
        """The mean rounded to whole numbers."""
        return [(2 * s + self.n) // (2 * self.n) for s in self.sums]

    @property
    def rest(self) -> list[int]:
        """Sums less n times the centre."""
        return [s - self.n * m for s, m in zip(self.sums, self.centre)]


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """``l`` with ``l @ l.T`` equal to the positive semidefinite ``a``: a row permutation of a lower trapezoid of the rank of ``a``.

    It stops when no diagonal entry is left above the rounding error of the greatest.
    """
    left = np.array(a, dtype=np.float64)
    size = len(left)
    factor = np.zeros((size, size))
    floor = size * np.finfo(np.float64).eps * max(left.diagonal().max(initial=0.0), 0.0)
    for k in range(size):
        pivot = int(np.argmax(left.diagonal()))
        if not left[pivot, pivot] > floor:
            return factor[:, :k]
        factor[:, k] = left[:, pivot] / np.sqrt(left[pivot, pivot])
        left -= np.outer(factor[:, k], factor[:, k])
        left[pivot, :] = left[:, pivot] = 0.0  # exactly
    return factor


def orthogonal_columns(factor: np.ndarray) -> np.ndarray:
    """Rotate pairs of columns until all are orthogonal to rounding; disjoint pairs turn together."""
    columns = np.array(factor.T)
    count = len(columns)
    if count < 2:
        return columns.T
    ring = list(range(count)) + [-1] * (count % 2)  # -1 sits out
    for _ in range(SWEEPS):
        turned = False
        for _ in range(len(ring) - 1):
            pairs = [(a, b) for a, b in zip(ring[: len(ring) // 2], reversed(ring[len(ring) // 2 :])) if a >= 0 and b >= 0]
            ring = [ring[0], ring[-1], *ring[1:-1]]
            p, q = np.array(pairs).T
            x, y = columns[p], columns[q]
            xx, yy, xy = (x * x).sum(1), (y * y).sum(1), (x * y).sum(1)
            due = np.abs(xy) > np.finfo(np.float64).eps * np.sqrt(xx * yy)
            if not due.any():
                continue
            turned = True
            p, q, x, y = p[due], q[due], x[due], y[due]
            zeta = (yy[due] - xx[due]) / (2 * xy[due])
            tangent = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cosine = (1 / np.hypot(1.0, tangent))[:, None]
            sine = cosine * tangent[:, None]
            columns[p], columns[q] = cosine * x - sine * y, sine * x + cosine * y
        if not turned:
            break
    return columns.T


def principal(scatter: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``scatter / n`` in falling order and the unit eigenvectors as rows, up to the rank."""
    columns = orthogonal_columns(pivoted_cholesky(scatter))
    norms = np.sqrt((columns * columns).sum(0))
    order = np.argsort(-norms, kind="stable")
    order = order[norms[order] > 0]
    return norms[order] ** 2 / n, (columns[:, order] / norms[order]).T


def _whole(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the usable vectors of that length, and their entries as whole numbers."""
    vectors = batch.column("vector")
    found = np.flatnonzero(pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False) == dims)
    flat = vectors.take(pa.array(found)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    entries = flat.reshape(len(found), dims)
    usable = (np.abs(entries) < ENTRY_LIMIT).all(axis=1)  # neither NULL nor NaN passes
    return found[usable], np.floor(entries[usable] * SCALE).astype(np.int64) + OFFSET


def _sums(rows: DataFrame) -> DataFrame:
    """(dims, pos, n, total) per vector length and position; position -1 stands for the length itself."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            lengths = np.unique(pc.fill_null(pc.list_value_length(batch.column("vector")), -1).to_numpy(zero_copy_only=False))
            for dims in lengths[lengths >= 0].tolist():
                _, whole = _whole(batch, dims)
                held = totals.setdefault(dims, [0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)])
                held[0] += len(whole)
                # Halves of 32 bits, so that no sum of longs overflows.
                held[1] += (whole >> 32).sum(axis=0)
                held[2] += (whole & 0xFFFFFFFF).sum(axis=0)
        for dims, (n, high, low) in totals.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "dims": pa.array(np.full(dims + 1, dims), pa.int32()),
                    "pos": pa.array(np.arange(-1, dims), pa.int32()),
                    "n": pa.array(np.full(dims + 1, n), pa.int64()),
                    "high": pa.array(np.append(0, high), pa.int64()),
                    "low": pa.array(np.append(0, low), pa.int64()),
                }
            )

    parts = rows.mapInArrow(partial, "dims int, pos int, n long, high long, low long")
    return parts.groupBy("dims", "pos").agg(
        F.sum("n").alias("n"), F.expr("sum(cast(high AS decimal(38,0)))").alias("high"), F.expr("sum(cast(low AS decimal(38,0)))").alias("low")
    )


def _scatter(rows: DataFrame, model: Model) -> np.ndarray:
    """Sum of the products of centred entries, one matrix row per task to add up."""
    dims, centre = model.dims, np.array(model.centre, np.int64)

    def packed(matrix: np.ndarray, numbers: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"i": pa.array(numbers, pa.int32()), "row": pa.array([r.tobytes() for r in matrix], pa.binary())})

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            centred = (_whole(batch, dims)[1] - centre).astype(np.float64)
            total += centred.T @ centred
        yield packed(total, np.arange(dims))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column("i").to_pylist(), batch.column("row").to_pylist()):
                totals[i] = totals.get(i, 0.0) + np.frombuffer(row)
        if totals:
            yield packed(np.array(list(totals.values())), np.array(list(totals)))

    schema = "i int, row binary"
    lines = rows.mapInArrow(partial, schema).repartition("i").mapInArrow(added, schema).collect()  # dims rows of dims numbers
    scatter = np.zeros((dims, dims))
    for line in lines:
        scatter[line.i] = np.frombuffer(line.row)
    rest = np.array([float(r) for r in model.rest])
    return scatter - np.outer(rest, rest) / model.n  # centred at the mean itself


def _rows(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    bounded_batches(vectors.sparkSession)
    return vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))


def fit(vectors: DataFrame, vector: str = "embedding", components: int = 8) -> Model | None:
    """Mean and leading components of all usable vectors; None without any.

    Usable are vectors without NULL, NaN or infinite entries, of the commonest length (the greater on a tie), whose
    entries are below 2**52 in size.
    """
    rows = _rows(vectors, vector, vector)
    totals = _sums(rows)
    best = totals.filter("pos = -1").orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()
    if not best or not best[0].n or not best[0].dims:
        return None
    dims, n = best[0].dims, best[0].n
    found = {r.pos: int(r.high) * 2**32 + int(r.low) for r in totals.filter(f"dims = {dims} AND pos >= 0").collect()}
    mean = Model(dims, n, tuple(found[i] for i in range(dims)), np.zeros((0, dims)), np.zeros(0), 0.0)
    scatter = _scatter(rows, mean)
    values, directions = principal(scatter, n)
    return Model(dims, n, mean.sums, directions[:components], values[:components], float(scatter.trace()) / n)


def _deviation(centred: np.ndarray, model: Model) -> list[int | None]:
    """Exact sum over dimensions of (n * x - sum) squared; None beyond 38 digits.

    With y = x - centre it is n² Σy² - 2n Σ(y * rest) + Σrest².
    """
    if not len(centred):
        return []
    rest = np.array(model.rest, dtype=object)
    size, most = int(np.abs(centred).max()), max(abs(int(r)) for r in rest)
    fits = model.dims * max(size, most, 1) * max(size, 1) < 2**62
    y, r = (centred, rest.astype(np.int64)) if fits else (centred.astype(object), rest)
    squares, mixed, own, n = (y * y).sum(axis=1).tolist(), (y * r).sum(axis=1).tolist(), sum(int(x) ** 2 for x in rest), model.n
    exact = (n * n * a - 2 * n * b + own for a, b in zip(squares, mixed))
    return [x if x < 10**38 else None for x in exact]


def _projected(rows: DataFrame, model: Model, deviations: bool) -> DataFrame:
    """Per usable vector: key, deviation and whitened values."""
    centre, rest = np.array(model.centre, np.int64), np.array([r / model.n for r in model.rest])
    axes = (model.components / np.sqrt(model.eigenvalues)[:, None]).T
    kind = rows.schema["key"].dataType.simpleString()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, whole = _whole(batch, model.dims)
            centred = whole - centre
            white = (centred - rest) @ axes
            exact = _deviation(centred, model) if deviations else [None] * len(found)
            yield pa.RecordBatch.from_pydict(
                {
                    "key": batch.column("key").take(pa.array(found)),
                    "deviation": pa.array(exact, pa.decimal128(38, 0)),
                    "whitened": pa.FixedSizeListArray.from_arrays(pa.array(white.ravel()), white.shape[1]).cast(pa.list_(pa.float64())),
                }
            )

    return rows.mapInArrow(project, f"key {kind}, deviation decimal(38,0), whitened array<double>")


def identity_error(rows: DataFrame, model: Model) -> float:
    """Largest absolute entry of the whitened values' covariance minus the identity, over all rows."""
    size = len(model.eigenvalues)
    white = _projected(rows, model, deviations=False).select("whitened")

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            w = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            total += w.T @ w
            first += w.sum(axis=0)
        i, j = np.divmod(np.arange(size * (size + 1)), size)
        yield pa.RecordBatch.from_pydict({"i": i, "j": j, "v": np.concatenate([total.ravel(), first])})

    sums = white.mapInArrow(partial, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    found = np.zeros((size + 1, size))
    for r in sums:
        found[r.i, r.j] = r.v
    mean = found[size] / model.n  # the values are centred: this is rounding
    return float(np.abs(found[:size] / model.n - np.outer(mean, mean) - np.eye(size)).max())


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 8) -> DataFrame:
    """One row per usable vector (see ``fit``) and component: ``component`` from 1, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    * ``deviation`` is exact, of 38 digits; NULL beyond.
    * Directions without variance, to rounding, are no components: fewer than ``components`` may come back, and none
      from an empty table or from equal vectors.
    * Repeated rows and NULL keys count and stay like all others. Of equal eigenvalues either may come first.
    * Only the two named columns are read; the key keeps its name and type.
    """
    rows = _rows(vectors, key, vector)
    model = fit(vectors, vector, components)
    kind = rows.schema["key"].dataType.simpleString()
    if model is None or not len(model.eigenvalues):
        schema = f"`{key}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, model)
    shares = ", ".join(f"{float(e) / model.trace!r}D" for e in model.eigenvalues)
    told = _projected(rows, model, deviations=True).selectExpr("key", "deviation", "posexplode(whitened) AS (pos, whitened)")
    return told.selectExpr(
        f"key AS `{key}`",
        "pos + 1 AS component",
        f"{model.n}L AS n",
        "deviation",
        "whitened",
        f"element_at(array({shares}), pos + 1) AS explained",
        f"{error!r}D AS identity_error",
    )
