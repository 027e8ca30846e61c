"""Embedding whitening by shifted CholeskyQR.

Entries become whole numbers on a fixed grid; rows are centred exactly (n times the row less the
column sums) before anything is multiplied. A distributed pass adds up the Gram matrix of the
rows; its Cholesky factor, shifted on the first pass so that it exists for any conditioning,
orthogonalises the rows through a triangular solve; passes are repeated on the solved rows until
their Gram matrix is the identity. The product of the factors is the R of the centred rows, and
its singular values and right vectors are the deviations and components of the covariance.

Rows never leave the tasks: each task adds up one d x d matrix, these are added in ``FOLDS`` groups
by tasks again, and the driver gets ``FOLDS`` matrices, whatever the number of rows and tasks.
Solved rows are not stored; every pass repeats the solves, which cost no more than the Gram.

Defined cases: rows whose vector is null, or holds null, non-finite or off-grid entries (beyond
2 ** 53 on the grid) are left out, as are rows of another length than the commonest (the longer
of equally common ones); repeated rows count as often as they stand; a null id stays null.
Components whose variance is below ``RANK`` of the largest cannot be told from rounding and are
left out, so a constant table, a single row and an empty table give no rows. A ``deviation`` that
does not fit a long is NULL. There are no texts here; only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streakline.llm.common import SLICE_ROWS
from streakline.session import stage

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
FOLDS = 64
MOST_PASSES = 6
RANK = 1e-12
GRID = 2.0**53
#: Products of the exact deviation are added as 64-bit numbers below this, else as Python's.
SAFE = 2.0**62


def on_grid(embeddings: DataFrame) -> DataFrame:
    """``vec_id, x`` (longs less ``OFFSET``) of the rows that take part; stored."""
    fits = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * SCALE) < GRID))
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").where(F.col("embedding").isNotNull() & F.coalesce(fits, F.lit(False)))
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE).cast("bigint"))
    rows = stage(rows.select("vec_id", x.alias("x")))
    lengths = rows.where(F.size("x") > 0).groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == (lengths["d"] if lengths else 0))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column("x")
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 16 * SLICE_ROWS):
            yield b.slice(at, 16 * SLICE_ROWS)


def _added(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of ``part``, an array made of some rows.

    Added up per task, then by ``FOLDS`` tasks, then here.
    """

    def total(arrays: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        found = None
        for a in arrays:
            found = a if found is None else found + a
        if found is not None:
            yield pa.RecordBatch.from_pydict({"part": [found.tobytes()]}, schema=pa.schema([("part", pa.binary())]))

    def local(batches):
        return total(part(_matrix(b)) for b in _slices(batches) if b.num_rows)

    def folded(batches):
        return total(np.frombuffer(p) for b in batches for p in b.column("part").to_pylist())

    parts = rows.select("x").mapInArrow(lambda b: local(b), "part binary")
    dealt = parts.repartition(FOLDS).mapInArrow(lambda b: folded(b), "part binary")
    found = [np.frombuffer(r["part"]) for r in dealt.collect()]
    return sum(found[1:], found[0])


class Fit:
    """What the passes found: row count, column sums and the solves so far; small, goes to every task."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.factors: list[np.ndarray] = []

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: as longs where they fit, else as Python's numbers."""
        top = max(float(np.abs(x).max(initial=0)) * self.n, max(abs(s) for s in self.sums))
        if top < SAFE:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x).astype(np.float64) / self.n

    def solved(self, x: np.ndarray) -> np.ndarray:
        """The centred rows, orthogonalised by all factors so far."""
        return functools.reduce(solve_rows, self.factors, self.centred(x))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum of (n * x - S) ** 2 of each row."""
        whole = self.scaled(x)
        if float(np.abs(whole).max(initial=0)) ** 2 * whole.shape[1] < SAFE:
            return (whole * whole).sum(axis=1).tolist()
        found = [int(v) for v in (whole.astype(object) ** 2).sum(axis=1)]
        return [v if v < 2**63 else None for v in found]


def solve_rows(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``q`` with ``q @ r = rows`` for an upper triangular ``r``, by substitution column by column."""
    q = np.empty_like(rows)
    for j in range(r.shape[0]):
        q[:, j] = (rows[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def first_shift(gram: np.ndarray, n: int) -> float:
    """Large enough for a Cholesky factor of the rounded Gram matrix, small beside its norm."""
    d = gram.shape[0]
    return 11 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2 * float(np.linalg.norm(gram, 2))


def orthogonalise(rows: DataFrame, fit: Fit) -> np.ndarray:
    """R of the centred rows; the factors of the passes stay in ``fit``."""
    d = len(fit.sums)
    composed = np.eye(d)
    for nth in range(MOST_PASSES):
        found = _added(rows, lambda x: (lambda q: (q.T @ q).ravel())(fit.solved(x)))
        gram = found.reshape(d, d)
        gram = (gram + gram.T) / 2
        if nth and np.abs(gram - np.eye(d)).max() < 1e-13 * d:
            break
        shift = 0.0 if nth else first_shift(gram, fit.n)
        while True:
            try:
                factor = np.linalg.cholesky(gram + shift * np.eye(d)).T
                break
            except np.linalg.LinAlgError:
                # Rows of less than full rank stay so in every pass.
                shift = max(10 * shift, first_shift(gram, fit.n))
        fit.factors = [*fit.factors, factor]
        composed = factor @ composed
    return composed


class Components:
    """Unit eigenvectors of the covariance by falling eigenvalue."""

    def __init__(self, r: np.ndarray, n: int, most: int):
        _, sizes, right = np.linalg.svd(r)
        values = sizes**2 / n
        self.trace = float(values.sum())
        keep = min(most, int((values > RANK * values[0]).sum()))
        self.values, self.vectors = values[:keep], right[:keep].T
        self.scaled = self.vectors / np.sqrt(self.values)


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> tuple[Fit, Components] | None:
    """The fit over ``rows`` (``vec_id, x``); None where nothing varies."""
    counted = _sums(rows)
    if counted is None or counted[0] < 2:
        return None
    fit = Fit(*counted)
    spread = _added(rows, lambda x: np.array([(fit.centred(x) ** 2).sum()]))
    if not spread[0]:
        return None
    return fit, Components(orthogonalise(rows, fit), fit.n, components)


def _sums(rows: DataFrame) -> tuple[int, list[int]] | None:
    """The number of rows and the exact sum of each entry, as decimals: they pass no long."""
    entry = rows.select(F.posexplode("x").alias("at", "x"))
    found = entry.groupBy("at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")).orderBy("at").collect()
    return (found[0]["n"], [int(r["s"]) for r in found]) if found else None


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per remaining vector and component: the whitened entries and how exact they are."""
    rows = on_grid(embeddings)
    ddl = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    found = fit_whitening(rows, components)
    if found is None:
        return rows.sparkSession.createDataFrame([], ddl)
    fit, parts = found
    k = len(parts.values)
    # Centred rows have mean zero up to rounding, so their products are the covariance.
    products = _added(rows, lambda x: (lambda w: (w.T @ w).ravel())(fit.centred(x) @ parts.scaled))
    error = float(np.abs(products.reshape(k, k) / fit.n - np.eye(k)).max())
    explained = parts.values / parts.trace

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            x = _matrix(b)
            many = len(x)
            white = fit.centred(x) @ parts.scaled
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("vec_id").take(pa.array(np.repeat(np.arange(many), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), many)),
                    pa.array(np.full(many * k, fit.n, np.int64)),
                    pa.array(fit.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(many), k))),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, many)),
                    pa.array(np.full(many * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(each, ddl)
