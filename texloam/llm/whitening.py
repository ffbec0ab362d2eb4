"""Whitening of embeddings: leading eigenpairs of their covariance by Jacobi-Davidson.

The covariance is never formed.  All that is asked of it are products with a few
vectors at a time, and a product is one Spark job: every task multiplies its own
centred rows with the vectors and back, and the partial results are summed.

The subspace method works on vectors of the embeddings' dimension, on the driver:
Rayleigh-Ritz in the subspace, for every pair that has not converged a correction
from the projected equation, solved by a few steps of MINRES, and the corrections
widen the subspace.  The equations of all open pairs take their MINRES steps
together, so a step is one product.  Pairs whose residual is at rounding level are
locked, and everything after is kept orthogonal to them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from texloam.llm.common import durable, table

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Steps of MINRES for a correction, further vectors beside those wanted, and rounds at most.
STEPS, EXTRA, ROUNDS = 8, 4, 60
#: Residuals, relative to the largest eigenvalue: rounding level, and what must be reached where rounding is coarser.
LOCKED, ENOUGH = 1e-14, 1e-12
#: Eigenvalues below this share of the largest are none: whitening would divide by rounding errors.
LEAST_SHARE = 1e-12
BLOCK_ROWS = 4096
SEED = 11

Product = Callable[[np.ndarray], np.ndarray]


def minres(product: Product, start: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of A_i x_i = b_i, one column each, after at most ``steps`` products.

    ``product`` applies the symmetric A_i to column i.  Columns that are solved,
    or whose Krylov space is exhausted, stay as they are.
    """
    x = np.zeros_like(start)
    size = np.linalg.norm(start, axis=0)
    live = size > 0
    v_old, v = np.zeros_like(start), start / np.where(live, size, 1)
    beta, eta = np.zeros_like(size), size.copy()
    c_old, c = np.ones_like(size), np.ones_like(size)
    s_old, s = np.zeros_like(size), np.zeros_like(size)
    w_old, w = np.zeros_like(start), np.zeros_like(start)
    for _ in range(steps):
        if not live.any():
            break
        z = product(v)
        alpha = np.sum(v * z, axis=0)
        z = z - alpha * v - beta * v_old
        beta_new = np.linalg.norm(z, axis=0)
        # The two rotations before, then the new one that takes beta_new out.
        delta = c * alpha - c_old * s * beta
        rho_two = s * alpha + c_old * c * beta
        rho_three = s_old * beta
        rho = np.hypot(delta, beta_new)
        go = live & (rho > 0)
        divisor = np.where(go, rho, 1)
        c_old, s_old = c, s
        c, s = np.where(go, delta / divisor, 1), np.where(go, beta_new / divisor, 0)
        w_new = (v - rho_three * w_old - rho_two * w) / divisor
        x = x + np.where(go, c * eta, 0) * w_new
        w_old, w = w, w_new
        eta = -s * eta
        scale = np.abs(alpha) + beta_new + np.abs(beta)
        live = go & (beta_new > 1e-14 * scale) & (np.abs(eta) > 1e-10 * size)
        v_old, v, beta = v, np.where(live, z / np.where(live, beta_new, 1), 0), beta_new
    return x


def _widen(basis: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Orthonormal directions of ``more`` outside ``basis``; none where nothing is left."""
    out = basis
    for column in more.T:
        before = np.linalg.norm(column)
        for _ in range(3):
            column = column - out @ (out.T @ column)
        after = np.linalg.norm(column)
        if after > 1e-10 * before and after > 0:
            column = column / after
            column = column - out @ (out.T @ column)
            out = np.column_stack([out, column / np.linalg.norm(column)])
    return out[:, basis.shape[1] :]


def jacobi_davidson(
    product: Product, dimension: int, wanted: int, steps: int = STEPS, seed: int = SEED
) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, eigenvectors as columns): the ``wanted`` largest of a symmetric positive operator.

    Raises if the residuals do not reach ``ENOUGH``.
    """
    wanted = min(wanted, dimension)
    width = min(dimension, wanted + EXTRA)
    most = min(dimension, 4 * width)
    rng = np.random.default_rng(seed)
    basis = _widen(np.zeros((dimension, 0)), rng.standard_normal((dimension, width)))
    images = product(basis)
    best, stalled = np.inf, 0
    for _ in range(ROUNDS):
        small = basis.T @ images
        values, turns = np.linalg.eigh((small + small.T) / 2)
        values, turns = values[::-1], turns[:, ::-1]
        pairs, moved = basis @ turns[:, :wanted], images @ turns[:, :wanted]
        residuals = moved - pairs * values[:wanted]
        sizes = np.linalg.norm(residuals, axis=0)
        scale = max(abs(values[0]), np.finfo(float).tiny)
        locked = sizes <= LOCKED * scale
        worst = sizes.max() / scale
        stalled = 0 if worst < best / 2 else stalled + 1
        best = min(best, worst)
        if locked.all() or (worst <= ENOUGH and stalled >= 2):
            break
        if basis.shape[1] == dimension and stalled >= 2:
            break  # nothing to add: these are the pairs of the whole operator
        if basis.shape[1] + (~locked).sum() > most and basis.shape[1] < dimension:
            # Start anew from the best directions, with the locked ones among them.
            keep = turns[:, : min(width, turns.shape[1])]
            basis, images = basis @ keep, images @ keep
        open_ = np.flatnonzero(~locked)
        shifts = values[open_]
        fixed = pairs[:, locked]
        own = pairs[:, open_]

        def project(x, fixed=fixed, own=own):
            x = x - fixed @ (fixed.T @ x)
            return x - own * np.sum(own * x, axis=0)

        def shifted(x, shifts=shifts, project=project):
            x = project(x)
            return project(product(x) - shifts * x)

        # Where the subspace is all there is, the same vectors are measured once more.
        if basis.shape[1] < dimension:
            corrections = minres(shifted, -project(residuals[:, open_]), steps)
            more = _widen(basis, np.column_stack([corrections, residuals[:, open_]]))
            more = more[:, : dimension - basis.shape[1]]
            if more.shape[1]:
                basis, images = np.column_stack([basis, more]), np.column_stack([images, product(more)])
                continue
        basis = np.linalg.qr(basis @ turns)[0]
        images = product(basis)
    if worst > ENOUGH and scale > np.finfo(float).tiny:
        raise RuntimeError(f"residual {worst:.1e} after {ROUNDS} rounds")
    return values[:wanted], pairs


def quantised(docs: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and x: whole numbers in place of the entries; rows without a usable vector are dropped."""
    entry = lambda c: c.cast("double")
    usable = ~F.exists(
        vector_col, lambda c: c.isNull() | F.isnan(entry(c)) | (F.abs(entry(c)) == float("inf"))
    )
    rows = docs.filter(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & F.coalesce(usable, F.lit(False)))
    x = F.transform(vector_col, lambda c: F.floor(entry(c) * SCALE).cast("long") + SHIFT)
    return rows.select(F.col(id_col).alias("id"), x.alias("x"))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


@dataclass(frozen=True)
class Fit:
    """What whitening needs: count, sums, largest distance from a sum, eigenpairs, trace of the covariance."""

    n: int
    sums: np.ndarray
    spread: int
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


class Centred:
    """The fit list as blocks of centred rows, and sums over all of them.

    ``vectors`` has a column x of whole numbers, each vector once; it is read
    three times, the blocks once for each sum.
    """

    def __init__(self, vectors: DataFrame, width: int):
        self.width = width
        exploded = vectors.select(F.posexplode("x").alias("axis", "value"))
        rows = exploded.groupBy("axis").agg(
            F.count("*").alias("n"), F.sum("value").alias("s"), F.min("value").alias("low"), F.max("value").alias("high")
        )
        found = sorted(rows.collect())  # one row of an axis
        self.n = int(found[0]["n"])
        self.sums = np.array([r["s"] for r in found], np.int64)
        # Exact: how far n times an entry is from the sum, at most.
        self.spread = max(max(abs(self.n * r["low"] - r["s"]), abs(self.n * r["high"] - r["s"])) for r in found)
        floors = np.array([r["s"] // self.n for r in found], np.int64)
        parts = (self.sums - floors * self.n) / self.n  # of whole numbers: the mean's rest is rounded only once

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                centred = (_matrix(batch.column("x"), width) - floors).astype(np.float64) - parts
                for i in range(0, len(centred), BLOCK_ROWS):
                    yield pa.RecordBatch.from_arrays([pa.array([centred[i : i + BLOCK_ROWS].tobytes()])], ["block"])

        tasks = max(vectors.sparkSession.sparkContext.defaultParallelism, self.n * width // (1 << 22))
        self.floors, self.parts = floors, parts
        self.blocks = durable(vectors.coalesce(tasks).mapInArrow(blocks, "block binary"))

    def total(self, of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
        """The sum over all blocks of what ``of`` gives for each; as many numbers reach the driver as it has."""
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for block in batch.column("block"):
                    part = of(np.frombuffer(block.as_buffer(), np.float64).reshape(-1, width))
                    total = part if total is None else total + part
            if total is not None:
                values = total.ravel()
                arrays = [pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)]
                yield pa.RecordBatch.from_arrays(arrays, ["place", "value"])

        parts = self.blocks.mapInArrow(run, "place int, value double")
        out = np.zeros(int(np.prod(shape)))
        for r in parts.groupBy("place").agg(F.sum("value").alias("value")).collect():
            out[r["place"]] = r["value"]
        return out.reshape(shape)

    def product(self, vectors: np.ndarray) -> np.ndarray:
        """The covariance times the vectors, without the covariance."""
        n = self.n
        if not vectors.shape[1]:
            return vectors
        return self.total(lambda y: y.T @ (y @ vectors), vectors.shape) / n


def fit(rows: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Leading eigenpairs of the covariance of the distinct vectors of ``quantised`` rows; None without rows."""
    width = _width(rows)
    if width is None:
        return None
    distinct = durable(rows.filter(F.size("x") == width).select("x").distinct())
    centred = Centred(distinct, width)
    trace = float(centred.total(lambda y: np.array([np.sum(y * y)]), (1,))[0]) / centred.n
    values, vectors = jacobi_davidson(centred.product, width, components)
    used = values > LEAST_SHARE * max(values[0], 0)
    values, vectors = values[used], vectors[:, used]
    weights = vectors / np.sqrt(values)
    k = len(values)

    def moments(y: np.ndarray) -> np.ndarray:
        z = y @ weights
        return np.vstack([z.T @ z, z.sum(axis=0)])

    error = 0.0
    if k:
        found = centred.total(moments, (k + 1, k)) / centred.n
        error = float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())
    return Fit(centred.n, centred.sums, centred.spread, values, vectors, trace, error)


def _width(rows: DataFrame) -> int | None:
    """The commonest length of the vectors, the largest of equals."""
    lengths = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    return lengths and lengths["width"]


def whiten(
    docs: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """id, n, deviation, whitened array<double>, explained array<double>, identity_error of each usable row.

    Entries become whole numbers, ``floor(SCALE * entry) + SHIFT``; the covariance
    is that of the distinct vectors.  A row's whitened values are its centred
    vector on each component over the square root of the eigenvalue;
    ``deviation`` is the exact sum over dimensions of ``(n x - S)`` squared.

    Rows whose vector is null, empty or holds null or non-finite entries are
    dropped, and so are vectors of another length than most.  Repeated rows and
    null ids each give their row.  Components without variance (fewer distinct
    vectors than dimensions, constant dimensions) are left out, so the arrays may
    be shorter than asked, or empty; no usable row gives no rows.  Deviations
    beyond 64 bits raise an error.
    """
    rows = quantised(docs, id_col, vector_col)
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    model = fit(rows, components)
    if model is None:
        return docs.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    width = len(model.sums)
    if width * model.spread**2 >= 1 << 63:
        raise OverflowError("deviations of this table are beyond 64 bits")
    floors = model.sums // model.n
    parts = (model.sums - floors * model.n) / model.n
    weights = model.vectors / np.sqrt(model.values)
    explained = (model.values / model.trace).tolist() if len(model.values) else []
    n, sums, error, k = model.n, model.sums, model.identity_error, len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), width)
            far = n * x - sums
            whitened = ((x - floors).astype(np.float64) - parts) @ weights
            count = len(x)
            ends = np.arange(count + 1, dtype=np.int32) * k
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(np.full(count, n)),
                    pa.array((far * far).sum(axis=1)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(whitened.ravel(), pa.float64())),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.tile(explained, count), pa.float64())),
                    pa.array(np.full(count, error)),
                ],
                ["id", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    out = rows.filter(F.size("x") == width).mapInArrow(run, schema)
    return out.withColumnRenamed("id", id_col)


def query(spark, sf):
    """Every embedding on up to 16 whitened components."""
    found = whiten(table(spark, sf, "embeddings"))
    pair = F.arrays_zip("whitened", "explained")
    rows = found.select("vec_id", "n", "deviation", "identity_error", F.posexplode(pair).alias("at", "pair"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        F.col("pair.whitened").alias("whitened"),
        F.col("pair.explained").alias("explained"),
        "identity_error",
    )
