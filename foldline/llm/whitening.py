"""Embedding whitening: leading eigenvectors of a covariance by Jacobi-Davidson.

Entries c become integers x = floor(64 c) + 1000000. The fit list has each distinct x vector once: n
vectors with sums S. The covariance V (divisor n) is never formed: a product V P is one pass over
the fit list, in blocks, of centred rows (n x - S) / n times P; blocks add up in tasks, tasks in a
few adding tasks, and only dimension x columns numbers reach the driver.

``jacobi_davidson`` works on a block of Ritz vectors. Each round solves the projected correction
equations (I - B B')(V - theta I)(I - B B') t = -r of all of them by MINRES in lock step, so an
inner step is one pass for all columns; adds the corrections to the subspace; takes Ritz pairs; locks
leading pairs whose residual is at the level of rounding; and restarts when the subspace is full.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

SCALE, OFFSET = 64, 1_000_000
LARGEST = 2.0 ** 44  # entries from here on are no embedding's; 4,096 of their x would overflow a long
BLOCK_ROWS = 4096
ADDERS = 8
INNER_STEPS = 6
GUARD = 8  # Ritz vectors kept beyond the wanted ones
MAX_ROUNDS = 300
EPS = float(np.finfo(np.float64).eps)


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: (x - sums / n) @ components / sqrt(values) has unit covariance."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray  # dimension x components, unit columns by falling value
    values: np.ndarray
    trace: float
    identity_error: float

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace else self.values


# ------------------------------------------------------------------ eigenvectors (driver, small)


def _minres(product, shift, basis, right, steps: int, accuracy: float) -> np.ndarray:
    """Columns x with (I - B B')(V - shift)(I - B B') x = right, by at most ``steps`` MINRES steps of
    all columns side by side; columns at rest stay as they are."""

    def project(x):
        return x - basis @ (basis.T @ x)

    def nonzero(x):
        return np.where(x == 0, 1.0, x)

    right = project(right)
    first = np.linalg.norm(right, axis=0)
    x, w, w_before = (np.zeros_like(right) for _ in range(3))
    v_before, v, beta = np.zeros_like(right), right / nonzero(first), np.zeros_like(first)
    dbar, eps_next, rest = np.zeros_like(first), np.zeros_like(first), first.copy()
    cos, sin = -np.ones_like(first), np.zeros_like(first)
    for _ in range(steps):
        if not (rest > accuracy * first).any():
            break
        y = project(product(v)) - shift * v
        alpha = (v * y).sum(axis=0)
        y = project(y - alpha * v - beta * v_before)
        beta = np.linalg.norm(y, axis=0)
        eps_now, delta = eps_next, cos * dbar + sin * alpha
        gbar, eps_next, dbar = sin * dbar - cos * alpha, sin * beta, -cos * beta
        gamma = nonzero(np.hypot(gbar, beta))
        cos, sin = gbar / gamma, beta / gamma
        step, rest = cos * rest, np.abs(sin * rest)
        w, w_before = (v - eps_now * w_before - delta * w) / gamma, w
        x = x + step * w
        v_before, v = v, y / nonzero(beta)
    return x


def _orthonormal(columns: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``columns`` add to the orthonormal ``others``."""
    for _ in range(2):
        for basis in others:
            columns = columns - basis @ (basis.T @ columns)
        length = np.linalg.norm(columns, axis=0)
        columns = columns[:, length > 0] / length[length > 0]
    q, r = np.linalg.qr(columns)
    q = q[:, np.abs(np.diag(r)) > 1e-8]
    for basis in others:
        q = q - basis @ (basis.T @ q)
    return np.linalg.qr(q)[0]


def jacobi_davidson(
    product: Callable[[np.ndarray], np.ndarray], dimension: int, wanted: int, seed: int = 7
) -> tuple[np.ndarray, np.ndarray]:
    """(values, unit vectors as columns) of the ``wanted`` largest eigenvalues of a symmetric matrix,
    falling, known by its products with blocks of columns. Residuals reach 4 eps sqrt(dimension)
    of the largest value; where a product's own rounding is above that, they stop at its level
    (three rounds without progress within 100 times that bound)."""
    most = max(3 * wanted, wanted + 2 * GUARD)
    rng = np.random.default_rng(seed)
    space = _orthonormal(rng.standard_normal((dimension, min(dimension, wanted + GUARD))))
    image = product(space)
    locked, values, best, still = np.zeros((dimension, 0)), [], np.inf, 0
    for _ in range(MAX_ROUNDS):
        small = space.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        residual = image - space * theta
        residual -= locked @ (locked.T @ residual)
        norms = np.linalg.norm(residual, axis=0)
        bound = 4 * EPS * np.sqrt(dimension) * max([*values, abs(theta[0])])
        still = 0 if norms[0] < best / 2 else still + 1
        best = min(best, norms[0])
        full = space.shape[1] + locked.shape[1] >= dimension  # nothing is left to add
        done = 0
        while done < len(norms) and len(values) + done < wanted and (
                full or norms[done] <= bound or (still >= 3 and norms[done] <= 100 * bound)):
            done += 1
        if done:
            locked, values = np.hstack([locked, space[:, :done]]), values + list(theta[:done])
            space, image, residual, theta = space[:, done:], image[:, done:], residual[:, done:], theta[done:]
            best, still = np.inf, 0
        if len(values) == wanted:
            order = np.argsort(values)[::-1]
            return np.array(values)[order], locked[:, order]
        aim = min(wanted - len(values) + 2, space.shape[1])
        step = _minres(product, theta[:aim], np.hstack([locked, space[:, :aim]]), -residual[:, :aim], INNER_STEPS, 0.01)
        kept = most - aim - len(values)
        if space.shape[1] > kept:
            kept = max(aim, kept)
            space, image = space[:, :kept], image[:, :kept]
        step = _orthonormal(step, locked, space)
        if not step.shape[1]:  # no direction but rounding: start a new one
            step = _orthonormal(rng.standard_normal((dimension, 1)), locked, space)
        space, image = np.hstack([space, step]), np.hstack([image, product(step)])
    raise RuntimeError(f"no convergence in {MAX_ROUNDS} rounds; residual {best:.3g}, bound {bound:.3g}")


# ------------------------------------------------------------------ passes over the vectors


def _usable(vector: Column, dimension: int | None = None) -> Column:
    finite = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c) < LARGEST))  # NaN is above all numbers
    fits = F.size(vector) > 0 if dimension is None else F.size(vector) == dimension
    return vector.isNotNull() & fits & F.coalesce(finite, F.lit(False))


def _integers(column: pa.ListArray, dimension: int) -> np.ndarray:
    """x of a batch's vectors."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return (np.floor(flat * SCALE).astype(np.int64) + OFFSET).reshape(-1, dimension)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S, exact: as longs where they fit, else as Python integers."""
    if len(x) and int(np.abs(x).max()) * n >= 1 << 61:
        return x.astype(object) * n - sums
    return x * n - sums.astype(np.int64)


def _total(blocks: DataFrame, n: int, sums: np.ndarray, part: Callable[[np.ndarray], np.ndarray], shape) -> np.ndarray:
    """The sum of ``part`` over the centred blocks: one row a task, then ADDERS rows, in fixed order."""

    def run(batches):
        total, task = None, None
        for batch in batches:
            for task_id, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = np.frombuffer(data.as_buffer(), np.int64).reshape(-1, len(sums))
                found = part((_deviations(x, n, sums) / n).astype(np.float64)).ravel()
                total = found if total is None else total + found
                task = task_id if task is None else task
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([task], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["task", "data"])

    def add(batches):
        total, task = None, None
        for batch in batches:
            for task_id, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = np.frombuffer(data.as_buffer(), np.float64)
                total = found.copy() if total is None else total + found
                task = task_id if task is None else task
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([task], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["task", "data"])

    schema = "task long, data binary"
    rows = blocks.mapInArrow(run, schema).repartition(ADDERS).sortWithinPartitions("task").mapInArrow(add, schema).collect()
    found = [np.frombuffer(r["data"], np.float64) for r in sorted(rows, key=lambda r: r["task"])]
    return np.sum(found, axis=0).reshape(shape)


def _fit_list(source: DataFrame, dimension: int) -> DataFrame:
    """(block, data) of the distinct x vectors, as longs, at most BLOCK_ROWS vectors a row."""
    x = F.transform("vector", lambda c: F.floor(c * SCALE) + OFFSET)

    def run(batches):
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            own = flat.reshape(-1, dimension)
            data = [own[i: i + BLOCK_ROWS].tobytes() for i in range(0, len(own), BLOCK_ROWS)]
            yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary())], ["data"])

    packed = source.select(x.alias("x")).distinct().mapInArrow(run, "data binary")
    return materialize(packed.select(F.monotonically_increasing_id().alias("block"), "data"), "whitening-fit")


def _dimension(vectors: DataFrame) -> int:
    """The dimension most vectors have (the greatest of those, if several); 0 without any."""
    sizes = vectors.where(_usable(F.col("vector"))).groupBy(F.size("vector").alias("d")).count()
    best = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return best["d"] if best is not None else 0


def _source(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    return vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        F.col(f"`{vector_column}`").cast("array<double>").alias("vector"))


def fit_whitening(vectors: DataFrame, vector_column: str = "embedding", components: int = 16) -> Whitening | None:
    """The whitening of at most ``components`` leading components; None if no vector is usable.

    A vector is usable if it is not null, has the dimension most vectors have, and holds only
    numbers below 2**44 in size (no null, NaN or infinity). Repeated vectors count once. Directions
    without variance (value up to rounding zero) are no components, so one distinct vector, or none,
    gives none. Vectors are read in blocks; nothing of the table's size reaches the driver."""
    source = vectors.select(F.col(f"`{vector_column}`").cast("array<double>").alias("vector"))
    dimension = _dimension(source)
    if not dimension:
        return None
    blocks = _fit_list(source.where(_usable(F.col("vector"), dimension)), dimension).persist()
    try:
        def count(batches):
            for batch in batches:
                for data in batch.column(1):
                    x = np.frombuffer(data.as_buffer(), np.int64).reshape(-1, dimension)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.arange(-1, dimension, dtype=np.int32)), pa.array(np.append(len(x), x.sum(axis=0)))], ["i", "s"])

        found = blocks.mapInArrow(count, "i int, s long").groupBy("i").agg(F.sum(F.col("s").cast("decimal(20,0)")).alias("s"))
        rows = {r["i"]: int(r["s"]) for r in found.collect()}
        n, sums = rows[-1], np.array([rows[i] for i in range(dimension)], object)

        def product(columns):
            return _total(blocks, n, sums, lambda c: c.T @ (c @ columns), columns.shape) / n

        trace = float(_total(blocks, n, sums, lambda c: np.array([(c * c).sum()]), (1,))[0]) / n
        wanted = min(components, dimension, n - 1) if trace > 0 else 0
        values, found = jacobi_davidson(product, dimension, wanted) if wanted else (np.zeros(0), np.zeros((dimension, 0)))
        real = values > EPS * dimension * trace
        values, found = values[real], found[:, real]
        error, m = 0.0, len(values)
        if m:
            scaled = found / np.sqrt(values)

            def moments(c):
                z = c @ scaled
                return np.vstack([z.T @ z, z.sum(axis=0)])

            both = _total(blocks, n, sums, moments, (m + 1, m)) / n
            error = float(np.abs(both[:m] - np.outer(both[m], both[m]) - np.eye(m)).max())
        return Whitening(n, tuple(int(s) for s in sums), found, values, trace, error)
    finally:
        blocks.unpersist()


def whiten(
    vectors: DataFrame, fitted: Whitening | None, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """(id, deviation long, whitened array<double>) of each usable row, repeated rows and null ids
    included; rows of another dimension or with null or non-finite entries give none.

    ``deviation`` is the exact sum of (n x - S)^2, null where it exceeds a long. Other columns,
    whatever their names, are not read. An empty table, or no fit, gives an empty result."""
    source = _source(vectors, id_column, vector_column)
    dimension = len(fitted.sums) if fitted else 0
    source = source.where(_usable(F.col("vector"), dimension) if dimension else F.lit(False))
    n, sums = (fitted.n, np.array(fitted.sums, object)) if fitted else (1, None)
    scaled = fitted.components / np.sqrt(fitted.values) if fitted else None

    def run(batches):
        for batch in batches:
            own = _deviations(_integers(batch.column(1), dimension), n, sums)
            size = (own.astype(np.float64) ** 2).sum(axis=1)
            exact = own if len(own) == 0 or size.max() < 2.0 ** 62 else own.astype(object)
            squares = [s if s < 1 << 63 else None for s in (exact * exact).sum(axis=1).tolist()]
            z = (own / n).astype(np.float64) @ scaled
            first = np.arange(0, z.size + 1, max(z.shape[1], 1), dtype=np.int32) if z.shape[1] else np.zeros(len(z) + 1, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(squares, pa.int64()), pa.ListArray.from_arrays(pa.array(first), pa.array(z.ravel()))],
                ["id", "deviation", "whitened"])

    return source.mapInArrow(run, "id long, deviation long, whitened array<double>").withColumnRenamed("id", id_column)


def whitening_report(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = 16) -> DataFrame:
    """One row per usable row of ``vectors`` and component: id, component (from 1), n, deviation,
    whitened, explained, identity_error (see ``fit_whitening`` and ``whiten``, also for nulls,
    repeated rows, empty tables and other columns)."""
    fitted = fit_whitening(vectors, vector_column, components)
    explained = [float(x) for x in fitted.explained] if fitted else []
    rows = whiten(vectors, fitted, id_column, vector_column)
    return rows.select(F.col(f"`{id_column}`").alias("id"), "deviation", F.posexplode("whitened").alias("place", "value")).select(
        F.col("id").alias(id_column),
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(fitted.n if fitted else 0).cast("long").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        F.element_at(F.array(*[F.lit(x) for x in explained]).cast("array<double>"), F.col("place") + 1).alias("explained"),
        F.lit(fitted.identity_error if fitted else 0.0).alias("identity_error"),
    )
