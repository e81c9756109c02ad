"""Embedding whitening by Chebyshev-filtered subspace iteration.

Vectors are put on a grid of whole numbers (x = floor(64 * entry) + 1000000), so that their sums
and distances from the mean are exact. The leading eigenvectors of the covariance are found
without forming it: a block Q of ``components`` and some spare columns is multiplied by it,
again and again, as the sum over all rows of x̄ᵀ(x̄Q) for centred rows x̄, one distributed pass
each. A Chebyshev polynomial in the covariance, by its three-term recurrence, damps the
unwanted part of the spectrum (between a lower bound from a few Lanczos steps and the smallest
Ritz value of the block) while the wanted part grows; then the block is orthonormalised (QR), and
a Rayleigh-Ritz step gives eigenvalues, vectors and residuals. Rounds go on until every wanted
pair is certified: its residual is under ``tolerance`` of the largest eigenvalue, or has
reached the floor of double precision (it stopped falling, below 1e-9). A fit that cannot be
certified in ``rounds`` rounds is an error.

Scale: the grid vectors are written once and read by every pass (their column only). A task adds up
one matrix (dimensions x columns of the block) however many rows it has, the matrices are
added in ``FAN`` groups, and the driver gets ``FAN`` of them: its share depends on the dimension, never
on the rows. What goes to the tasks is Q. A lost executor costs its tasks of one pass.

Defined cases: rows whose vector is null, empty, or holds a null or a non-finite number are dropped,
as are rows whose vector is not of the most frequent length (ties: the longest); a null id is an id
like any other, repeated rows count each; entries beyond 2^40 in size are held there; components
whose eigenvalue is 0 in double precision (under 1e-12 of the largest; all, where all rows are equal)
do not exist, so there may be fewer than asked for; ``deviation`` is null where it does not
fit a long; an empty table gives an empty result; other columns of the input are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import picked, stored, table

#: Matrices that reach the driver in one pass.
FAN = 8
STEPS_PER_UNIT, OFFSET, LIMIT = 64, 1_000_000, float(1 << 40)
LONG_MAX = (1 << 63) - 1


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a column of equally long lists without nulls."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _grid(column: pa.Array) -> list[np.ndarray | None]:
    """The grid vector of each row, None for rows that take no part."""
    out: list[np.ndarray | None] = []
    for v in column:
        x = None
        if v.is_valid and len(v.values) and v.values.null_count == 0:
            a = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if np.isfinite(a).all():
                x = np.floor(np.clip(a * STEPS_PER_UNIT, -LIMIT, LIMIT)).astype(np.int64) + OFFSET
        out.append(x)
    return out


def on_grid(rows: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows (vec_id, embedding) that take part, stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xs = _grid(b.column(1))
            use = [i for i, x in enumerate(xs) if x is not None]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(use, pa.int64())),
                                              pa.array([xs[i] for i in use], pa.list_(pa.int64()))], names=["vec_id", "x"])
    kind = rows.schema["vec_id"].dataType.simpleString()
    grid = stored(rows.select("vec_id", "embedding").mapInArrow(run, f"vec_id {kind}, x array<long>"), "whiten-grid")
    lengths = grid.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return grid.filter(F.size("x") == lengths[0].d) if lengths else grid


def summed(grid: DataFrame, d: int, shape: tuple[int, int], add: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``add(rows)`` over all blocks of rows (of d numbers): one matrix a task, added up in FAN groups."""
    kind = add(np.zeros((1, d), np.int64)).dtype

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                part = add(_matrix(b.column(0)))
                total = part if total is None else total + part
        if total is not None:
            # dealt by content: evenly, and a task that runs again deals alike
            yield pa.RecordBatch.from_arrays([pa.array([zlib.crc32(total.tobytes()) % FAN], pa.int32()),
                                              pa.array([total.tobytes()], pa.binary())], names=["part", "sum"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for m in b.column(1):
                a = np.frombuffer(m.as_buffer(), kind).reshape(shape)
                total = a.copy() if total is None else total + a
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sum"])
    parts = grid.select("x").mapInArrow(task, "part int, sum binary").repartition(FAN, "part").mapInArrow(merge, "sum binary")
    return sum((np.frombuffer(bytes(r[0]), kind).reshape(shape) for r in parts.collect()), np.zeros(shape, kind))


@dataclass(frozen=True)
class Whitening:
    """What a fit found: n rows, exact sums, the largest grid entry, the trace of the covariance, eigenvalues
    (falling) and their unit vectors (columns)."""

    n: int
    sums: np.ndarray
    largest: int
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    passes: int


def centred(x: np.ndarray, n: int, sums: np.ndarray, largest: int) -> np.ndarray:
    """x - sums / n in double precision; the difference is taken in whole numbers where they fit a long."""
    if largest * n <= LONG_MAX // 4:
        return (n * x - sums) / n
    return (x.astype(object) * n - sums.astype(object)).astype(np.float64) / n


def deviations(x: np.ndarray, n: int, sums: np.ndarray, largest: int) -> list[int | None]:
    """Sum over the dimensions of (n * x - sums)^2, exact; None where it does not fit a long."""
    if largest * n <= LONG_MAX // 4:
        e = n * x - sums
        top = int(np.abs(e).max(initial=0))
        if top * top * max(1, e.shape[1]) <= LONG_MAX:
            return (e * e).sum(axis=1).tolist()
        e = e.astype(object)
    else:
        e = x.astype(object) * n - sums.astype(object)
    return [int(v) if v <= LONG_MAX else None for v in (e * e).sum(axis=1)]


def _lower_bound(multiply: Callable[[np.ndarray], np.ndarray], d: int, steps: int, seed: np.random.Generator) -> float:
    """About the least eigenvalue: the least Ritz value of a few Lanczos steps less its residual, 0 at least."""
    q = seed.standard_normal(d)
    basis, alphas, betas = [q / np.linalg.norm(q)], [], []
    for _ in range(min(steps, d)):
        w = multiply(basis[-1][:, None])[:, 0]
        alphas.append(float(basis[-1] @ w))
        for b in basis * 2:                       # twice: keeps the basis orthogonal
            w = w - (b @ w) * b
        beta = float(np.linalg.norm(w))
        betas.append(beta)
        if beta <= 1e-10 * max(map(abs, alphas)):
            break
        basis.append(w / beta)
    t = np.diag(alphas) + np.diag(betas[:len(alphas) - 1], 1) + np.diag(betas[:len(alphas) - 1], -1)
    values, vectors = np.linalg.eigh(t)
    return max(0.0, float(values[0] - betas[-1] * abs(vectors[-1, 0])))


def fit(grid: DataFrame, components: int = 32, spare: int = 16, degree: int = 8, rounds: int = 40,
        tolerance: float = 1e-13, lanczos: int = 6) -> Whitening | None:
    """The leading ``components`` of the rows (x) of ``grid``; None for an empty one."""
    first = grid.select("x").limit(1).collect()
    if not first:
        return None
    d = len(first[0].x)
    # row 0: sums, row 1: number of rows; and the largest entry by itself
    totals = summed(grid, d, (2, d), lambda x: np.stack([x.sum(axis=0), np.full(x.shape[1], len(x))]))
    n, sums = int(totals[1, 0]), totals[0]
    largest = int(grid.agg(F.max(F.greatest(F.array_max("x"), -F.array_min("x")))).first()[0])
    passes = 0

    def multiply(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def add(x: np.ndarray) -> np.ndarray:
            c = centred(x, n, sums, largest)
            return c.T @ (c @ q)
        return summed(grid, d, q.shape, add) / n

    def squares(x: np.ndarray) -> np.ndarray:
        c = centred(x, n, sums, largest)
        return np.array([[np.square(c).sum()]])
    trace = float(summed(grid, d, (1, 1), squares)[0, 0]) / n
    if trace == 0:
        return Whitening(n, sums, largest, 0.0, np.zeros(0), np.zeros((d, 0)), passes)
    seed = np.random.default_rng(12)
    width = min(d, components + spare)
    wanted = min(d, components)
    low = _lower_bound(multiply, d, lanczos, seed) if width < d else 0.0
    q = np.linalg.qr(seed.standard_normal((d, width)))[0]
    before = np.inf
    for _ in range(rounds):
        # Rayleigh-Ritz
        vq = multiply(q)
        h = q.T @ vq
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        real = int((values[:wanted] > 1e-12 * values[0]).sum())
        residual = float(np.linalg.norm(vq - q * values, axis=0)[:real].max()) / values[0]
        if residual <= tolerance or (residual <= 1e-9 and residual > before / 4):
            return Whitening(n, sums, largest, trace, values[:real], q[:, :real], passes)
        before = residual
        # the polynomial of the covariance that is small between low and the least Ritz value
        high = values[-1]
        if width == d or high <= low:
            q = np.linalg.qr(vq)[0]
            continue
        centre, half = (high + low) / 2, (high - low) / 2
        scale = half / (values[0] - centre)
        sigma = scale
        older, newer = q, (vq - centre * q) * (scale / half)
        for _ in range(degree - 1):
            next_sigma = 1 / (2 / scale - sigma)
            older, newer = newer, (multiply(newer) - centre * newer) * (2 * next_sigma / half) - older * (sigma * next_sigma)
            sigma = next_sigma
        q = np.linalg.qr(newer)[0]
    raise RuntimeError(f"no certified components after {rounds} rounds: residual {before:.1e}")


def whitened_rows(grid: DataFrame, found: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened: one number a component) of every row."""
    n, sums, largest = found.n, found.sums, found.largest
    project = found.vectors / np.sqrt(found.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(1))
                y = centred(x, n, sums, largest) @ project
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(deviations(x, n, sums, largest), pa.int64()),
                                                  pa.array(list(y), pa.list_(pa.float64()))], names=["vec_id", "deviation", "whitened"])
    kind = grid.schema["vec_id"].dataType.simpleString()
    return grid.select("vec_id", "x").mapInArrow(run, f"vec_id {kind}, deviation long, whitened array<double>")


def identity_error(grid: DataFrame, found: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, by one more pass over all rows."""
    n, sums, largest = found.n, found.sums, found.largest
    project, k = found.vectors / np.sqrt(found.values), len(found.values)

    def add(x: np.ndarray) -> np.ndarray:
        y = centred(x, n, sums, largest) @ project
        return np.vstack([y.T @ y, y.sum(axis=0)])
    total = summed(grid, len(sums), (k + 1, k), add)
    mean = total[k] / n
    return float(np.abs(total[:k] / n - np.outer(mean, mean) - np.eye(k)).max()) if k else 0.0


def whiten(rows: DataFrame, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, Whitening | None, float]:
    """(rows with vec_id, deviation and whitened (array, by falling eigenvalue), the fit, the identity error)."""
    grid = on_grid(picked(rows, vec_id=id_col, embedding=vector_col))
    found = fit(grid, components)
    if found is None:
        return grid.select("vec_id", F.lit(0).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened")), None, 0.0
    return whitened_rows(grid, found), found, identity_error(grid, found)


def query(spark, sf_dir: str) -> DataFrame:
    rows, found, error = whiten(table(spark, sf_dir, "embeddings"))
    shares = [] if found is None else (found.values / found.trace).tolist()
    shares_col = F.array(*[F.lit(s) for s in shares]).cast("array<double>")
    return (rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).cast("int").alias("component"),
                    F.lit(0 if found is None else found.n).cast("long").alias("n"), "deviation", "whitened",
                    F.get(shares_col, F.col("at")).alias("explained"), F.lit(error).alias("identity_error")))
