"""Whitening of embeddings on principal components found by FEAST contour integration.

Every entry c becomes the integer floor(64 c) + 1000000, and the covariance of the distinct integer
vectors (the fit list) is summed by tasks over the vectors less their exact mean. It is a matrix of
dimensions x dimensions, whatever the number of vectors. Its largest eigenvalues are cut into
intervals by inertia counts: the signs of an LDL' factorisation of the shifted covariance tell how many
eigenvalues lie below the shift. Spark tasks then take one interval each: Gauss-Legendre quadrature
around it solves complex shifted systems, which projects a block of random vectors onto the interval's
eigenspace, Rayleigh-Ritz extracts eigenpairs, and both repeat until the residuals reach rounding.
An interval counts as solved only with as many eigenpairs as its inertia counts tell.
A last Rayleigh-Ritz step over all intervals makes the components orthogonal to each other.

Defined results: vectors that are null or hold null or non-finite entries are dropped; so are vectors
whose length isn't the most common one (the smaller of equally common ones) and empty vectors.
Entries beyond 2**40 / 64 count as that bound. Equal vectors count once in the fit list; rows may
repeat and each gives its own result. Components with eigenvalue 0 (to rounding) don't exist:
one distinct vector, or none, gives no components and no whitened values. Equal eigenvalues share an
eigenspace, in which any orthonormal vectors are components. A deviation that exceeds 64 bits is null.
Null ids stay null. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm._store import written

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
BOUND = float(1 << 40)
#: eigenvalues of an interval at most, unless they can't be told apart; its ends are within a factor 4
PER_INTERVAL = 6
NODES = 8
ROUNDS = 20
#: relative size below which eigenvalues count as 0, and width of intervals that aren't cut further
ZERO, NARROW = 1e-11, 1e-9


def integer_rows(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a list column that count, and their vectors as integers."""
    column = column.cast(pa.list_(pa.float64()))
    sizes = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    entries = column.flatten()  # leaves out null rows
    missing = entries.is_null().to_numpy(zero_copy_only=False)
    c = entries.fill_null(0.0).to_numpy(zero_copy_only=False)
    bad = np.concatenate(([0], np.cumsum(missing | ~np.isfinite(c))))
    end = np.cumsum(np.maximum(sizes, 0))
    begin = end - np.maximum(sizes, 0)
    rows = np.flatnonzero((sizes == dims) & (bad[end] == bad[begin]))
    if not len(rows):
        return rows, np.empty((0, dims), np.int64)
    c = c[begin[rows][:, None] + np.arange(dims)] * SCALE
    return rows, np.floor(np.clip(c, -BOUND, BOUND)).astype(np.int64) + SHIFT


def _keys(dims: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = integer_rows(batch.column(0), dims)[1]
            distinct = np.unique(x, axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.tobytes() for r in distinct], pa.binary())], ["x"])
    return run


def _vectors(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64).reshape(-1, dims)


def _sums(dims: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims + 1, np.int64)
        for batch in batches:
            total[:dims] += _vectors(batch, dims).sum(axis=0)
            total[dims] += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims + 1)), pa.array(total)], ["i", "s"])
    return run


def _products(rows_of: Callable[[pa.RecordBatch], np.ndarray], dims: int) -> Callable:
    """Sums (row ``dims``) and products of the centred rows of a task, one row per dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims))
        for batch in batches:
            c = rows_of(batch)
            total[:dims] += c.T @ c
            total[dims] += c.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims + 1)), pa.array(list(total))],
                                         ["i", "v"])
    return run


def _product_sums(fit: DataFrame, rows_of: Callable, dims: int) -> np.ndarray:
    """Products and sums over the whole fit list; (dims + 1) x dims numbers on the driver."""
    parts = fit.mapInArrow(_products(rows_of, dims), "i long, v array<double>")
    cells = parts.select("i", F.posexplode("v").alias("j", "v")).groupBy("i", "j").agg(
        F.sum("v").alias("v")).toArrow()
    out = np.zeros((dims + 1, dims))
    out[cells["i"].to_numpy(), cells["j"].to_numpy()] = cells["v"].to_numpy()
    return out


# --- eigenpairs of a symmetric matrix ----------------------------------------------------------
def below(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of ``a`` lie below ``shift``: negative pivots of LDL' of the rest.

    Diagonal pivots are taken singly, or in pairs where a single one would be too small.
    """
    a, n = a - shift * np.eye(len(a)), len(a)
    least, count, k = (1 + 17 ** 0.5) / 8, 0, 0

    def swap(i: int, j: int) -> None:
        a[[i, j], k:] = a[[j, i], k:]
        a[k:, [i, j]] = a[k:, [j, i]]

    while k < n:
        column = np.abs(a[k + 1:, k])
        size, top = 1, column.max(initial=0.0)
        if abs(a[k, k]) < least * top:
            r = k + 1 + int(column.argmax())
            other = np.abs(a[r, k:])
            other[r - k] = 0
            if abs(a[k, k]) * other.max() < least * top * top:
                if abs(a[r, r]) >= least * other.max():
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    size = 2
        pivot, rest = a[k:k + size, k:k + size], a[k + size:, k:k + size]
        if size == 2:
            count += int((np.linalg.eigvalsh(pivot) < 0).sum())
        else:
            count += int(pivot[0, 0] < 0)
        if np.any(rest):
            a[k + size:, k + size:] -= rest @ np.linalg.solve(pivot, rest.T)
        k += size
    return count


def intervals(v: np.ndarray, want: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues between) that hold the ``want`` greatest positive eigenvalues."""
    trace = float(np.trace(v))
    if not trace > 0:
        return []

    def above(shift: float) -> int:
        return len(v) - below(v, shift)

    def clear(shift: float) -> float:
        """A shift nearby that no eigenvalue is too close to."""
        for step in range(1, 20):
            if above(shift * (1 - 1e-10)) == above(shift * (1 + 1e-10)):
                return shift
            shift *= 1 - 1e-8 * step
        return shift

    low, high = clear(trace * ZERO), trace * (1 + 1e-6)
    want, out, todo = min(want, above(low)), [], [(low, high, above(low), 0)]
    while todo:
        low, high, n_low, n_high = todo.pop()
        if n_low == n_high or n_high >= want:
            continue
        few = n_low - n_high <= PER_INTERVAL and high <= 4 * low
        if few or high - low <= NARROW * high:
            out.append((low, high, n_low - n_high))
            continue
        middle = clear((low * high) ** 0.5 if high > 4 * low else (low + high) / 2)
        if not low < middle < high:
            out.append((low, high, n_low - n_high))
            continue
        n = above(middle)
        todo += [(low, middle, n_low, n), (middle, high, n, n_high)]
    return out


def ritz(v: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ritz values (rising) and orthonormal vectors of ``v`` in the span of ``block``."""
    q = np.linalg.qr(np.linalg.qr(block)[0])[0]
    h = q.T @ v @ q
    values, inside = np.linalg.eigh((h + h.T) / 2)
    return values, q @ inside


def feast(v: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """All ``count`` eigenpairs of ``v`` with eigenvalues between ``low`` and ``high``."""
    n, rng = len(v), np.random.default_rng(count)
    x, weights = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(0.5j * np.pi * (1 - x))
    centre, radius = (low + high) / 2, (high - low) / 2
    size, best, found = min(n, 2 * count + 4), np.inf, None
    enough = max(1e-12 * high, 1e-14 * float(np.trace(v)))  # what rounding leaves
    block = rng.standard_normal((n, size))
    for _ in range(ROUNDS):
        projected = np.zeros((n, size))
        for turn, weight in zip(turns, weights):
            solved = np.linalg.solve((centre + radius * turn) * np.eye(n) - v, block.astype(complex))
            projected += 0.5 * weight * (radius * turn * solved).real
        values, vectors = ritz(v, projected)
        inside = np.flatnonzero((values > low) & (values <= high))
        left = np.linalg.norm(v @ vectors[:, inside] - vectors[:, inside] * values[inside], axis=0)
        inside = np.sort(inside[np.argsort(left)[:count]])  # further ones are no eigenvalues
        worst = np.sort(left)[:count].max() if len(inside) == count else np.inf
        slow = worst >= best / 2
        if worst < best:
            best, found = worst, (values[inside], vectors[:, inside])
        if best <= 1e-15 * n * high or slow and best <= enough:
            return found
        block = vectors
        if slow and size < n:  # a pair is missing, or many lie just outside: more room
            size = min(n, size + count + 4)
            block = np.hstack([vectors, rng.standard_normal((n, size - vectors.shape[1]))])
    raise ArithmeticError(f"{count} eigenvalues in [{low}, {high}]: found {len(inside)}, "
                          f"residual {best}")


def _solve(v: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values, vectors = feast(v, row["low"], row["high"], row["n"])
                yield pa.RecordBatch.from_arrays([pa.array(list(vectors.T))], ["v"])
    return run


def principal_components(spark, v: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``want`` greatest positive eigenvalues (falling) and unit eigenvectors in columns.

    Intervals are solved in tasks of their own; the covariance goes to them with the code.
    """
    cut = intervals(v, want)
    if not cut:
        return np.empty(0), np.empty((len(v), 0))
    found = spark.createDataFrame(cut, "low double, high double, n long").repartition(len(cut)) \
        .mapInArrow(_solve(v), "v array<double>").toArrow()["v"].to_pylist()
    values, vectors = ritz(v, np.array(found).T)
    values, vectors = values[::-1][:want], vectors[:, ::-1][:, :want]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values, vectors * signs


# --- the operator ------------------------------------------------------------------------------
@dataclass(frozen=True)
class Whitening:
    """Exact sums of the fit list, its components, and how well they whiten it."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x - np.array([s / self.n for s in self.sums])

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)**2, exact; None beyond 64 bits."""
        reach = np.abs(self.centred(x)).max(initial=0.0) * self.n + 1
        if max(reach, self.n * np.abs(x).max(initial=0)) < 2.0 ** 62 and \
                reach * reach * x.shape[1] < 2.0 ** 62:
            return ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * int(e) - s) ** 2 for e, s in zip(row, self.sums)) for row in x]
        return [d if d < 1 << 63 else None for d in exact]


def _dimensions(embeddings: DataFrame) -> int:
    sizes = embeddings.select(F.size("embedding").alias("size")).where("size > 0")
    most = sizes.groupBy("size").count().orderBy(F.desc("count"), "size").first()
    return most["size"] if most else 0


def fit_whitening(embeddings: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Learn from the distinct vectors; None if there is no vector."""
    dims = _dimensions(embeddings)
    if not dims:
        return None
    fit = written(embeddings.select("embedding").mapInArrow(_keys(dims), "x binary").distinct(), "fit")
    totals = {r.i: int(r.s) for r in fit.mapInArrow(_sums(dims), "i long, s long").groupBy("i").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}
    n, sums = totals.get(dims, 0), tuple(totals.get(i, 0) for i in range(dims))
    if not n:
        return None
    plain = Whitening(n, sums, np.empty(0), np.empty((dims, 0)), np.empty(0), 0.0)
    v = _product_sums(fit, lambda batch: plain.centred(_vectors(batch, dims)), dims)[:dims] / n
    v = (v + v.T) / 2
    values, vectors = principal_components(embeddings.sparkSession, v, components)
    model = Whitening(n, sums, values, vectors, values / max(float(np.trace(v)), 1e-300), 0.0)
    k, error = len(values), 0.0
    if k:
        of_fit = _product_sums(fit, lambda batch: model.apply(_vectors(batch, dims)), k)
        mean = of_fit[k] / n
        error = float(np.abs(of_fit[:k] / n - np.outer(mean, mean) - np.eye(k)).max())
    return Whitening(n, sums, values, vectors, model.explained, error)


def _whiten(model: Whitening) -> Callable:
    dims = len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = integer_rows(batch.column(1), dims)
            if len(rows):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(model.deviations(x), pa.int64()),
                     pa.array(list(model.apply(x)), pa.list_(pa.float64()))],
                    ["vec_id", "deviation", "whitened"])
    return run


def whitened_vectors(embeddings: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation and the whitened vector of every row that counts."""
    return embeddings.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(
        _whiten(model), "vec_id long, deviation long, whitened array<double>")


def op11_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    """The contract's columns: a row per vector of ``embeddings`` and component."""
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    model = fit_whitening(embeddings)
    schema = ("vec_id long, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    if model is None:
        return spark.createDataFrame([], schema)
    shares = F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>")
    return whitened_vectors(embeddings, model).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
        "deviation", "whitened", F.get(shares, "at").alias("explained"),
        F.lit(model.identity_error).alias("identity_error"))
