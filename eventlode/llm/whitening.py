"""Embedding whitening with eigenpairs from contour integrals (FEAST).

Entries become integers, so counts, sums and covariances are exact whatever the order in which tasks finish. The covariance
of the distinct vectors, a matrix of fixed size, is summed by Spark. Its largest eigenvalues are cut into intervals by
inertia counts. For each interval a quadrature of complex shifted solves around it projects random vectors onto its
eigenvectors, Rayleigh-Ritz extracts them, and the inertia count tells whether any is missing.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlode.session import materialize

from .common import batches, list_array, map_arrow, table

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
# Entries must be integers below this after scaling; vectors beyond are dropped like those that are not finite.
MOST_ENTRY = 1 << 52
# Quadrature points on the upper half of a contour, eigenvalues searched by one contour, and rounds for each.
POINTS = 8
IN_CONTOUR = 8
ROUNDS = 8


# Eigenpairs of one symmetric matrix


def inertia(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix exceed ``shift``: positive pivots of an LDL' factorization.

    Pivots are single entries or, where the diagonal is too small, two by two blocks with one positive eigenvalue
    (Bunch and Kaufman's choice with complete pivoting, so that nothing grows).
    """
    m = np.array(a, np.float64) - shift * np.eye(len(a))
    above, ratio = 0, (1 + np.sqrt(17)) / 8
    while (n := len(m)) > 0:
        size = np.abs(m)
        r, c = divmod(int(size.argmax()), n)
        d = int(size.diagonal().argmax())
        if size[r, c] == 0:
            return above
        if size[d, d] >= ratio * size[r, c]:
            above += m[d, d] > 0
            rest = np.delete(np.arange(n), d)
            m = m[np.ix_(rest, rest)] - np.outer(m[rest, d], m[d, rest]) / m[d, d]
        else:
            above += 1
            rest = np.delete(np.arange(n), [r, c])
            block = m[np.ix_([r, c], [r, c])]
            m = m[np.ix_(rest, rest)] - m[np.ix_(rest, [r, c])] @ np.linalg.solve(block, m[np.ix_([r, c], rest)])
    return int(above)


def contour_projection(a: np.ndarray, low: float, high: float, start: np.ndarray) -> np.ndarray:
    """The spectral projector of the eigenvalues in (low, high) applied to ``start``, by Gauss quadrature of shifted solves."""
    centre, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    out, eye = np.zeros(start.shape), np.eye(len(a))
    for x, w in zip(nodes, weights, strict=True):
        turn = np.exp(0.5j * np.pi * (1 - x))
        solved = np.linalg.solve((centre + radius * turn) * eye - a, start.astype(complex))
        # The lower half of the circle gives the conjugate.
        out += w / 2 * (radius * turn * solved).real
    return out


def eigenpairs_in(a: np.ndarray, low: float, high: float, count: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs in (low, high), rising.

    Where eigenvalues lie so close to the contour that the projections don't settle, they are repeated in a subspace
    twice as large; the whole space settles at once. Raises ArithmeticError if even that gives another count.
    """
    d = len(a)
    norm = np.abs(a).sum(0).max()
    size = min(d, count + count // 2 + 4)
    while True:
        q = np.random.default_rng(seed).standard_normal((d, size))
        for _ in range(ROUNDS):
            q, _ = np.linalg.qr(contour_projection(a, low, high, q))
            values, turns = np.linalg.eigh(q.T @ a @ q)
            q = q @ turns
            inside = (values > low) & (values < high)
            if inside.sum() == count:
                off = np.linalg.norm(a @ q[:, inside] - q[:, inside] * values[inside], axis=0).max()
                if off <= 64 * np.finfo(float).eps * norm:
                    return values[inside], q[:, inside]
        if size == d:
            raise ArithmeticError(f"the contour around ({low}, {high}) did not settle on {count} eigenvalues")
        size = min(d, 2 * size)


def _intervals(a: np.ndarray, k: int) -> list[tuple[float, float, int]]:
    """Disjoint intervals with counts, falling, that hold the ``k`` largest eigenvalues or all above rounding.

    An interval is cut until it holds few eigenvalues or is so narrow that they are equal to rounding.
    """
    norm = float(np.abs(a).sum(0).max())
    floor, narrow = 64 * len(a) * np.finfo(float).eps * norm, 1e-10 * norm
    out, found = [], 0
    todo = [(floor, norm * 1.01, inertia(a, floor))]
    while todo and found < k:
        low, high, count = todo.pop()
        if count > IN_CONTOUR and high - low > narrow:
            # No round share of the width: eigenvalues are often round numbers.
            cut = low + 0.3819 * (high - low)
            upper = inertia(a, cut) - found
            todo += [(low, cut, count - upper), (cut, high, upper)]
        elif count:
            out.append((low, high, count))
            found += count
    return out


def largest_eigenpairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``k`` eigenvalues above rounding, falling, and their unit eigenvectors as columns.

    A last Rayleigh-Ritz step over all contours makes vectors of neighbouring intervals orthogonal. Each contour has found
    as many as inertia counts between its ends, so none is missing.
    """
    if not len(a) or not np.abs(a).max() > 0 or not (parts := _intervals(a, k)):
        return np.zeros(0), np.zeros((len(a), 0))
    q, _ = np.linalg.qr(np.concatenate([eigenpairs_in(a, *part)[1] for part in parts], axis=1))
    values, turns = np.linalg.eigh(q.T @ a @ q)
    return values[::-1][:k], (q @ turns)[:, ::-1][:, :k]


# Over Spark


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and x, an array of longs, of the usable rows.

    Dropped are rows whose vector is null, holds a null or an entry that is not finite or too large to be an exact integer
    after scaling, and rows of another length than most (of two equally frequent lengths the longer counts).
    """
    given = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))

    def usable(c: Column) -> Column:
        return F.coalesce(F.abs(c * SCALE) < float(MOST_ENTRY), F.lit(False))

    kept = given.where(F.col("v").isNotNull() & F.forall("v", usable))
    common = kept.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    length = common.n if common else 0
    return kept.where(F.size("v") == length).select(
        "vec_id", F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + SHIFT).alias("x"))


def _matrix(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    values = batch.column(column)
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def _entries(i: np.ndarray, j: np.ndarray, values: list[str] | np.ndarray, kind: pa.DataType) -> pa.RecordBatch:
    return batches({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "v": pa.array(values, kind)})


def _summed_entries(fit: DataFrame, partial, kind: pa.DataType, ddl: str, total: str) -> dict[tuple[int, int], object]:
    """Sums over all tasks of the entries (i, j) that ``partial`` gives for each task; their number depends on the width alone."""
    parts = map_arrow(fit, partial, f"i int, j int, v {ddl}")
    return {(r.i, r.j): r.v for r in parts.groupBy("i", "j").agg(F.expr(total).alias("v")).collect()}


def moments(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of rows of ``fit`` (x) and exact sums by dimension."""

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for batch in items:
            x = _matrix(batch)
            # Two halves of each number, so that no sum of a batch can overflow.
            high, low = (x >> 31).sum(0).tolist(), (x & 0x7FFFFFFF).sum(0).tolist()
            part = [(h << 31) + v for h, v in zip(high, low, strict=True)]
            n, sums = n + len(x), part if sums is None else [a + b for a, b in zip(sums, part, strict=True)]
        if n:
            k = np.arange(-1, len(sums))
            yield _entries(k, k, [str(v) for v in (n, *sums)], pa.string())

    got = _summed_entries(fit, run, pa.string(), "string", "sum(cast(v as decimal(38,0)))")
    d = len(got) - 1
    return (int(got[-1, -1]), [int(got[j, j]) for j in range(d)]) if got else (0, [])


def _exact_gram(y: np.ndarray) -> np.ndarray:
    """y'y of integers: by floating point where every sum is exact in it, else by Python's integers."""
    most = int(np.abs(y).max(initial=0))
    if most * most * len(y) < 1 << 53:
        return (y.astype(np.float64).T @ y.astype(np.float64)).astype(np.int64).astype(object)
    y = y.astype(object)
    return y.T @ y


def covariance(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The covariance of ``fit`` (x), divisor n. Rows are centred on the rounded means before multiplying, exactly;
    what rounding leaves is taken off as a fraction, so every entry is the nearest double to the true one."""
    centre = [(2 * s + n) // (2 * n) for s in sums]
    shift = np.array(centre, np.int64)

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in items:
            part = _exact_gram(_matrix(batch) - shift)
            total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield _entries(i, j, [str(v) for v in total[i, j]], pa.string())

    got = _summed_entries(fit, run, pa.string(), "string", "sum(cast(v as decimal(38,0)))")
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    out = np.zeros((len(sums), len(sums)))
    for (i, j), v in got.items():
        out[i, j] = out[j, i] = float(Fraction(n * int(v) - rest[i] * rest[j], n * n))
    return out


class Whitener:
    """Means, directions and scales; ``apply`` turns rows of x into whitened ones."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray):
        self.n, self.sums = n, sums
        self.whole = np.array([s // n for s in sums], np.int64)
        self.part = np.array([(s % n) / n for s in sums])
        self.turn = vectors / np.sqrt(values)

    def apply(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.whole) - self.part) @ self.turn

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact; null where it does not fit a long."""
        y = x - self.whole
        most = int(np.abs(y).max(initial=0)) + 1
        if (self.n * most) ** 2 * max(1, x.shape[1]) < 1 << 62:
            z = self.n * y - np.array([s % self.n for s in self.sums], np.int64)
            return (z * z).sum(1).tolist()
        rest = np.array([s % self.n for s in self.sums], object)
        z = self.n * y.astype(object) - rest
        return [v if v < 1 << 63 else None for v in (z * z).sum(1)]


def identity_error(fit: DataFrame, white: Whitener) -> float:
    """The largest absolute entry of the covariance of the whitened ``fit`` rows minus the identity."""

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in items:
            w = white.apply(_matrix(batch))
            w = np.concatenate([w, np.ones((len(w), 1))], axis=1)
            total = w.T @ w if total is None else total + w.T @ w
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield _entries(i, j, total[i, j], pa.float64())

    got = _summed_entries(fit, run, pa.float64(), "double", "sum(v)")
    k = white.turn.shape[1]
    mean = [got[i, k] / white.n for i in range(k)]
    return max((abs(got[i, j] / white.n - mean[i] * mean[j] - (i == j)) for i in range(k) for j in range(i, k)), default=0.0)


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable row: vec_id, n, deviation, whitened, explained (arrays by component) and identity_error.

    Directions come from each distinct vector once. There are as many components as asked for, but none of an eigenvalue
    that is zero to rounding: a table of equal vectors gives empty arrays. Equal eigenvalues share their space in some
    basis, the same for all rows. Unusable rows (see ``quantised``) are dropped, repeated rows stay, as do those with a
    null id. An empty table gives an empty result. The width is bounded by the embedding; matrices of its square are in
    every task and on the driver.
    """
    rows = materialize(quantised(vectors, id_col, vector_col), "whitening-rows")
    fit = materialize(rows.select("x").distinct(), "whitening-fit")
    n, sums = moments(fit)
    schema = "vec_id long, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    if not n or not sums:
        return rows.sparkSession.createDataFrame([], schema)
    v = covariance(fit, n, sums)
    values, vectors_ = largest_eigenpairs(v, components)
    white = Whitener(n, sums, values, vectors_)
    error = identity_error(fit, white)
    explained = values / np.trace(v) if len(values) else values

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in items:
            x, m = _matrix(batch), batch.num_rows
            k = np.full(m, len(values))
            yield batches({
                "vec_id": batch.column("vec_id"), "n": pa.array(np.full(m, n)), "deviation": pa.array(white.deviations(x), pa.int64()),
                "whitened": list_array(white.apply(x).ravel(), k, pa.float64()),
                "explained": list_array(np.tile(explained, m), k, pa.float64()), "identity_error": pa.array(np.full(m, error))})

    return map_arrow(rows, run, schema)


def op13_feast_whitening(spark, sf_dir: str) -> DataFrame:
    found = whiten(table(spark, sf_dir, "embeddings"))
    pairs = F.posexplode(F.arrays_zip("whitened", "explained"))
    each = found.select("vec_id", "n", "deviation", "identity_error", pairs.alias("place", "p"))
    return each.select("vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", F.col("p.whitened").alias("whitened"),
                       F.col("p.explained").alias("explained"), "identity_error")
