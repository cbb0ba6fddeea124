"""Whitening of embedding vectors, with the covariance's leading components found by contour integration (FEAST).

The covariance is summed by Spark over the distinct vectors; only that matrix, dimension by dimension, reaches the driver.
Its spectrum is sliced by inertia counts: the signs of the pivots of ``T - s I``, T being V made tridiagonal, say how many
eigenvalues lie above ``s``, so bisection finds intervals that hold a few eigenvalues each. In an interval a block of vectors is projected onto the wanted
eigenspace by quadrature of ``(z I - V)^-1`` along a circle through the interval's ends, Rayleigh-Ritz extracts the
eigenpairs from the projected block, and that repeats until the residuals are at rounding level. An interval is accepted only
if as many pairs came out as its inertia counts say.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batches, forget, only, out, settle

#: Quadrature points of the half circle, and rounds of an interval before it is an error.
NODES, ROUNDS = 8, 60
#: Most eigenvalues of an interval, unless they can't be told apart.
SLICE = 8
EPS = np.finfo(float).eps
#: Eigenvalues below this share of the largest one count as none: they are rounding of zero.
NULL = 64 * EPS
SCALE, SHIFT = 64.0, 1_000_000
#: Fixed-point entries beyond this are set to it, so that they fit 64 bits.
LARGEST = 1 << 52


Tridiagonal = tuple[list[float], list[float]]


def tridiagonal(v: np.ndarray) -> Tridiagonal:
    """Diagonal and squared off-diagonal of a tridiagonal matrix with the same eigenvalues, by Householder reflections."""
    a = np.array(v, float)
    off = []
    for k in range(len(a) - 1):
        x = a[k + 1 :, k].copy()
        norm = float(np.linalg.norm(x))
        off.append(norm)
        if norm == 0 or len(x) == 1:
            continue
        x[0] += norm if x[0] >= 0 else -norm
        x /= np.linalg.norm(x)
        rest = a[k + 1 :, k + 1 :]
        y = rest @ x
        y -= (x @ y) * x
        rest -= 2 * (np.outer(x, y) + np.outer(y, x))
    return np.diag(a).tolist(), [b * b for b in off]


def above(t: Tridiagonal, s: float) -> int:
    """How many eigenvalues exceed ``s``: the positive pivots of ``T - s I`` (Sylvester's law of inertia)."""
    count, pivot, tiny = 0, 1.0, 1e-300
    for a, b in zip(t[0], [0.0, *t[1]]):
        pivot = a - s - b / pivot
        if pivot == 0:
            pivot = -tiny
        count += pivot > 0
    return count


def slices(v: np.ndarray, k: int) -> list[tuple[float, float, int]]:
    """Intervals (low, high, number of eigenvalues) from the top down that hold the k largest eigenvalues above rounding level.

    An interval is narrowed until there are eigenvalues in both of its halves, and cut where none is near, if it can be.
    """
    size = float(np.abs(v).sum(1).max(initial=0))
    t, floor = tridiagonal(v), size * NULL
    todo, found, held = [(floor, size * 1.01, above(t, floor), 0)], [], 0
    while todo and held < k:
        low, high, n_low, n_high = todo.pop()
        n = n_low - n_high
        if not n:
            continue
        while high - low > 1e-10 * size:
            middle = 0.5 * (low + high)
            n_middle = above(t, middle)
            if n_middle == n_low:
                low = middle
            elif n_middle == n_high:
                high = middle
            else:
                break
        width = high - low
        if n <= SLICE or width <= 1e-9 * size:
            found.append((low - 0.25 * width if low > floor and above(t, low - 0.25 * width) == n_low else low, high, n))
            held += n
            continue
        for share, margin in [*((s, 0.02) for s in (0.5, 0.45, 0.55, 0.4, 0.6, 0.35, 0.65)), (0.5, 1e-12), (0.47, 1e-12), (0.53, 1e-12)]:
            middle, n_middle = low + share * width, above(t, low + share * width)
            if above(t, middle - margin * width) == n_middle == above(t, middle + margin * width):
                break
        todo += [(low, middle, n_low, n_middle), (middle, high, n_middle, n_high)]
    return found


def interval(v: np.ndarray, low: float, high: float, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The n eigenvalues within an interval and their unit eigenvectors, by FEAST."""
    d, size = len(v), float(np.abs(v).sum(1).max())
    center, radius = 0.5 * (low + high), 0.5 * (high - low)
    x, w = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(0.5j * np.pi * (1 - x))  # upper half circle; the lower half is its conjugate
    shifted = np.array([(center + radius * t) * np.eye(d) - v for t in turn])
    rng = np.random.default_rng(seed)
    block = rng.standard_normal((d, min(d, n + max(4, n // 2))))
    for turn_no in range(ROUNDS):
        solved = np.linalg.solve(shifted, np.broadcast_to(block, (NODES, *block.shape)))
        projected = np.einsum("j,jab->ab", 0.5 * w * radius * turn, solved).real
        basis = np.linalg.qr(projected)[0]
        e, y = np.linalg.eigh(basis.T @ v @ basis)  # Rayleigh-Ritz
        block = basis @ y
        residual = np.linalg.norm(v @ block - block * e, axis=0)
        inside = np.flatnonzero((e > low) & (e <= high) & (residual <= 8 * EPS * size * np.sqrt(d)))  # others are no eigenpairs
        if len(inside) == n:
            q = block[:, inside]
            return e[inside], q / np.linalg.norm(q, axis=0)
        if turn_no % 6 == 5 and block.shape[1] < d:  # more eigenvalues at the interval's ends than the block has room for
            block = np.hstack([block, rng.standard_normal((d, min(block.shape[1], d - block.shape[1])))])
    raise ArithmeticError(f"{len(inside)} eigenvalues between {low} and {high}, where inertia counts {n}")


def components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and their eigenvectors as columns; fewer, if fewer are above rounding level."""
    parts = [interval(v, low, high, n, seed) for seed, (low, high, n) in enumerate(slices(v, k))]
    if not parts:
        return np.zeros(0), np.zeros((len(v), 0))
    e, q = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts], axis=1)
    order = np.argsort(-e, kind="stable")[:k]
    # vectors of neighbouring intervals come from different blocks: one last Rayleigh-Ritz step makes them orthogonal
    basis = np.linalg.qr(q[:, np.argsort(-e, kind="stable")])[0]
    e, y = np.linalg.eigh(basis.T @ v @ basis)
    return e[::-1][: len(order)], (basis @ y)[:, ::-1][:, : len(order)]


@dataclass
class Whitening:
    """What a fit knows: number of distinct vectors, their sums, the components and the error of the identity."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole, part = np.divmod(self.sums, self.n)  # the mean as a whole number and a rest: subtracting loses nothing
        return (x - whole).astype(float) - part / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact squared distances from the sums, in units of 1/n."""
        if (self.n + 1.0) * np.abs(x).max(initial=0) * 2 < 2**62:
            gap = x * self.n - self.sums
            if float(np.abs(gap).max(initial=0)) ** 2 * gap.shape[1] < 2**62:
                return (gap * gap).sum(1).tolist()
        return [sum((self.n * a - s) ** 2 for a, s in zip(row, self.sums.tolist())) for row in x.tolist()]


def fixed_point(df: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, x): the rows whose vector has finite components only, those as whole numbers.

    Left out are null and empty vectors and those with a null or non-finite component. Of several lengths the most frequent
    one counts, the shorter of equally frequent ones; vectors of other lengths are left out. Repeated and null ids stay.
    """
    rows = only(df, "vec_id", column).select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.filter((F.size("v") > 0) & F.coalesce(finite, F.lit(False)))
    length = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if length is not None:
        rows = rows.filter(F.size("v") == length.d)
    limit = float(LARGEST)
    x = F.transform("v", lambda c: (F.floor(F.greatest(F.least(c * SCALE, F.lit(limit)), F.lit(-limit)))).cast("bigint") + SHIFT)
    return rows.select("vec_id", x.alias("x"))


def summed(rows: DataFrame, make, width: int) -> np.ndarray:
    """The sum over all rows of ``make(x)``, a matrix of ``width`` columns: one matrix a task, added line by line in Spark."""
    schema = pa.schema([("line", pa.int32()), ("v", pa.list_(pa.float64()))])

    def part(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches(parts):
            m = make(matrix_of_longs(b.column("x")))
            total = m if total is None else total + m
        if total is not None:
            yield out(schema, np.arange(len(total), dtype=np.int32), total.tolist())

    lines = rows.select("x").mapInArrow(part, "line int, v array<double>").groupBy("line")
    got = lines.agg(*[F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(width)]).orderBy("line").collect()
    return np.array([r[1:] for r in got], float).reshape(-1, width)


def matrix_of_longs(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def fit(rows: DataFrame, k: int = 16) -> Whitening | None:
    """Components of the distinct vectors of (vec_id, x); None without rows.

    A vector counts once, however often it occurs; a task sends each of its vectors once. Vectors that are all alike have no
    component with variance, and of rank-deficient ones only the components above rounding level are found.
    """
    distinct = settle(rows.select("x").distinct(), "distinct")
    first = distinct.first()
    if first is None:
        forget(distinct)
        return None
    d = len(first.x)
    total = distinct.agg(F.count("*"), *[F.sum(F.col("x")[i]) for i in range(d)]).first()
    model = Whitening(total[0], np.array(total[1:], np.int64), np.zeros(0), np.zeros((d, 0)), 0.0)

    def products(x: np.ndarray) -> np.ndarray:
        c = model.centred(x)
        return c.T @ c

    v = summed(distinct, products, d) / model.n
    v = 0.5 * (v + v.T)
    model.trace = float(np.trace(v))
    model.values, model.vectors = components(v, k)
    own = len(model.values)
    if own:

        def moments(x: np.ndarray) -> np.ndarray:
            w = model.whitened(x)
            return np.vstack([w.sum(0), w.T @ w])

        m = summed(distinct, moments, own) / model.n
        model.identity_error = float(np.abs(m[1:] - np.outer(m[0], m[0]) - np.eye(own)).max())
    forget(distinct)
    return model


RESULT = "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, model: Whitening | None) -> DataFrame:
    """One row for each row of (vec_id, x) and component, numbered from 1 by falling variance; none without components."""
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], RESULT)
    own, explained = len(model.values), model.values / model.trace
    schema = pa.schema([("vec_id", pa.int64()), ("deviation", pa.decimal128(38, 0)), ("w", pa.list_(pa.float64()))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            x = matrix_of_longs(b.column("x"))
            w = model.whitened(x)
            lists = pa.ListArray.from_arrays(np.arange(0, w.size + 1, own, dtype=np.int32), w.ravel())
            yield out(schema, b.column("vec_id"), pa.array(map(int, model.deviations(x)), pa.decimal128(38, 0)), lists)

    done = rows.mapInArrow(run, "vec_id bigint, deviation decimal(38,0), w array<double>")
    shares = F.array(*[F.lit(float(s)) for s in explained])
    long = done.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return long.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))
