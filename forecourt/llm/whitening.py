"""Embedding whitening by spectrum slicing.

The covariance is taken in two passes, the sums first, so that products are of centred
vectors.  Its leading eigenpairs come from slicing: the inertia of the LDL' factors of
V - sI counts the eigenvalues above s, bisection on the counts isolates each leading
eigenvalue in an interval of its own, Rayleigh quotient iteration converges cubically from
there, and counts on both sides of the result certify its number.  Eigenvalues that no
double tells apart are one cluster with an orthonormal basis.

Spark makes the sums and the projections; the driver holds matrices of the dimension only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.llm.common import small_batches

COMPONENTS = 32
#: x = floor(SCALE * c) + SHIFT; values beyond LIMIT (which no long sum could hold) count as LIMIT.
SCALE, SHIFT, LIMIT = 64.0, 1_000_000, 2.0 ** 50
#: Eigenvalues below this part of the largest one have no direction to whiten.
FLAT = 1e-12


def _householder(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix similar to v."""
    a, n = v.copy(), len(v)
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        size = np.linalg.norm(x)
        if size == 0:
            continue
        x /= size
        sub = a[k + 1:, k + 1:]
        p = sub @ x
        p -= x * (x @ p)
        sub -= 2 * (np.outer(x, p) + np.outer(p, x))
        a[k + 1:, k] -= 2 * x * (x @ a[k + 1:, k])
        a[k, k + 1:] = a[k + 1:, k]
    return np.diag(a).copy(), np.diag(a, 1).copy()


def counter(v: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """A function of shifts: how many eigenvalues of v lie above each, read off the signs of
    D in LDL' of the shifted matrix (in tridiagonal form, which has the same inertia)."""
    diagonal, off = _householder(v)
    tiny = np.finfo(float).eps * max(1e-300, float(np.abs(diagonal).max(initial=0)), float(np.abs(off).max(initial=0)))
    square = off ** 2

    def above(shifts: np.ndarray) -> np.ndarray:
        shifts = np.atleast_1d(np.asarray(shifts, float))
        d = diagonal[0] - shifts
        found = (d > 0).astype(np.int64)
        for a, b in zip(diagonal[1:], square):
            d = a - shifts - b / np.where(np.abs(d) < tiny, -tiny, d)
            found += d > 0
        return found
    return above


def _slices(above, low: float, high: float, k: int, tol: float) -> tuple[np.ndarray, np.ndarray]:
    """For each of the k largest eigenvalues bounds with above(lo) >= j > above(hi), halved
    until an interval holds one eigenvalue and is a hundredth of the distance to its
    neighbours, or is as narrow as doubles are."""
    lo, hi = np.full(k, low), np.full(k, high)
    number = np.arange(1, k + 1)
    while True:
        width = hi - lo
        single = (above(lo) == number) & (above(hi) == number - 1)
        gap = np.minimum(np.append(np.inf, lo[:-1] - hi[1:]), np.append(lo[:-1] - hi[1:], lo[-1] - low if k > 1 else np.inf))
        todo = (width > tol) & ~(single & (width <= 0.01 * np.abs(gap)) & (gap > 0))
        if not todo.any():
            return lo, hi
        mid = (lo + hi) / 2
        many = above(mid) >= number
        lo, hi = np.where(todo & many, mid, lo), np.where(todo & ~many, mid, hi)


def _polished(v: np.ndarray, lo: float, hi: float, known: np.ndarray, start: np.ndarray) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from the interval's middle, kept orthogonal to what is known."""
    def clean(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - known @ (known.T @ x)
        return x / np.linalg.norm(x)

    x, shift, one = clean(start), (lo + hi) / 2, np.eye(len(v))
    scale = float(np.abs(v).max())
    for step in range(30):
        try:
            y = np.linalg.solve(v - shift * one, x)
        except np.linalg.LinAlgError:
            y = np.linalg.solve(v - (shift + scale * 1e-15) * one, x)
        x = clean(y)
        e = float(x @ v @ x)
        if np.linalg.norm(v @ x - e * x) <= 4e-16 * len(v) * scale:
            break
        shift = e if lo <= e <= hi and step else (lo + hi) / 2  # outside: another eigenvalue's basin
    return float(x @ v @ x), x


def leading(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit vectors as
    columns (the entry of largest size is positive).  Numbers are certified by counts."""
    n = len(v)
    k = min(k, n)
    radius = np.abs(v).sum(axis=1) - np.abs(np.diag(v))
    low, high = float((np.diag(v) - radius).min()), float((np.diag(v) + radius).max())
    spread = max(abs(low), abs(high), 1e-300)
    above, tol = counter(v), 8e-16 * n * spread
    lo, hi = _slices(above, low - 4 * tol, high + 4 * tol, k, tol)
    rng = np.random.default_rng(n)
    values, vectors = np.zeros(k), np.zeros((n, k))
    for j in range(k):
        values[j], vectors[:, j] = _polished(v, lo[j] - tol, hi[j] + tol, vectors[:, :j], rng.standard_normal(n))
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    margin = 64 * tol
    over, under = above(values + margin), above(values - margin)
    number = np.arange(1, k + 1)
    if (over >= number).any() or (under < number).any():
        raise ArithmeticError("the counts do not confirm the numbering of the eigenvalues")
    at = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.where(vectors[at, np.arange(k)] < 0, -1.0, 1.0)


@dataclass
class Fit:
    """Whitening of the vectors of one dimension: n x-vectors, their sums, components as columns."""
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n; the whole part of S/n leaves before anything is rounded."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        part = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole) - part

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) @ self.vectors) / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int]:
        """Exact sums of (n x - S)^2, in Python numbers where 64 bits might not hold them."""
        whole, part = zip(*(divmod(s, self.n) for s in self.sums))
        y = x - np.array(whole, np.int64)
        widest = (int(np.abs(y).max(initial=0)) + 1) * self.n
        kind = np.int64 if widest ** 2 * len(self.sums) < 2 ** 63 else object
        return [int(d) for d in ((self.n * y.astype(kind) - np.array(part, kind)) ** 2).sum(axis=1)]


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, x-vectors) of the usable rows of a batch, by dimension."""
    col = batch.column("embedding")
    lengths = np.array([-1 if v is None else v for v in col.value_lengths().to_pylist()])
    for dim in sorted(set(lengths.tolist()) - {-1, 0}):
        at = np.flatnonzero(lengths == dim)
        flat = col.take(pa.array(at)).flatten()
        c = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)  # null becomes nan
        fine = np.isfinite(c).all(axis=1)
        x = np.floor(np.clip(c[fine] * SCALE, -LIMIT, LIMIT))
        yield at[fine], x.astype(np.int64) + SHIFT


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n: dict[int, int] = {}
    sums: dict[int, list[int]] = {}
    for b in batches:
        for rows, x in _matrices(b):
            dim = x.shape[1]
            n[dim] = n.get(dim, 0) + len(rows)
            sums[dim] = [a + int(c) for a, c in zip(sums.get(dim, [0] * dim), x.sum(axis=0))]
    for dim in n:
        yield pa.RecordBatch.from_arrays([pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array([n[dim]] * dim, pa.int64()),
                                          pa.array([str(s) for s in sums[dim]])], ["dim", "i", "n", "s"])


def _products(of: Callable[[int, np.ndarray], np.ndarray], with_sums: bool = False):
    """Sums of products of two coordinates of what ``of`` makes of each vector: a row for each
    coordinate with a row of the upper triangle; coordinate -1 holds the plain sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for _, x in _matrices(b):
                y = of(x.shape[1], x)
                if with_sums:
                    y = np.hstack([y, np.ones((len(y), 1))])
                held[x.shape[1]] = held.get(x.shape[1], 0) + y.T @ y
        for dim, m in held.items():
            i, j = np.triu_indices(len(m))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), dim), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                              pa.array(m[i, j])], ["dim", "i", "j", "p"])
    return run


def _gathered(rows: DataFrame, of, with_sums: bool = False) -> dict[int, np.ndarray]:
    out: dict[int, np.ndarray] = {}
    found = (rows.select("embedding").mapInArrow(_products(of, with_sums), "dim int, i int, j int, p double")
             .groupBy("dim", "i", "j").agg(F.sum("p").alias("p")).collect())
    side: dict[int, int] = {}
    for r in found:
        side[r["dim"]] = max(side.get(r["dim"], 0), r["j"] + 1)
    for r in found:
        m = out.setdefault(r["dim"], np.zeros((side[r["dim"]],) * 2))
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["p"]
    return out


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """Whitening by dimension, fitted on all usable rows of ``vectors`` (embedding): numbers of
    the order of the dimension squared come to the driver, whatever the rows."""
    small_batches(vectors.sparkSession)
    sums = (vectors.select("embedding").mapInArrow(_sums, "dim int, i int, n long, s string")
            .groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    fits: dict[int, Fit] = {}
    for r in sums:
        f = fits.setdefault(r["dim"], Fit(r["n"], [0] * r["dim"], np.zeros(0), np.zeros((r["dim"], 0)), 0.0))
        f.sums[r["i"]] = int(r["s"])
    covariance = _gathered(vectors, lambda dim, x: fits[dim].centred(x)) if fits else {}
    for dim, f in fits.items():
        v = covariance[dim] / f.n
        f.trace = float(np.trace(v))
        if f.trace > 0:
            values, vecs = leading(v, components)
            keep = values > FLAT * values[0]
            f.values, f.vectors = values[keep], vecs[:, keep]
    return fits


def identity_errors(vectors: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """Largest entry, without its sign, of the covariance of the whitened vectors minus the identity."""
    out = {}
    for dim, m in _gathered(vectors, lambda dim, x: fits[dim].whitened(x), with_sums=True).items():
        mean = m[:-1, -1] / m[-1, -1]
        v = m[:-1, :-1] / m[-1, -1] - np.outer(mean, mean)  # whitened vectors are centred already
        out[dim] = float(np.abs(v - np.eye(len(v))).max(initial=0.0))
    return out


def _transform(fits: dict[int, Fit]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, x in _matrices(b):
                f = fits[x.shape[1]]
                exact = f.deviation(x)
                out = f.whitened(x)
                yield pa.RecordBatch.from_arrays(
                    [*b.take(pa.array(rows)).columns, pa.array(np.full(len(rows), f.n), pa.int64()),
                     pa.array([d if d < 2 ** 63 else None for d in exact], pa.int64()), pa.array([str(d) for d in exact]),
                     pa.array(list(out), pa.list_(pa.float64()))], [*b.schema.names, "n", "deviation", "deviation_exact", "whitened"])
    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, dict[int, Fit], dict[int, float]]:
    """Usable rows of ``vectors`` (embedding) with all their columns, and n, deviation,
    deviation_exact (decimal digits) and whitened (an array, component 1 first); the fits; the
    identity errors.  Input columns named like an added one are replaced.

    Rows whose vector is null, empty or holds a null or non-finite entry are left out.  Vectors of
    different dimensions are whitened apart, each over its own.  A component in whose direction
    the vectors do not vary has no scale and is left out: fewer components than asked for
    (none for a single vector).  deviation is null where the exact sum does not fit a long.
    Rows that repeat an id stay rows of their own and all count; an empty table gives no row."""
    base = vectors.drop("n", "deviation", "deviation_exact", "whitened")
    fits = fit(base, components)
    fields = [*base.schema.fields, T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
              T.StructField("deviation_exact", T.StringType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))]
    return base.mapInArrow(_transform(fits), T.StructType(fields)), fits, identity_errors(base, fits) if fits else {}


def components_of(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each
    usable row of ``vectors`` (vec_id, embedding) and component."""
    out, fits, errors = whiten(vectors.select("vec_id", "embedding"), components)
    rows = [(d, c + 1, float(e / f.trace), errors[d]) for d, f in fits.items() for c, e in enumerate(f.values)]
    shown = vectors.sparkSession.createDataFrame(rows, "dim int, component int, explained double, identity_error double")
    long = out.select("vec_id", F.size("embedding").alias("dim"), "n", "deviation", F.posexplode("whitened").alias("_i", "whitened"))
    return (long.withColumn("component", F.col("_i") + 1).join(F.broadcast(shown), ["dim", "component"])  # a row a component
            .select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"))
