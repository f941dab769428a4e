"""Approximate nearest neighbours by collision counting.

Every vector is projected on ``PROJECTIONS`` random directions; a block of vectors keeps
one sorted array a direction.  For a query, a window centred at its projection grows by
virtual rehashing (its half width times ``GROWTH``); a vector collides in a direction
when the window covers it, and one that collides in at least ``THRESHOLD`` directions is
verified by its distance.  A vector at distance d is within half width h in a direction
with probability erf(h / (d sqrt 2)), so the windows stop growing at ``SURE`` times the
k-th distance found: a nearer vector has then been verified with probability over 0.98.
Nothing caps the vectors verified.

Every row is indexed.  Queries go round in broadcast blocks of bounded size; a task
runs a block of queries over its vectors and hands on k results a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PROJECTIONS, THRESHOLD = 48, 24
GROWTH, SURE = 1.5, 1.0
#: Vectors of a sorted block, and numbers in a broadcast block of queries (32 MB).
BLOCK, QUERY_NUMBERS = 8192, 4_000_000


def directions(dim: int) -> np.ndarray:
    return np.random.default_rng(dim).standard_normal((dim, PROJECTIONS))


def usable(v) -> bool:
    return v is not None and len(v) > 0 and None not in v and bool(np.isfinite(x := np.array(v, float)).all()) and bool(x.any())


class Block:
    """Sorted projections of some vectors of one dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.distinct = len(np.unique(ids)) == len(ids)
        p = vectors @ directions(vectors.shape[1])
        self.order = np.argsort(p, axis=0, kind="stable").T.astype(np.int32).copy()
        self.sorted = np.sort(p, axis=0).T.copy()
        self.step = max(float(p.std(axis=0).mean()) * 0.05, 1e-12)
        self.reach = float(np.abs(p).max())

    def search(self, own: int, query: np.ndarray, at: np.ndarray, k: int, best: list[tuple[float, int]]) -> list[tuple[float, int]]:
        """``best`` (distance, id), ascending, with what this block adds, k at most."""
        n, rows = len(self.ids), self.order
        counts, done = np.zeros(n, np.int64), self.ids == own
        lo = np.array([np.searchsorted(s, x) for s, x in zip(self.sorted, at)])
        hi = lo.copy()
        half = self.step
        while True:
            parts = []
            for j, (s, x) in enumerate(zip(self.sorted, at.tolist())):
                a, b = int(s.searchsorted(x - half, "left")), int(s.searchsorted(x + half, "right"))
                if a < lo[j]:
                    parts.append(rows[j, a:lo[j]])
                    lo[j] = a
                if b > hi[j]:
                    parts.append(rows[j, hi[j]:b])
                    hi[j] = b
            if parts:
                counts += np.bincount(np.concatenate(parts), minlength=n)
                new = np.flatnonzero((counts >= THRESHOLD) & ~done)
                if len(new):
                    done[new] = True
                    d = np.sqrt(((self.vectors[new] - query) ** 2).sum(axis=1))
                    if not self.distinct:
                        new, d = self._nearest_places(new, d)
                    if len(new) > 4 * k:
                        near = d <= np.partition(d, k)[k]
                        new, d = new[near], d[near]
                    best = sorted({*best, *zip(d.tolist(), self.ids[new].tolist())})
                    best = _first_of_each(best, k)
            if len(best) >= k and half >= SURE * best[-1][0] or half > 2 * self.reach + float(np.abs(at).max()):
                return best
            half *= GROWTH

    def _nearest_places(self, rows: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the rows of a vec_id the nearest one, so that what is cut by rank are ids."""
        order = np.lexsort((d, self.ids[rows]))
        rows, d = rows[order], d[order]
        first = np.concatenate(([True], self.ids[rows[1:]] != self.ids[rows[:-1]]))
        return rows[first], d[first]


def _first_of_each(best: list[tuple[float, int]], k: int) -> list[tuple[float, int]]:
    seen: dict[int, float] = {}
    for d, i in best:
        seen.setdefault(i, d)
        if len(seen) == k:
            break
    return [(d, i) for i, d in seen.items()]


def _search(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value  # dimension -> (ids, vectors)
        best: dict[int, list] = {}
        held: dict[int, list] = {}

        def flush(dim: int) -> None:
            rows = held.pop(dim)
            ids, vectors = queries[dim]
            block = Block(np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.float64))
            for q, v, at in zip(ids.tolist(), vectors, vectors @ directions(dim)):
                best[q] = block.search(q, v, at, k, best.get(q, []))

        for batch in batches:
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist()):
                if i is not None and usable(v) and len(v) in queries:
                    held.setdefault(len(v), []).append((i, v))
                    if len(held[len(v)]) >= BLOCK:
                        flush(len(v))
        for dim in list(held):
            flush(dim)
        rows = [(q, i, d) for q, found in best.items() for d, i in found]
        if rows:
            q, i, d = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array(d, pa.float64())],
                                             ["query_id", "vec_id", "score"])
    return run


def _usable(v):
    """``usable`` as a column."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _query_blocks(queries: DataFrame, numbers: int) -> Iterator[dict[int, tuple[np.ndarray, np.ndarray]]]:
    held: dict[int, list] = {}
    n = 0

    def block():
        return {d: (np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.float64)) for d, rows in held.items()}

    for r in queries.toLocalIterator():
        if usable(r.embedding):
            held.setdefault(len(r.embedding), []).append((r.vec_id, r.embedding))
            n += len(r.embedding)
        if n >= numbers:
            yield block()
            held, n = {}, 0
    if held:
        yield block()


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, query_numbers: int = QUERY_NUMBERS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every query among the rows
    of ``vectors`` with another vec_id, by Euclidean distance in double precision, ties to
    the smaller vec_id.

    Both tables have vec_id and embedding.  Rows with a null id, or whose vector is null,
    empty, zero or holds a null or non-finite component, take no part; vectors of another
    dimension than the query's are no candidates.  Rows that repeat a vec_id count as one
    at the nearest of their places; of a repeated query the smallest usable vector is asked."""
    spark = vectors.sparkSession
    asked = queries.where(F.col("vec_id").isNotNull() & _usable(F.col("embedding"))).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    found = None
    for block in _query_blocks(asked, query_numbers):
        one = rows.mapInArrow(_search(spark.sparkContext.broadcast(block), k), "query_id long, vec_id long, score double")
        found = one if found is None else found.unionByName(one)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    first = W.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
            .withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
