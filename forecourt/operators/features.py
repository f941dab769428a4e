"""Fitted feature pipelines (MLX-11/12/13): learned on train, saved, applied to
any later rows.

``TextProjection`` hashes the tokens of a text into buckets and projects the
normalised counts on the leading right singular vectors of the training matrix.
The vectors come from a randomised range finder with subspace iterations: each
pass broadcasts a (buckets x width) matrix, whose size the parameters fix, the
tasks return their partial sums by bucket, and Spark adds them up.  The matrix
of the rows is never collected; what reaches the driver does not grow with them.

``FeaturePipeline`` scales numeric columns (one that does not vary is dropped),
makes 0/1 columns of the most frequent categories and projects text columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.operators.ml import top_values
from forecourt.session import free_shuffles

BUCKETS, COMPONENTS = 100_000, 50
OVERSAMPLE, PASSES = 10, 5
TOP_VALUES = 100
#: Tokens counted at once (or one longer text).
ENTRIES = 1 << 16
#: Words of at least two word characters.
TOKEN = r"\w\w+"


def hashed_tokens(text: Column, buckets: int) -> Column:
    """Signed bucket numbers (from 1) of a text's tokens, repeats included; null text has none."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))
    return F.transform(words, lambda w: ((F.pmod(F.xxhash64(w), F.lit(buckets)) + 1)
                                         * F.when(F.xxhash64(F.lit("sign"), w) < 0, -1).otherwise(1)).cast("int"))


def _sparse(tokens: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and weight of the entries of a batch: signed token counts, rows of length 1."""
    signed = tokens.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(tokens)), np.array(tokens.value_lengths().to_pylist(), np.int64))
    bucket = np.abs(signed) - 1
    key, at = np.unique(row * (bucket.max(initial=0) + 1) + bucket, return_inverse=True)
    weight = np.bincount(at, weights=np.sign(signed), minlength=len(key))
    row, bucket = np.divmod(key, bucket.max(initial=0) + 1)
    norm = np.sqrt(np.bincount(row, weights=weight ** 2, minlength=len(tokens)))
    return row, bucket, weight / np.where(norm[row] > 0, norm[row], 1.0)


def _texts(row: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each row that has entries, and where they are (rows are in order)."""
    starts = np.flatnonzero(np.diff(row, prepend=-1)).tolist()
    yield from ((row[a], slice(a, b)) for a, b in zip(starts, [*starts[1:], len(row)]))


def _times(row: np.ndarray, bucket: np.ndarray, weight: np.ndarray, n: int, matrix: np.ndarray) -> np.ndarray:
    """Sparse rows times a dense matrix, a row at a time: what a text gathers stays in the processor's cache."""
    out = np.zeros((n, matrix.shape[1]))
    for i, at in _texts(row):
        out[i] = weight[at] @ matrix[bucket[at]]
    return out


def _orthonormal(w: np.ndarray) -> np.ndarray:
    """``w`` overwritten by orthonormal columns of its span, a block of rows at a time."""
    width, blocks = w.shape[1], np.array_split(np.arange(len(w)), max(1, len(w) // 8192))
    if len(blocks) == 1:
        return np.linalg.qr(w)[0]
    tops = []
    for at in blocks:
        w[at], top = np.linalg.qr(w[at])
        tops.append(top)
    turn = np.linalg.qr(np.vstack(tops))[0]
    for i, at in enumerate(blocks):
        w[at] = w[at] @ turn[i * width:(i + 1) * width]
    return w


def _slices(tokens: pa.Array) -> Iterator[pa.Array]:
    """A batch's texts in runs of about ``ENTRIES`` tokens."""
    upto = np.cumsum(pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    starts = np.flatnonzero(np.diff(upto // ENTRIES, prepend=-1))
    for a, b in zip(starts, [*starts[1:], len(tokens)]):
        yield tokens.slice(a, b - a)


def _normal_product(shared, column: str):
    """Partial sums of A' (A W) by bucket, W the shared matrix of the shared buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, w = shared.value
        total = np.zeros_like(w)
        for tokens in (x for batch in batches for x in _slices(batch.column(column))):
            row, bucket, weight = _sparse(tokens)
            bucket = np.searchsorted(met, bucket)
            for _, at in _texts(row):  # the buckets of a text are distinct
                b, x = bucket[at], weight[at]
                total[b] += x[:, None] * (x @ w[b])
        at = np.flatnonzero(total.any(axis=1))
        for a in range(0, len(at), 4096):
            some = at[a:a + 4096]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), *[pa.array(total[some, i]) for i in range(w.shape[1])]],
                                             ["place", *(f"z{i}" for i in range(w.shape[1]))])
    return run


def _pass(rows: DataFrame, column: str, met: np.ndarray, w: np.ndarray) -> np.ndarray:
    width = w.shape[1]
    free_shuffles(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast((met, w))  # met buckets x width, whatever the rows
    parts = rows.mapInArrow(_normal_product(shared, column), ", ".join(["place long", *(f"z{i} double" for i in range(width))]))
    summed = parts.groupBy("place").agg(*[F.sum(f"z{i}").alias(f"z{i}") for i in range(width)]).toArrow()
    shared.destroy()  # its file on the driver goes too
    out, place = np.zeros_like(w), summed.column("place").to_numpy()
    for i in range(width):  # a column at a time: the driver holds the sums twice at most
        out[place, i] = summed.column(f"z{i}").to_numpy()
    return out


@dataclass
class TextModel:
    """A fitted projection: ``vectors`` (buckets x components), ``singular`` values."""
    column: str
    vectors: np.ndarray
    singular: np.ndarray

    def transform(self, df: DataFrame, out: str) -> DataFrame:
        """All rows with the components as an array column ``out``; a text without tokens is the origin."""
        hashed = df.withColumn("_tokens", hashed_tokens(F.col(self.column), len(self.vectors)))
        schema = T.StructType([*[f for f in hashed.schema.fields if f.name != "_tokens"], T.StructField(out, T.ArrayType(T.DoubleType()))])
        met = np.flatnonzero(self.vectors.any(axis=1))  # other buckets add nothing
        shared = df.sparkSession.sparkContext.broadcast((met, self.vectors[met]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            met, v = shared.value
            for batch in batches:
                y = [np.zeros((0, v.shape[1]))]
                for tokens in _slices(batch.column("_tokens")):
                    row, bucket, weight = _sparse(tokens)
                    at = np.searchsorted(met, bucket)
                    known = np.isin(bucket, met)
                    y.append(_times(row[known], at[known], weight[known], len(tokens), v))
                y = np.concatenate(y)
                kept = [c for c in batch.schema.names if c != "_tokens"]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * y.shape[1], pa.int32()), pa.array(y.ravel()))
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], lists], [*kept, out])
        return hashed.mapInArrow(run, schema)


def fit_text(train: DataFrame, column: str, components: int = COMPONENTS, buckets: int = BUCKETS, passes: int = PASSES,
             seed: int = 0) -> TextModel:
    """Truncated SVD of the hashed token matrix of ``train``.  Fewer components than asked for
    where the matrix has no more (none for an empty table)."""
    rows = train.select(hashed_tokens(F.col(column), buckets).alias("tokens")).persist()
    # A task of a pass writes sums of up to all buckets: no more tasks than run at once.
    held, rows = rows, rows.coalesce(train.sparkSession.sparkContext.defaultParallelism)
    found = rows.select(F.explode("tokens").alias("b")).select((F.abs("b") - 1).alias("b")).distinct().toArrow()  # at most all buckets
    met = np.sort(found.column("b").to_numpy()).astype(np.int64)
    if not len(met):
        held.unpersist()
        return TextModel(column, np.zeros((buckets, 0)), np.zeros(0))
    width = min(buckets, components + OVERSAMPLE)
    # Only the span of the start counts, so the rows of the met buckets do.
    w = _orthonormal(np.random.default_rng(seed).standard_normal((buckets, width))[met])
    for _ in range(passes):
        w = _orthonormal(_pass(rows, "tokens", met, w))
    image = _pass(rows, "tokens", met, w)
    values, turn = np.linalg.eigh(w.T @ image)
    del image
    order = np.argsort(-values)[:components]
    order = order[values[order] > 1e-12 * max(values.max(), 1e-300)] if values.max() > 0 else order[:0]
    v = np.zeros((buckets, len(order)))
    v[met] = w @ turn[:, order]
    v *= np.where(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])] < 0, -1.0, 1.0) if v.shape[1] else 1.0
    held.unpersist()
    return TextModel(column, v, np.sqrt(values[order]))


@dataclass
class FittedFeatures:
    """Learned on train: scales (column, shift, factor) of the columns that vary, the values of
    each category, a projection a text column."""
    scales: list[tuple[str, float, float]]
    values: dict[str, list[str]]
    texts: list[TextModel] = field(default_factory=list)

    @property
    def names(self) -> list[str]:
        return [c for c, _, _ in self.scales] + [f"{c}_{v}" for c, vs in self.values.items() for v in vs] + \
            [f"{t.column}:text:{i}" for t in self.texts for i in range(t.vectors.shape[1])]

    def transform(self, df: DataFrame, out: str = "features") -> DataFrame:
        """All rows and columns of ``df`` with the feature vector; a missing number is the train's
        mean (after scaling: 0 for 'standard'), an unknown category all zeros."""
        for i, t in enumerate(self.texts):
            df = t.transform(df, f"_text{i}")
        numbers = [F.coalesce((F.col(c).cast("double") - shift) * factor, F.lit(0.0)) for c, shift, factor in self.scales]
        known = [F.coalesce((F.col(c).cast("string") == v).cast("double"), F.lit(0.0)) for c, vs in self.values.items() for v in vs]
        parts = [F.array(*numbers, *known).cast("array<double>"), *[F.col(f"_text{i}") for i in range(len(self.texts))]]
        return df.withColumn(out, array_to_vector(F.concat(*parts))).drop(*[f"_text{i}" for i in range(len(self.texts))])

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [("scale", c, "", a, [b]) for c, a, b in self.scales] + [("value", c, v, float(i), []) for c, vs in self.values.items() for i, v in enumerate(vs)]
        rows += [("category", c, "", 0.0, []) for c in self.values]
        rows += [("text", t.column, str(i), float(len(t.vectors)), t.singular.tolist()) for i, t in enumerate(self.texts)]
        schema = "kind string, column string, text string, number double, numbers array<double>"
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{path}/parts")
        for i, t in enumerate(self.texts):
            at = np.flatnonzero(t.vectors.any(axis=1))
            table = pa.table({"bucket": pa.array(at, pa.int64()), "vector": pa.array(list(t.vectors[at]), pa.list_(pa.float64()))})
            spark.createDataFrame(table).write.mode("overwrite").parquet(f"{path}/text{i}")

    @staticmethod
    def load(spark: SparkSession, path: str) -> FittedFeatures:
        rows = spark.read.parquet(f"{path}/parts").collect()  # categories and scales
        of = lambda kind: [r for r in rows if r["kind"] == kind]
        values = {r["column"]: [v["text"] for v in sorted(of("value"), key=lambda v: v["number"]) if v["column"] == r["column"]] for r in of("category")}
        texts = []
        for r in sorted(of("text"), key=lambda r: int(r["text"])):
            found = spark.read.parquet(f"{path}/text{r['text']}").toArrow()  # buckets x components, a fixed size
            v = np.zeros((int(r["number"]), len(r["numbers"])))
            if found.num_rows:
                v[found.column("bucket").to_numpy()] = np.stack(found.column("vector").to_pylist())
            texts.append(TextModel(r["column"], v, np.array(r["numbers"])))
        return FittedFeatures([(r["column"], r["number"], r["numbers"][0]) for r in of("scale")], values, texts)


@dataclass
class FeaturePipeline:
    """What to make features of: ``numeric`` columns with 'standard' or 'minmax', ``categories``
    (their ``top`` most frequent values), ``texts``."""
    numeric: dict[str, str] = field(default_factory=dict)
    categories: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    top: int = TOP_VALUES
    buckets: int = BUCKETS
    components: int = COMPONENTS

    def fit(self, train: DataFrame) -> FittedFeatures:
        scales = []
        if self.numeric:
            r = train.agg(*[f(F.col(c).cast("double")).alias(f"{k}{i}") for i, c in enumerate(self.numeric)
                            for k, f in (("lo", F.min), ("hi", F.max), ("mean", F.avg), ("sd", F.stddev_samp))]).first()
            for i, (c, how) in enumerate(self.numeric.items()):
                lo, hi = r[f"lo{i}"], r[f"hi{i}"]
                if lo is not None and hi > lo:  # a column that does not vary is dropped
                    scales.append((c, lo, 1.0 / (hi - lo)) if how == "minmax" else (c, r[f"mean{i}"], 1.0 / r[f"sd{i}"]))
        values = {c: [str(v) for v in top_values(train.where(F.col(c).isNotNull()), c, self.top)] for c in self.categories}
        return FittedFeatures(scales, values, [fit_text(train, c, self.components, self.buckets) for c in self.texts])
