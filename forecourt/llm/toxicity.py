"""Toxicity by maximum-scoring segments.

Training counts, over labelled documents, in how many distinct texts of each class a
token stands.  A token's score is its log-odds under a Dirichlet prior that splits
``PRIOR`` documents as the classes are split, less ``SURE`` standard errors; a token
without positive evidence scores ``-DRIFT``.  A linear-time scan finds every maximal
scoring segment of a text.  Extreme-value statistics say how many segments as good a
clean text of that length has by chance (E = K n exp(-lambda S)); a document's evidence
is the sum of -ln E over its significant segments, and a logistic curve fitted on the
training documents turns it into a probability.

The classifier is fitted on a bounded sample of labelled rows (``TRAIN_ROWS``, the
smallest hashes of doc_id), so what is collected and broadcast is bounded by it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import slices, small_batches, written

TOKEN = re.compile(r"[^\W_]+")
#: Labelled rows that the classifier is fitted on, at most.
TRAIN_ROWS = 40_000
#: Documents in the Dirichlet prior of a token; standard errors taken off its log-odds.
PRIOR, SURE = 5.0, 3.0
#: What a token without evidence costs a segment.
DRIFT = 0.2
#: A segment counts when a clean text has fewer than this many as good ones.
E_MAX = 0.5


@dataclass
class Model:
    scores: dict[str, float]
    lam: float = 1.0
    log_k: float = 0.0
    #: Logistic curve: probability = 1 / (1 + exp(-(bias + slope * log(1 + evidence)))).
    bias: float = -20.0
    slope: float = 0.0

    def segments(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        """(tokens, maximal segments as (first token, end token, score))."""
        if not text:
            return 0, []
        tokens = TOKEN.findall(text.lower())
        get = self.scores
        hits = [(i, get[w]) for i, w in enumerate(tokens) if w in get]
        return len(tokens), maximal_segments(hits)

    def evidence(self, n: int, segments: list[tuple[int, int, float]]) -> float:
        total = 0.0
        for _, _, s in segments:
            log_e = self.log_k + math.log(max(n, 1)) - self.lam * s
            if log_e < math.log(E_MAX):
                total -= log_e
        return total

    def probability(self, evidence: float) -> float:
        z = self.bias + self.slope * math.log1p(evidence)
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def maximal_segments(hits: list[tuple[int, float]], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of a text whose positive tokens are ``hits``
    (position, score) and whose other tokens score ``-drift``."""
    total, before = 0.0, 0
    out: list[tuple[int, int, float]] = []
    # Candidates: first, end, sum left of it, sum at its end, last one before with a smaller left sum.
    found: list[tuple[int, int, float, float, int]] = []
    for i, s in hits:
        total -= drift * (i - before)
        first, end, left, right = i, i + 1, total, total + s
        total, before = right, i + 1
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0:
                # Nothing before can join what comes: all candidates are final.
                out += [(a, b, r - lo) for a, b, lo, r, _ in found]
                found = [(first, end, left, right, -1)]
                break
            if found[j][3] >= right:
                found.append((first, end, left, right, j))
                break
            first, left = found[j][0], found[j][2]
            del found[j:]
    return out + [(a, b, r - lo) for a, b, lo, r, _ in found]


def labelled_sample(docs: DataFrame, labels: DataFrame, train: Column, rows: int) -> DataFrame:
    """(doc_id, y) of at most ``rows`` labelled documents with distinct texts.  A doc_id
    with several labels is toxic if one of them says so; a doc_id that several rows of
    ``docs`` share is not in the sample, so the bound holds for rows too."""
    y = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
         .groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("y")))
    sample = y.where(train).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    one = (docs.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "y")
           .agg(F.count("*").alias("n"), F.min(F.xxhash64("text")).alias("h")).where("n = 1").groupBy("h").agg(F.min(F.struct("doc_id", "y")).alias("r")))
    return written(one.select("r.doc_id", "r.y"), "toxicity-sample")


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, documents toxic, documents clean), summed before they leave the task."""
    counts: dict[str, list[int]] = {}

    def out():
        keys = list(counts)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()),
                                          pa.array([counts[k][0] for k in keys], pa.int64()),
                                          pa.array([counts[k][1] for k in keys], pa.int64())], ["token", "n1", "n0"])
        counts.clear()

    for batch in batches:
        for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
            for w in set(TOKEN.findall((text or "").lower())):
                counts.setdefault(w, [0, 0])[0 if y else 1] += 1
            if len(counts) > 200_000:
                yield from out()
    yield from out()


def fit(docs: DataFrame, labels: DataFrame, train: Column, rows: int = TRAIN_ROWS) -> Model:
    """Fits on the labelled rows for which ``train`` (a condition on doc_id) holds.
    Without rows of both classes nothing scores and every probability is about 0."""
    spark = docs.sparkSession
    small_batches(spark)
    sample = labelled_sample(docs, labels, train, rows)
    sizes = dict(sample.groupBy("y").count().collect())
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return Model({})
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "y")
    counts = texts.mapInArrow(_token_counts, "token string, n1 long, n0 long").groupBy("token").agg(
        F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    p1 = n1 / (n1 + n0)
    a1, a0 = F.col("n1") + PRIOR * p1, F.col("n0") + PRIOR * (1 - p1)
    score = (F.log(a1 / (n1 + PRIOR * p1)) - F.log(a0 / (n0 + PRIOR * (1 - p1)))
             - SURE * F.sqrt(1 / a1 + 1 / a0))
    kept = counts.where("n1 > 1").withColumn("s", score).where("s > 0").orderBy("token").collect()
    model = Model({r.token: float(r.s) for r in kept})
    if not kept:
        return model
    _calibrate(model, texts, np.array([r.s for r in kept]), np.array([r.n0 for r in kept], dtype=float),
               PRIOR * (1 - p1), n0)
    return model


def _calibrate(model: Model, texts: DataFrame, s: np.ndarray, clean: np.ndarray, prior: float, n0: int) -> None:
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            rows = [m.segments(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                pa.array([n for n, _ in rows], pa.int64()), pa.array([np.array([g[2] for g in seg], "<f4").tobytes() for _, seg in rows], pa.binary()),
                batch.column("y").cast(pa.int32())], ["n", "s", "y"])

    got = texts.mapInArrow(run, "n long, s binary, y int").collect()
    best = [np.frombuffer(r.s, "<f4") for r in got]
    mean_tokens = max(1.0, float(np.mean([r.n for r in got if not r.y] or [1])))
    # Chance of each token in a clean text's next token, by documents.
    p = (clean + prior) / (n0 + 2 * prior) / mean_tokens
    p = p * min(1.0, 0.5 * DRIFT / float((p * s).sum()))  # the mean score stays negative
    lo, hi = 0.0, 1.0
    expect = lambda lam: float((p * np.exp(lam * s)).sum() + (1 - p.sum()) * math.exp(-lam * DRIFT))
    while expect(hi) < 1 and hi < 64:
        lo, hi = hi, hi * 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if expect(mid) < 1 else (lo, mid)
    model.lam = max(hi, 1e-3)
    u = [r.n * math.exp(-model.lam * float(x.max(initial=0))) for r, x in zip(got, best) if not r.y and r.n]
    model.log_k = math.log(len(u) / max(sum(u), 1e-300)) if u else 0.0
    x = np.array([math.log1p(model.evidence(r.n, [(0, 0, v) for v in x.tolist()])) for r, x in zip(got, best)])
    y = np.array([r.y for r in got], dtype=float)
    model.bias, model.slope = _logistic(x, y)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Newton's method; toxic rows weigh as the root of how much rarer they are."""
    a, w = np.stack([np.ones_like(x), x], axis=1), np.zeros(2)
    weight = np.where(y == 1, ((1 - y.mean()) / max(y.mean(), 1e-9)) ** 0.5, 1.0)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + ridge * np.eye(2)
        w = w + np.linalg.solve(h, a.T @ (weight * (y - p)) - ridge * w)
    return float(w[0]), float(max(w[1], 0.0))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with toxicity (0 to 1) and passages: array of (first token, end token,
    score, e_value) of its significant segments.  Null, empty and token-free texts have
    no passage and the lowest probability.  Input columns of those names are replaced."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    base = docs.drop("toxicity", "passages")
    item = pa.struct([("first", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("e_value", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                prob, passages = [], []
                for text in part.column("text").to_pylist():
                    n, segments = m.segments(text)
                    prob.append(m.probability(m.evidence(n, segments)))
                    rows = [(a, b, s, math.exp(m.log_k + math.log(n) - m.lam * s)) for a, b, s in segments]
                    passages.append([r for r in rows if r[3] < E_MAX])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(prob, pa.float64()),
                     pa.array([[dict(zip(("first", "end", "score", "e_value"), r)) for r in p] for p in passages],
                              pa.list_(item))],
                    [*part.schema.names, "toxicity", "passages"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(run, schema + ", toxicity double, passages array<struct<first:int,end:int,score:double,e_value:double>>")


def fold(mod: int) -> Column:
    """crc32 of doc_id as text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % mod
