"""Language identification with a byte convolutional network.

Bytes fall into 64 classes (letters without case, white space, digits, marks, UTF-8
lead and continuation bytes).  The network embeds them, runs filters of several widths
over a window of 256 bytes, takes the maximum of each filter and a softmax over the
languages; it is trained in numpy on a bounded sample of labelled windows.  Since the
classes are few, a trained filter of width w is a table over 64 ** w class strings, so
prediction is a gather and a maximum.  Every window of a text is predicted, and the
text gets the mean of their probabilities, weighted by bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from forecourt.llm.common import slices, small_batches

WINDOW = 256
WIDTHS, FILTERS, DIM = (1, 2, 3), 8, 8
#: Documents a language, and windows a document, that the network is trained on.
TRAIN_DOCS, TRAIN_WINDOWS = 400, 4
UNKNOWN = "und"


def _classes() -> np.ndarray:
    table = np.full(256, 28, dtype=np.int32)  # marks
    for c in range(26):
        table[ord("a") + c] = table[ord("A") + c] = c
    table[[9, 10, 11, 12, 13, 32]] = 26
    table[48:58] = 27
    table[0:9] = table[14:32] = table[127] = 29
    table[0x80:0xC0] = 32 + (np.arange(64) & 31)
    table[0xC0:0xC4], table[0xC4:] = 30, 31
    return table


CLASSES = _classes()
SPACE = 26


def windows_of(data: bytes) -> np.ndarray:
    """Classes of a text as (windows, 256), the last one filled up with spaces."""
    n = max(1, -(-len(data) // WINDOW))
    out = np.full(n * WINDOW, SPACE, dtype=np.int32)
    out[:len(data)] = CLASSES[np.frombuffer(data, np.uint8)]
    return out.reshape(n, WINDOW)


@dataclass
class Network:
    langs: list[str]
    tables: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    def probabilities(self, win: np.ndarray) -> np.ndarray:
        """(windows, languages), in steps that stay in the cache."""
        parts = []
        for at in range(0, len(win), 1024):
            w = win[at:at + 1024]
            pooled = []
            for width, table in zip(WIDTHS, self.tables):
                idx = np.full(w.shape, len(table) - 1, dtype=np.int32)  # the last row is all zeros
                code = w[:, :WINDOW + 1 - width]
                for k in range(1, width):
                    code = code * 64 + w[:, k:WINDOW + 1 - width + k]
                idx[:, :WINDOW + 1 - width] = code
                g = np.take(table, idx, axis=0)
                while g.shape[1] > 1:
                    half = g.shape[1] // 2
                    g = np.maximum(g[:, :half], g[:, half:])
                pooled.append(g[:, 0])
            z = np.concatenate(pooled, axis=1) @ self.out + self.bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            parts.append(z / z.sum(axis=1, keepdims=True))
        return np.concatenate(parts)


def train(langs: list[str], win: np.ndarray, y: np.ndarray, epochs: int = 8, batch: int = 64, seed: int = 1) -> Network:
    """Adam on the cross entropy; gradients pass the maximum to where it was taken."""
    rng = np.random.default_rng(seed)
    p = {"E": rng.normal(0, 0.5, (64, DIM)), "V": rng.normal(0, 0.3, (FILTERS * len(WIDTHS), len(langs))),
         "c": np.zeros(len(langs))}
    for w in WIDTHS:
        p[f"W{w}"] = rng.normal(0, (2 / (w * DIM)) ** 0.5, (w * DIM, FILTERS))
        p[f"b{w}"] = np.full(FILTERS, 0.1)
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m, v = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(win))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            x, g, pooled, kept = win[rows], {k: np.zeros_like(z) for k, z in p.items()}, [], []
            emb = p["E"][x]
            for w in WIDTHS:
                n = WINDOW + 1 - w
                cols = np.concatenate([emb[:, k:k + n] for k in range(w)], axis=2)
                act = cols.reshape(-1, w * DIM) @ p[f"W{w}"] + p[f"b{w}"]
                act = act.reshape(len(rows), n, FILTERS)
                best = act.argmax(axis=1)
                top = np.take_along_axis(act, best[:, None], axis=1)[:, 0]
                pooled.append(np.maximum(top, 0))
                kept.append((w, best, top > 0, cols))
            feats = np.concatenate(pooled, axis=1)
            z = feats @ p["V"] + p["c"]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            z /= z.sum(axis=1, keepdims=True)
            z[np.arange(len(rows)), y[rows]] -= 1
            z /= len(rows)
            g["V"], g["c"] = feats.T @ z, z.sum(axis=0)
            back = z @ p["V"].T
            for j, (w, best, live, cols) in enumerate(kept):
                d = back[:, j * FILTERS:(j + 1) * FILTERS] * live
                at_best = np.take_along_axis(cols, best[:, :, None], axis=1)
                g[f"W{w}"] = np.einsum("rfc,rf->cf", at_best, d)
                g[f"b{w}"] = d.sum(axis=0)
                into = np.einsum("rf,cf->rfc", d, p[f"W{w}"])
                for k in range(w):
                    np.add.at(g["E"], np.take_along_axis(x, best + k, axis=1), into[:, :, k * DIM:(k + 1) * DIM])
            step += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                p[k] -= (0.01 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    tables = []
    for w in WIDTHS:
        t = np.zeros((1, FILTERS), dtype=np.float32)
        for k in range(w):
            t = (t[:, None] + (p["E"] @ p[f"W{w}"][k * DIM:(k + 1) * DIM])[None]).reshape(-1, FILTERS)
        tables.append(np.concatenate([np.maximum(t + p[f"b{w}"], 0), np.zeros((1, FILTERS))]).astype(np.float32))
    return Network(langs, tables, p["V"], p["c"])


def fit(docs: DataFrame, train_rows: Column, per_lang: int = TRAIN_DOCS, windows: int = TRAIN_WINDOWS) -> Network | None:
    """Network over the languages of the rows for which ``train_rows`` (a condition on
    doc_id) holds.  Of each language the ``per_lang`` smallest hashes of doc_id are
    taken, of ids that one row has, so the bound holds for rows too; and of each such
    text a piece of ``windows`` windows at a hashed place.  Without labelled rows: None."""
    ids = (docs.select("doc_id", "lang").where(F.col("doc_id").isNotNull() & train_rows)
           .groupBy("doc_id").agg(F.count("*").alias("n"), F.min("lang").alias("lang")).where("n = 1 AND lang IS NOT NULL"))
    first = W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    sample = ids.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= per_lang).select("doc_id", "lang")
    size = windows * WINDOW
    start = F.pmod(F.xxhash64("doc_id", F.lit("piece")), F.greatest(F.lit(1), F.char_length("text") - size))
    rows = (docs.select("doc_id", "lang", "text").join(F.broadcast(sample), ["doc_id", "lang"])
            .where(F.col("text").rlike(r"\p{L}"))
            .select("doc_id", "lang", F.col("text").substr((start + 1).cast("int"), F.lit(size)).alias("t"))
            .orderBy("lang", "doc_id", "t").collect())
    langs = sorted({r.lang for r in rows})
    if not langs:
        return None
    win, y = [], []
    for r in rows:
        got = windows_of(r.t.encode())
        win.append(got)
        y += [langs.index(r.lang)] * len(got)
    return train(langs, np.concatenate(win), np.array(y))


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` with lang_pred and lang_score (0 to 1) from the whole text alone.
    Null texts, texts without a letter, and all texts without a network: 'und', 0.
    Input columns of those names are replaced."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(net)
    base = docs.drop("lang_pred", "lang_score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                pred, score = [UNKNOWN] * part.num_rows, [0.0] * part.num_rows
                texts = part.column("text").to_pylist()
                rows = [i for i, t in enumerate(texts) if model and t and any(map(str.isalpha, t))]
                if rows:
                    data = [texts[i].encode() for i in rows]
                    win = [windows_of(d) for d in data]
                    starts = np.cumsum([0] + [len(w) for w in win])
                    weight = np.full(starts[-1], WINDOW, dtype=np.float64)
                    weight[starts[1:] - 1] = [len(d) - WINDOW * (len(w) - 1) for d, w in zip(data, win)]
                    prob = model.probabilities(np.concatenate(win)).astype(np.float64) * weight[:, None]
                    prob = np.add.reduceat(prob, starts[:-1], axis=0) / np.add.reduceat(weight, starts[:-1])[:, None]
                    for i, p in zip(rows, prob):
                        pred[i], score[i] = model.langs[int(p.argmax())], float(min(1.0, p.max()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(pred), pa.array(score, pa.float64())],
                                                 [*part.schema.names, "lang_pred", "lang_score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(run, schema + ", lang_pred string, lang_score double")
