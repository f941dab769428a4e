"""Language and toxicity: held-out accuracy on the given tables, exact scans by brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

from forecourt.llm import language, queries, toxicity
from tests.llm.fixtures import documents, frame

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    out = queries.op4_language(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    rows = out.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out and r.lang and r.lang_pred != "und"]
    assert len(held) > 100 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_awkward_texts(spark):
    docs = frame(spark, documents()).withColumn("lang_pred", F.lit(1))
    net = language.fit(docs.withColumn("lang", F.coalesce("lang", F.lit("en"))), F.lit(True), per_lang=20)
    got = {(r.doc_id, r.text): r for r in language.predict(docs, net).collect()}
    assert got[(90, None)].lang_pred == got[(91, "")].lang_pred == got[(92, "  \n\t ")].lang_pred == "und"
    assert language.predict(docs.limit(0), net).count() == 0
    assert language.fit(docs, F.lit(False)) is None
    assert {r.lang_pred for r in language.predict(docs, None).collect()} == {"und"}


def test_windows_cover_the_whole_text():
    text = bytes(range(97, 123)) * 50
    win = language.windows_of(text)
    assert win.shape == (6, 256) and (win.ravel()[:len(text)] == np.tile(np.arange(26), 50)).all()
    assert language.windows_of(b"").shape == (1, 256)


def test_tables_equal_the_convolution():
    rng = np.random.default_rng(0)
    win = rng.integers(0, 64, (40, 256)).astype(np.int32)
    net = language.train(["a", "b"], win, (np.arange(40) % 2), epochs=1)
    p = net.probabilities(win)
    feats = []
    for w, t in zip(language.WIDTHS, net.tables):
        code = sum(win[:, k:257 - w + k].astype(np.int64) * 64 ** (w - 1 - k) for k in range(w))
        feats.append(t[code].max(axis=1))
    z = np.concatenate(feats, axis=1) @ net.out + net.bias
    z = np.exp(z - z.max(axis=1, keepdims=True))
    assert np.allclose(p, z / z.sum(axis=1, keepdims=True), atol=1e-5)


def test_toxicity_held_out(spark):
    out = queries.op7_toxicity(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    rows = [r for r in out.join(labels, "doc_id").collect() if r.held_out]
    tp = sum(r.predicted and r.toxic for r in rows)
    fp = sum(r.predicted and not r.toxic for r in rows)
    assert tp > 0.85 * sum(r.toxic for r in rows) and fp < 0.02 * len(rows)
    assert out.where("score < 0 or score > 1 or score is null").count() == 0


def brute_segments(scores):
    """Maximal segments by their definition: best stretch first, then either side of it."""
    n = len(scores)
    best = None
    for i in range(n):
        total = 0.0
        for j in range(i, n):
            total += scores[j]
            if total > 1e-12 and (best is None or total > best[0] + 1e-12 or abs(total - best[0]) <= 1e-12 and j - i < best[2] - best[1] - 1):
                best = (total, i, j + 1)
    if best is None:
        return []
    s, a, b = best
    return brute_segments(scores[:a]) + [(a, b, s)] + [(x + b, y + b, z) for x, y, z in brute_segments(scores[b:])]


def test_segments_match_definition():
    r = random.Random(4)
    for _ in range(300):
        scores = [r.choice([-0.2, -0.2, -0.2, r.uniform(0.05, 1.1)]) for _ in range(r.randint(0, 25))]
        got = toxicity.maximal_segments([(i, s) for i, s in enumerate(scores) if s > 0])
        assert [(a, b, round(s, 9)) for a, b, s in got] == [(a, b, round(s, 9)) for a, b, s in brute_segments(scores)]


def test_toxicity_without_classes(spark):
    docs = frame(spark, documents()).withColumn("toxicity", F.lit("x"))
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(documents()) and all(r.toxicity < 0.01 and not r.passages for r in out)
    assert toxicity.score(docs.limit(0), model).count() == 0
