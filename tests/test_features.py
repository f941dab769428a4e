"""Learned text projection and feature pipelines."""

import numpy as np
from pyspark.sql import functions as F

from forecourt.operators import features

WORDS = [f"word{i}" for i in range(40)]


def texts(n, seed):
    r = np.random.default_rng(seed)
    p = 1.0 / np.arange(1, 41) ** 1.2
    return [" ".join(r.choice(WORDS, size=int(r.integers(0, 30)), p=p / p.sum())) for _ in range(n)]


def dense(spark, rows, buckets):
    a = np.zeros((len(rows), buckets))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, text string")
    for r in df.select("i", features.hashed_tokens(F.col("text"), buckets).alias("b")).collect():
        for b in r.b:
            a[r.i, abs(b) - 1] += np.sign(b)
    norm = np.linalg.norm(a, axis=1, keepdims=True)
    return a / np.where(norm > 0, norm, 1.0)


def test_projection_equals_dense_svd(spark):
    rows, later = texts(300, 1), texts(40, 2) + ["", "unseen tokens only here"]
    train = spark.createDataFrame([(i, t) for i, t in enumerate(rows)] + [(999, None)], "i int, text string").repartition(5)
    model = features.fit_text(train, "text", components=6, buckets=257, passes=30)
    a = dense(spark, rows, 257)
    _, s, vt = np.linalg.svd(a, full_matrices=False)
    assert np.abs(model.singular - s[:6]).max() < 1e-8
    v = vt[:6].T * np.sign((vt[:6].T * model.vectors).sum(axis=0))
    assert np.abs(v - model.vectors).max() < 1e-5
    test = spark.createDataFrame([(i, t) for i, t in enumerate(later)], "i int, text string").repartition(3)
    got = {r.i: r.c for r in model.transform(test, "c").collect()}
    want = dense(spark, later, 257) @ model.vectors
    assert all(np.abs(np.array(got[i]) - want[i]).max() < 1e-9 for i in range(len(later)))


def test_pipeline_drops_constants_and_round_trips(spark, tmp_path):
    rows = [(i, float(i % 5), 3.0, "ab"[i % 2], t) for i, t in enumerate(texts(60, 3))]
    train = spark.createDataFrame(rows, "i int, x double, same double, kind string, text string")
    fitted = features.FeaturePipeline({"x": "standard", "same": "minmax"}, ["kind"], ["text"], buckets=512, components=4).fit(train)
    assert fitted.names == ["x", "kind_a", "kind_b"] + [f"text:text:{i}" for i in range(4)]
    new = spark.createDataFrame([(1, None, 9.0, "new", None), (2, 2.0, None, "a", "word1 word2")], train.schema)
    fitted.save(spark, str(tmp_path / "f"))
    again = features.FittedFeatures.load(spark, str(tmp_path / "f"))
    one, two = (sorted((r.i, r.features.toArray().tolist()) for r in f.transform(new).collect()) for f in (fitted, again))
    assert one == two and again.names == fitted.names
    assert one[0][1] == [0.0] * 7 and one[1][1][:3] == [0.0, 1.0, 0.0]


def test_projection_of_nothing(spark):
    none = spark.createDataFrame([], "i int, text string")
    model = features.fit_text(none, "text", components=3, buckets=64)
    assert model.vectors.shape == (64, 0) and model.transform(none, "c").count() == 0


def test_long_texts_are_multiplied_in_pieces(monkeypatch):
    import tracemalloc

    import pyarrow as pa
    r = np.random.default_rng(4)
    batch = pa.RecordBatch.from_arrays([pa.array([(r.integers(1, 1001, 400) * r.choice([-1, 1], 400)).tolist() for _ in range(2000)], pa.list_(pa.int32()))], ["tokens"])

    class Shared:
        value = np.arange(1000), np.linalg.qr(r.standard_normal((1000, 60)))[0]
    tracemalloc.start()
    one = list(features._normal_product(Shared, "tokens")([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6  # all 800,000 entries at once: 380 MB for each product
    monkeypatch.setattr(features, "ENTRIES", 1 << 40)
    whole = list(features._normal_product(Shared, "tokens")([batch]))
    a, b = (np.column_stack([x.column(i).to_numpy() for i in range(61)]) for x in (one[0], whole[0]))
    assert np.abs(a - b).max() < 1e-9


def test_only_met_buckets_are_broadcast(spark, monkeypatch):
    sizes = []
    real = features._pass
    monkeypatch.setattr(features, "_pass", lambda rows, column, met, w: sizes.append(w.shape) or real(rows, column, met, w))
    train = spark.createDataFrame([(t,) for t in texts(50, 6)], "text string")
    model = features.fit_text(train, "text", components=50)
    assert max(n for n, _ in sizes) <= 40 and model.vectors.shape[0] == features.BUCKETS and len(model.singular) <= 40


def test_a_product_holds_one_text_of_the_matrix_at_a_time():
    import tracemalloc

    import pyarrow as pa
    r = np.random.default_rng(5)
    tokens = [(r.integers(1, 1001, n) * r.choice([-1, 1], n)).tolist() for n in [300] * 300 + [0, 1, 2]]
    batch = pa.RecordBatch.from_arrays([pa.array(tokens, pa.list_(pa.int32()))], ["tokens"])

    class Shared:
        value = np.arange(1000), np.linalg.qr(r.standard_normal((1000, 60)))[0]
    tracemalloc.start()
    got = list(features._normal_product(Shared, "tokens")([batch]))[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6  # all entries of a slice at once: 60 MB and more
    a = np.zeros((len(tokens), 1000))
    for i, t in enumerate(tokens):
        np.add.at(a[i], np.abs(np.array(t, int)) - 1, np.sign(t))
    a /= np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-300)
    want = a.T @ (a @ Shared.value[1])
    assert np.abs(np.column_stack([got.column(i + 1).to_numpy() for i in range(60)]) - want[got.column(0).to_numpy()]).max() < 1e-12


def test_blocks_of_rows_give_an_orthonormal_basis_of_the_span():
    w = np.random.default_rng(7).standard_normal((20_000, 6))
    q = features._orthonormal(w.copy())
    assert np.abs(q.T @ q - np.eye(6)).max() < 1e-12 and np.abs(q @ (q.T @ w) - w).max() < 1e-9
