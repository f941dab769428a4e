"""Whitening, mixing and resampling against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from forecourt.llm import mixing, resample, whitening
from tests.llm.fixtures import DOCS, documents, frame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# Resampling

def grams(text, longest):
    w = WORD.findall(lower(text or ""))
    return len(w), [" ".join(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def brute_draw(rows, target, longest=1, buckets=10_000, percent=10, min_words=20):
    of = lambda f: zlib.crc32(f.encode()) % buckets
    have = Counter(of(f) for _, t, *_ in rows for f in grams(t, longest)[1])
    want = Counter(of(f) for t in target for f in grams(t, longest)[1])
    s, t = sum(have.values()), sum(want.values())
    gain = {b: math.floor(1000 * math.log((want[b] + 1) * (s + buckets) / ((have[b] + 1) * (t + buckets)))) for b in have}
    out = []
    for doc, text, *_ in rows:
        n, fs = grams(text, longest)
        weight = sum(gain[of(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], -2 ** 63 if r[0] is None else r[0], r[1:4]))
    for i, r in enumerate(able[:len(able) * percent // 100]):
        r[5] = i + 1
    return out


def plain(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("longest,percent,buckets", [(1, 10, 10_000), (2, 35, 97), (3, 100, 10_000), (1, 0, 11)])
def test_resampling_matches_brute_force(spark, longest, percent, buckets):
    rows = documents()
    rows += [rows[5]] * 40 + [(7777, rows[5][1], "en", "s", 1)] * 3  # one row many times: ties at the cutoff
    target = [rows[1][1], None, "", rows[2][1] + " ABC abc"]
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    docs = frame(spark, rows)
    scored = resample.score(docs, resample.gains(docs, goal, longest, buckets), longest)
    got = resample.draw(scored, percent).select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()
    want = brute_draw(rows, target, longest, buckets, percent)
    assert plain(got) == plain(want)
    texts = resample.resample(docs, goal, percent, 20, longest, buckets)
    assert set(DOCS.names) < set(texts.columns)
    assert plain(texts.select("doc_id", "n_words", "score").collect()) == plain((r[0], r[1], r[4]) for r in want if r[5])


def test_cutoff_is_the_exact_key(spark):
    r = np.random.default_rng(3)
    rows = [tuple(int(x) for x in r.integers(-3, 3, 6)) for _ in range(700)]
    count = Counter(rows)
    keys = spark.createDataFrame([(*k, n) for k, n in count.items()], ", ".join(f"{k} long" for k in (*resample.KEYS, "copies"))).repartition(5)
    flat = sorted(rows)
    for n in (1, 2, 350, 699, 700):
        key, room = resample.cutoff(keys, n)
        assert key == flat[n - 1] and room == n - flat.index(key)


def test_words_across_pieces(monkeypatch):
    text = "ab Cd\n9é日x, " * 40 + "z" * 200 + " end"
    for piece in (3, 64, 1 << 20):
        monkeypatch.setattr(resample, "PIECE", piece)
        got = [(k, int(c)) for k, _, cs in resample.features([text.encode(), b"", b"tail"], 3) for c in cs]
        want = [(f.count(" ") + 1, zlib.crc32(f.encode())) for f in grams(text, 3)[1]] + [(1, zlib.crc32(b"tail"))]
        assert sorted(got) == sorted(want)


def test_resampling_empty_and_clashing(spark):
    none = frame(spark, documents()).limit(0)
    goal = spark.createDataFrame([("a b",)], "text string")
    assert resample.draw(resample.score(none, resample.gains(none, goal))).count() == 0
    assert resample.resample(none, goal).count() == 0
    odd = frame(spark, documents()).withColumn("weight", F.lit("x")).withColumn("score", F.lit(None).cast("string"))
    out = resample.score(odd, resample.gains(odd, goal.limit(0)))
    assert dict(out.dtypes)["score"] == "bigint" and out.count() == len(documents())


# Mixing

def taken(df):
    return df.withColumn("taken", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["n"]))


def test_targets_stop_at_twice_the_size():
    assert mixing.targets([10, 100, 100], [5, 2, 1]) == [20.0, pytest.approx(295 * 2 / 3), pytest.approx(295 / 3)]
    assert mixing.targets([0, 0], [5, 2]) == [0.0, 0.0] and mixing.targets([], []) == []
    assert mixing.targets([7], [1]) == [10.5]


def test_mix_meets_targets_and_shards_are_exact(spark):
    rows = [(d, t, lang, None if i % 7 == 3 else s, n) for i, (d, t, lang, s, n) in enumerate(documents())]
    rows += [rows[5]] * 30 + [(None, None, None, "empty", None)]
    docs = frame(spark, rows)
    out = taken(mixing.mix(docs, shards=3, block_words=16)).cache()
    got = out.collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert plain((r.doc_id, r.source, r.size) for r in got) == plain((d, s, size(t)) for d, t, _, s, _ in rows)
    total = defaultdict(int)
    for _, t, _, s, _ in rows:
        total[s] += size(t)
    names = sorted(s for s in total if s is not None) + [None]
    goal = dict(zip(names, mixing.targets([total[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))])))
    for s in names:
        mine = [r for r in got if r.source == s]
        assert sum(r.taken for r in mine) == int(goal[s])
        assert all(r.source_size == total[s] and r.target == pytest.approx(goal[s]) for r in mine)
    assert all(r.taken <= 2 * r["size"] for r in got)
    blocks = defaultdict(set)
    for r in got:
        for s in r.spans:
            assert 0 <= s["start"] and s["start"] + s["n"] <= r["size"] and s["n"] > 0
            blocks[s["shard"]].add((r.source, s["place"]))
    counts = [len(b) for b in blocks.values()]
    assert sorted(blocks) == [0, 1, 2] and max(counts) - min(counts) <= 1
    again = taken(mixing.mix(docs.repartition(3), shards=3, block_words=16)).collect()
    assert plain((r.doc_id, r.row, r.taken) for r in got) == plain((r.doc_id, r.row, r.taken) for r in again)
    texts = mixing.shard_texts(docs, out).collect()
    assert sum(size(r.text) for r in texts) == sum(r.taken for r in got)


def test_permutation_and_quotas():
    for n in (1, 2, 3, 17, 1000):
        assert sorted(mixing.permuted(np.arange(n), n, 99).tolist()) == list(range(n))
    q = mixing.split_quotas([5, 0, 31, 4], 7, 1)
    assert q.sum(axis=0).tolist() == [5, 0, 31, 4] and set(q.sum(axis=1).tolist()) == {5, 6}
    for z in range(1, 90):  # exact words, wherever the short block falls
        for t in (0, z // 3, z - 1, z, z + z // 2, 2 * z):
            s = mixing.Share(z, float(t), 5, 8)
            rank = mixing.permuted(np.arange(s.count), s.count, s.key + s.passes)
            length = [min(8, z - 8 * b) for b in range(s.count)]
            assert s.passes * z + sum(n for n, r in zip(length, rank) if r < s.blocks) + s.rest == t


def test_mix_of_nothing(spark):
    assert mixing.mix(frame(spark, documents()).limit(0)).count() == 0
    only = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert [len(r.spans) for r in mixing.mix(only).collect()] == [0, 0]


# Whitening

VECTORS = "vec_id long, embedding array<float>, n string"


def test_leading_pairs_of_awkward_matrices():
    r = np.random.default_rng(0)
    for n in (1, 2, 3, 20, 64):
        for e in (np.sort(r.random(n))[::-1], np.ones(n), np.r_[np.full(n // 2, 3.0), np.full(n - n // 2, 1e-3)], np.geomspace(1e6, 1e-9, n)):
            q, _ = np.linalg.qr(r.standard_normal((n, n)))
            v = (q * e) @ q.T
            v = (v + v.T) / 2
            values, vectors = whitening.leading(v, 32)
            k = len(values)
            assert k == min(32, n) and np.abs(values - np.linalg.eigvalsh(v)[::-1][:k]).max() < 1e-12 * e[0]
            assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12 and np.abs(v @ vectors - vectors * values).max() < 1e-12 * e[0]
            shifts = np.r_[values + 1e-9 * e[0], values - 1e-9 * e[0]]
            assert whitening.counter(v)(shifts).tolist() == [(np.linalg.eigvalsh(v) > s).sum() for s in shifts]


def test_whitening_matches_direct_sums(spark):
    r = np.random.default_rng(1)
    good = [(i, [float(x) for x in row], "x") for i, row in enumerate((r.standard_normal((200, 6)) * [9, 5, 3, 2, 1, 0] + 40).astype("float32"))]
    good += [good[3]] * 70 + [(None, good[4][1], None)]
    bad = [(900, None, None), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0], None), (902, [float("nan")] * 6, None), (903, [float("inf")] * 6, None), (904, [], None)]
    vectors = spark.createDataFrame(good + bad, VECTORS).repartition(4)
    got = whitening.components_of(vectors).collect()
    x = np.floor(64 * np.array([v for _, v, _ in good], np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    y = (x * n - s) / n
    cov = y.T @ y / n
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1][:5], vecs[:, ::-1][:, :5]  # the last dimension never varies
    assert len(got) == 5 * n
    deviation = Counter((g[0], int(d)) for g, d in zip(good, ((n * x - s) ** 2).sum(axis=1)))
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == deviation
    want = {g[0]: w for g, w in zip(good, (y @ vecs) / np.sqrt(values))}
    sign = {c: np.sign(next(r.whitened for r in got if r.component == c and r.vec_id == 0) * want[0][c - 1]) for c in range(1, 6)}
    for g in got:
        assert abs(g.whitened * sign[g.component] - want[g.vec_id][g.component - 1]) < 1e-8
        assert abs(g.explained - values[g.component - 1] / np.trace(cov)) < 1e-12 and g.n == n and g.identity_error < 1e-9


def test_whitening_awkward_tables(spark):
    assert whitening.components_of(spark.createDataFrame([], VECTORS)).count() == 0
    assert whitening.components_of(spark.createDataFrame([(1, [1.0, 2.0], "a")], VECTORS)).count() == 0
    mixed = [(i, [float(i), float(i * i % 7)], "a") for i in range(9)] + [(i, [float(i % 3), 1.0, float(i)], "b") for i in range(8)]
    wide = [(50, [3.0e38, -3.0e38], "c")]
    out, fits, errors = whitening.whiten(spark.createDataFrame(mixed + wide, VECTORS))
    rows = out.collect()
    assert len(rows) == 18 and sorted(fits) == [2, 3] and {r.n for r in rows} == {10, 8}
    n = 10
    x = [[int(max(-2 ** 50, min(2 ** 50, math.floor(64 * c)))) + 1_000_000 for c in v] for _, v, _ in mixed[:9] + wide]
    sums = [sum(c) for c in zip(*x)]
    exact = sorted(sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x)
    assert sorted(int(r.deviation_exact) for r in rows if r.n == 10) == exact
    assert all(r.deviation is None for r in rows if r.n == 10)
