"""Exact quantiles, isolation forest, chunked fills, halo windows and top-k similarity
against direct computation."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from forecourt.operators import forest, quantiles, similar, windows

PROBS = [0.0, 0.25, 0.5, 0.9, 1.0]


def test_quantiles_match_numpy(spark):
    r = random.Random(1)
    rows = [("a", r.gauss(0, 1)) for _ in range(3000)] + [("b", float(r.randint(0, 3))) for _ in range(50)]
    rows += [("c", 10.0 ** r.randint(-300, 300) * r.choice([-1, 1])) for _ in range(40)] + [("d", 5.0), ("e", None), (None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    got = {x.k: x for x in quantiles.quantiles(df, ["k"], "v", PROBS).collect()}
    groups = defaultdict(list)
    for k, v in rows:
        if v is not None:
            groups[k].append(v)
    assert set(got) == set(groups)
    for k, vs in groups.items():
        vs.sort()
        for i, p in enumerate(PROBS):
            at = p * (len(vs) - 1)
            low, high = vs[math.floor(at)], vs[math.ceil(at)]
            want = low if low == high else (math.ceil(at) - at) * low + (at - math.floor(at)) * high
            assert got[k][f"q{i}"] == want
    whole = quantiles.quantiles(df.where("k = 'a'"), [], "v", PROBS).first()
    assert list(whole) == [got["a"][f"q{i}"] for i in range(5)]
    assert list(quantiles.quantiles(df.limit(0), [], "v", [0.5]).first()) == [None]
    assert quantiles.quantiles(df.limit(0), ["k"], "v", [0.5]).count() == 0


def brute_forest(values, key, trees, seed):
    n = len(values)
    limit = math.ceil(math.log2(max(n, 2)))
    c = lambda m: 2 * (math.log(m - 1) + 0.5772156649) - 2 * (m - 1) / m if m > 2 else float(m == 2)
    paths = Counter()

    def grow(vs, tree, node, depth):
        lo, hi = min(vs), max(vs)
        if lo == hi or depth >= limit:
            for v in set(vs):
                paths[v] += math.floor((depth + c(len(vs))) * 1e9 + 0.5)
            return
        h = int(hashlib.md5(f"{seed}|{key}|{tree}|{node}".encode()).hexdigest()[:8], 16)
        cut = lo + (hi - lo) * ((h + 0.5) / 4294967296.0)
        for side in (0, 1):
            if part := [v for v in vs if (v >= cut) == bool(side)]:
                grow(part, tree, 2 * node + side, depth + 1)
    for t in range(1, trees + 1):
        grow(values, t, 1, 0)
    return {v: 2 ** -(p / 1e9 / trees / (c(n) if n > 2 else 1.0)) for v, p in paths.items()}


def test_isolation_forest_grows_on_all_readings(spark):
    r = random.Random(2)
    rows = [(1, float(r.randint(0, 60))) for _ in range(150)] + [(1, 900.0)] + [(2, 4.0), (2, 4.0)] + [(3, 1.0), (3, 9.0)] + [(None, 1.0), (4, None)]
    df = spark.createDataFrame(rows, "k long, v double").repartition(3)
    got = {(x.k, x.v): x.if_score for x in forest.isolation_scores(df, ["k"], "v", trees=12, seed=5).collect()}
    want = {(k, v): s for k in (1, 2, 3) for v, s in brute_forest([v for g, v in rows if g == k], k, 12, 5).items()}
    assert set(got) == set(want) and all(got[x] == pytest.approx(want[x], abs=1e-12) for x in want)
    marked = forest.isolation_outliers(df, ["k"], "v", trees=12, seed=5).collect()
    assert len(marked) == len(rows) - 2 and [x.v for x in marked if x.k == 1 and x.if_outlier][0:] and all(x.if_outlier for x in marked if x.v == 900.0)


@pytest.mark.parametrize("ffill,bfill,zero", [(True, True, True), (True, False, False), (False, True, False), (False, False, True)])
def test_fills_cross_chunks(spark, ffill, bfill, zero):
    r = random.Random(3)
    rows = [(g, t, r.choice([None, None, None, float(t)]), r.choice([None, t])) for g in ("a", "b", None) for t in range(60)] + [("c", 1, None, None)]
    df = spark.createDataFrame(rows, "g string, t int, v double, w int").repartition(4)
    got = {(x.g, x.t): (x.v, x.w) for x in windows.group_fill(df, ["g"], ["t"], ["v", "w"], ffill, bfill, zero, chunk=F.floor(F.col("t") / 7)).collect()}
    for g in ("a", "b", None, "c"):
        mine = sorted((x for x in rows if x[0] == g), key=lambda x: x[1])
        for c in (2, 3):
            for i, x in enumerate(mine):
                want = x[c]
                if want is None and ffill:
                    want = next((y[c] for y in mine[i::-1] if y[c] is not None), None)
                if want is None and bfill:
                    want = next((y[c] for y in mine[i:] if y[c] is not None), None)
                assert got[g, x[1]][c - 2] == (0 if want is None and zero else want)


def test_neighbour_scores_do_not_depend_on_blocks(spark, monkeypatch):
    r = random.Random(4)
    rows = [(k, i, float(r.choice([r.randint(0, 500), r.gauss(200, 5)]))) for k, n in ((1, 260), (2, 3), (3, 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "k int, i int, v double").repartition(3)

    def scores(chunk=None):
        return sorted(map(tuple, windows.outlier_scores_1d(df, ["k"], "v", "i", chunk=chunk).collect()), key=repr)
    whole = scores()
    monkeypatch.setattr(windows, "BLOCK_ROWS", 40)
    assert scores(F.floor(F.col("v") / 50)) == whole and len(whole) == len(rows)


def test_top_k_equals_comparing_all(spark):
    r = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    weight = [1 / (i + 1) for i in range(60)]
    text = lambda: r.choices(words, weight, k=r.randint(1, 9))
    a = [(i, text()) for i in range(60)] + [(100, []), (101, ["nowhere"]), (102, None), (103, ["w0", "w0"])]
    b = [(i, text()) for i in range(300)] + [(400 + i, ["w0"]) for i in range(30)] + [(500, [])]
    fa, fb = (spark.createDataFrame(x, f"{n} long, tokens array<string>").repartition(3) for x, n in ((a, "x"), (b, "y")))
    cos = lambda p, q: sum(n * q[w] for w, n in p.items()) / math.sqrt(sum(n * n for n in p.values()) * sum(n * n for n in q.values()))
    bags = {i: Counter(t) for i, t in b if t}
    for k in (1, 5):
        got = defaultdict(list)
        best, stats = similar.top_k(fa, fb, "x", "y", k)
        for x in best.orderBy("x", "rank").collect():
            got[x.x].append((x.y, x.cosine))
        for i, t in a:
            p = Counter(t or [])
            want = sorted((-round(cos(p, q), 6), y) for y, q in bags.items() if set(p) & set(q))[:k]
            assert got[i] == [(y, pytest.approx(-c, abs=1e-9)) for c, y in want]
        assert stats["compared"] < stats["possible"] / (2 if k == 1 else 1.2)
    pairs = similar.cosine_pairs(fa, fb, "x", "y").collect()
    assert len(pairs) == sum(bool(set(Counter(t or [])) & set(q)) for _, t in a for q in bags.values())
    assert all(x.cosine == pytest.approx(cos(Counter(dict(a)[x.x]), bags[x.y])) for x in pairs[:200]) and np.all([x.cosine > 0 for x in pairs])


def test_forest_paths_do_not_depend_on_where_they_grow(spark, monkeypatch):
    r = random.Random(8)
    rows = [(k, float(r.randint(0, 10 ** k))) for k in (1, 2, 3) for _ in range(120)] + [(9, float("inf")), (9, 1.0), (9, -3.5), (0, 2.0)]
    df = spark.createDataFrame(rows, "k long, v double").repartition(3)
    real, large = forest._large_paths, []
    monkeypatch.setattr(forest, "_large_paths", lambda base, *a: large.append(base.select("k").distinct().count()) or real(base, *a))
    scores = lambda: sorted(tuple(x) for x in forest.isolation_scores(df, ["k"], "v", trees=7, seed=3).collect() if x.k != 9)
    whole = scores()
    monkeypatch.setattr(forest, "IN_TASK", 30)
    assert [(k, v, pytest.approx(s, abs=1e-12)) for k, v, s in whole] == scores() and large == [1, 3]
