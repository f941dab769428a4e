"""SimHash near-dedup against all pairs."""

import xxhash
from pyspark.sql import functions as F

from forecourt.llm import simhash
from tests.llm.fixtures import documents, frame


def brute_fingerprint(text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(fps, radius=2):
    """Smallest id reachable per fingerprint, over all pairs of fingerprints."""
    todo, group = set(fps), {}
    while todo:
        reach, edge = set(), [todo.pop()]
        while edge:
            x = edge.pop()
            reach.add(x)
            near = {y for y in todo if (x ^ y).bit_count() <= radius}
            todo -= near
            edge += near
        for x in reach:
            group[x] = frozenset(reach)
    return group


def _check(spark, rows, tile):
    got = simhash.near_duplicates(frame(spark, rows), tile=tile).collect()
    fps = {}
    for d, t, *_ in rows:
        fps.setdefault(brute_fingerprint(t), []).append(-(2 ** 63) if d is None else d)
    group = brute_groups(fps)
    want = sorted((repr(d), f"{brute_fingerprint(t):016x}",
                   repr(None if (m := min(i for f in group[brute_fingerprint(t)] for i in fps[f])) == -(2 ** 63) else m))
                  for d, t, *_ in rows)
    assert sorted((repr(r.doc_id), f"{r.fp & (2**64 - 1):016x}", repr(r.component_id)) for r in got) == want


def test_components_match_brute_force(spark):
    _check(spark, documents(), 8192)


def test_split_buckets_lose_no_link(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = documents() + [(500 + i, base.replace("w%d " % i, "v "), "en", "s", 1) for i in range(150)]
    _check(spark, rows, 16)


def test_tiles_find_every_link():
    import numpy as np
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2 ** 63, 700, dtype=np.uint64)
    a[300:600] = a[:300] ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64))
    x, y = simhash._close(a, a, 2, True)
    d = np.bitwise_count(a[:, None] ^ a[None])
    want = {(i, j) for i, j in zip(*np.nonzero(d <= 2)) if i < j}
    assert {(int(min(p)), int(max(p))) for p in zip(x, y)} == want


def test_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}


def test_dedup_keeps_one_of_each_group(spark):
    docs = frame(spark, [(i, "same text here" if i % 2 else f"text number {i} of its own kind", "en", "s", i)
                         for i in range(1, 21)]).withColumn("fp", F.lit(1))
    out = simhash.dedup(docs)
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} >= {1} and out.where("text = 'same text here'").count() == 1
    assert simhash.dedup(docs.limit(0)).count() == 0
