"""Line dedup and sharding against brute force."""

import re
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from forecourt.llm import line_dedup, sharding
from tests.llm.fixtures import documents, frame

MIN = -(2 ** 63)


def _key(line):
    return re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate(
        {c: c + 32 for c in range(65, 91)})


def brute_lines(rows, min_chars=40, min_docs=5):
    holders = defaultdict(set)
    for doc, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(k := _key(line)) >= min_chars:
                holders[k].add(MIN if doc is None else doc)
    out = []
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        keep = [x for x in lines if len(holders.get(_key(x), ())) < min_docs
                or max(holders[_key(x)]) == (MIN if doc is None else doc)]
        out.append((doc, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return out


def _sorted(rows):
    return sorted(rows, key=repr)


def test_lines_match_brute_force(spark):
    rows = documents()
    got = line_dedup.dedup_lines(frame(spark, rows)).select("doc_id", "n_lines", "n_dropped", "text").collect()
    want = brute_lines(rows)
    assert _sorted(tuple(r) for r in got) == _sorted(want)
    assert any(r[2] for r in want)


def test_lines_empty_table_and_clashing_columns(spark):
    empty = frame(spark, documents()).limit(0)
    assert line_dedup.dedup_lines(empty).count() == 0
    odd = frame(spark, documents()).withColumn("n_lines", F.lit("x")).withColumn("_row", F.lit(1))
    out = line_dedup.dedup_lines(odd)
    assert out.count() == len(documents()) and dict(out.dtypes)["n_lines"] == "bigint"


def test_shards_law_and_slots(spark):
    rows = documents() + [(1000 + i, "t" * (i % 9), "en", "s", 1) for i in range(4000)]
    out = sharding.shard_documents(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    by_doc = defaultdict(set)
    slots = defaultdict(list)
    for r in out:
        by_doc[r.doc_id].add((r.shard, r.grown_shard))
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 8)
    assert all(len(v) == 1 for v in by_doc.values())
    assert sorted(slots) == list(range(8))
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
        assert abs(len(s) - len(rows) / 8) < 120
    moved = sum(r.grown_shard == 8 for r in out)
    assert abs(moved - len(rows) / 9) < 120
    want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, *_ in rows)
    assert sorted((r["size"], r.text_crc32) for r in out) == want
    assert sharding.shard_documents(frame(spark, rows).limit(0)).count() == 0


def test_weights_confine_movement(spark):
    tree = [("a", [("k", [(0, 1.0), (1, 2.0)]), ("l", [(2, 1.0)])]), ("b", [("k", [(3, 4.0)])])]
    heavier = [tree[0], ("b", [("k", [(3, 8.0)])])]
    ids = spark.range(8000).withColumnRenamed("id", "doc_id")
    both = sharding.with_shard(sharding.with_shard(ids, "doc_id", tree, "x"), "doc_id", heavier, "y").collect()
    assert all(r.x == r.y or r.y == 3 for r in both)
    share = sum(r.x == 1 for r in both) / len(both)
    assert abs(share - 2 / 8) < 0.03

