"""SimHash near-dedup by tiled exact comparison of fingerprints.

Fingerprints are computed in Arrow batches and collapsed to the distinct ones.  Two
that differ in at most r bits agree on one of r + 1 bit blocks, so only fingerprints
of one bucket (block, value) are compared.  A bucket is sorted by population count
and cut into tiles; tile pairs whose counts differ by more than r are skipped, the
rest is an exclusive or and a bit count in numpy.  A bucket beyond ``TILE`` is dealt
out as tile pairs, so no task holds it whole.  Links leave a task as a spanning
forest; components grow by alternating large-star and small-star steps in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import (NULL_ID, aside, ordered_id, restored, row_key, shuffle_width, slices, small_batches, texts,
                                  written)

TILE = 8192
SEED = 42


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of one UTF-8 text: A-Z lower-cased, words split at ASCII white space."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(line, SEED)], dtype=np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest, view = xxhash.xxh64_intdigest, memoryview(line)
        n = len(words) - shingle + 1
        hashes = np.fromiter((digest(view[a:b], SEED) for a, b in
                              zip(starts[:n].tolist(), ends[shingle - 1:].tolist())), np.uint64, n)
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at:at + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, row, fp): row is a hash of id and text, fp the 64-bit pattern as a signed
    long.  Null or empty text: 0."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                fp = np.array([fingerprint(t, shingle) for t in texts(part, "text")], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("row"), pa.array(fp.view(np.int64))], ["doc_id", "row", "fp"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row"), "text")
            .mapInArrow(run, "doc_id long, row long, fp long"))


def _close(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two fingerprint arrays at most ``radius`` bits apart, by tiles
    sorted by population count.  same: a is b, each pair once."""
    found = []
    oa, ob = np.argsort(np.bitwise_count(a), kind="stable"), np.argsort(np.bitwise_count(b), kind="stable")
    sa, sb = a[oa], b[ob]
    ca, cb = np.bitwise_count(sa).astype(np.int16), np.bitwise_count(sb).astype(np.int16)
    step = 256
    for i in range(0, len(sa), step):
        top = min(i + step, len(sa)) - 1
        lo = np.searchsorted(cb, ca[i] - radius, "left")
        hi = np.searchsorted(cb, ca[top] + radius, "right")
        for j in range(lo, hi, 4096):
            near = np.bitwise_count(sa[i:top + 1, None] ^ sb[None, j:min(j + 4096, hi)]) <= radius
            x, y = np.nonzero(near)
            x, y = oa[x + i], ob[y + j]
            if same:
                x, y = x[x < y], y[x < y]
            found.append((x, y))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _forest(links: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of a union-find over the links: as connected, at most one a node."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        for x, y in zip(a.tolist(), b.tolist()):
            x, y = root(x), root(y)
            if x != y:
                up[max(x, y)] = min(x, y)
    pairs = [(x, r) for x in up if (r := root(x)) != x]
    return np.array([p[0] for p in pairs], np.uint64), np.array([p[1] for p in pairs], np.uint64)


def _compare(radius: int):
    """Over rows (grp, fp, side) sorted by all three: side 0 is a bucket taken whole,
    sides 1 and 2 are the two tiles of a pair."""

    def take(group: np.ndarray, fp: np.ndarray, side: np.ndarray, links: list) -> None:
        cut = np.flatnonzero(group[1:] != group[:-1]) + 1
        starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [len(group)]))
        short = ends - starts <= 32
        # Short groups all at once: each row against the d-th row after it.
        last = np.repeat(np.where(short, ends, starts), ends - starts)
        for d in range(1, int((ends - starts)[short].max(initial=1))):
            i = np.flatnonzero((side[:-d] == 0) & (np.arange(len(group) - d) + d < last[:-d]))
            i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= radius]
            links.append((fp[i], fp[i + d]))
        for s, e in zip(starts, ends):
            f, k = fp[s:e], side[s:e]
            if e - s > 32:
                x, y = _close(f[k == 0], f[k == 0], radius, True)
                links.append((f[k == 0][x], f[k == 0][y]))
            if k[-1] != 0:
                x, y = _close(f[k == 1], f[k == 2], radius, False)
                links.append((f[k == 1][x], f[k == 2][y]))
            if sum(len(x[0]) for x in links[-64:]) > 200_000:
                links[:] = [_forest(links)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        links: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            grp, fp, side = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            held.append((grp, fp.view(np.uint64), side))
            if held[0][0][0] == grp[-1]:
                continue  # one group so far
            grp, fp, side = (np.concatenate(x) for x in zip(*held))
            end = len(grp) - int(np.argmax(grp[::-1] != grp[-1]))
            take(grp[:end], fp[:end], side[:end], links)
            links[:] = [_forest(links)]
            held = [(grp[end:], fp[end:], side[end:])]
        if held:
            take(*(np.concatenate(x) for x in zip(*held)), links)
        a, b = _forest(links)
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return run


def links(nodes: DataFrame, radius: int = 2, tile: int = TILE) -> DataFrame:
    """(a, b) between the distinct fingerprints ``nodes`` (fp long), as connected as all
    pairs within ``radius`` bits."""
    blocks = radius + 1
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    keys = []
    for i in range(blocks):
        width = edges[i + 1] - edges[i]
        value = F.shiftrightunsigned(F.col("fp"), edges[i]).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))
        keys.append(F.struct(F.lit(i).alias("block"), value.cast("long").alias("value")))
    banded = (nodes.withColumn("_k", F.explode(F.array(*keys)))
              .select("fp", F.col("_k.block").alias("block"), F.col("_k.value").alias("value")))
    counts = banded.groupBy("block", "value").agg(F.count("*").alias("n")).where("n > 1")
    met = banded.join(counts, ["block", "value"])
    group = F.xxhash64("block", "value")
    small = met.where(F.col("n") <= tile).select(group.alias("grp"), "fp", F.lit(0).alias("side"))
    large = (met.where(F.col("n") > tile)
             .withColumn("k", F.ceil(F.col("n") / tile).cast("int"))
             .withColumn("c", F.bit_count("fp").cast("int"))
             .withColumn("s", F.pmod(F.xxhash64("fp"), F.col("k")).cast("int")))
    others = F.explode(F.expr(f"flatten(transform(sequence(c - {radius}, c + {radius}), "
                              "x -> transform(sequence(0, k - 1), y -> struct(x AS c2, y AS s2))))"))
    dealt = large.withColumn("_o", others).select("*", "_o.c2", "_o.s2")
    own = F.expr("c2 = c AND s2 = s")
    first = F.expr("c < c2 OR (c = c2 AND s < s2)")
    lo = F.when(first, F.struct("c", "s")).otherwise(F.struct(F.col("c2").alias("c"), F.col("s2").alias("s")))
    hi = F.when(first, F.struct(F.col("c2").alias("c"), F.col("s2").alias("s"))).otherwise(F.struct("c", "s"))
    tiles = dealt.select(F.xxhash64("block", "value", lo, hi).alias("grp"), "fp",
                         F.when(own, 0).when(first, 1).otherwise(2).alias("side"))
    both = small.unionByName(tiles)
    width = shuffle_width(nodes.sparkSession)
    return (both.repartition(width, "grp").sortWithinPartitions("grp", "side")
            .mapInArrow(_compare(radius), "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node reachable; nodes without an edge and
    roots are left out.  Alternating large-star and small-star steps until nothing
    moves; each step is stored, so a lost executor costs one step."""
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = written(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                        .unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == before or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def labelled(docs: DataFrame, shingle: int = 3, radius: int = 2, tile: int = TILE) -> DataFrame:
    """(doc_id, row, fp, group, component_id) of every row: ``group`` is a fingerprint that
    stands for the component."""
    fps = written(fingerprints(docs, shingle), "fingerprints").withColumn("_id", ordered_id())
    nodes = written(fps.groupBy("fp").agg(F.min("_id").alias("_id")), "nodes")
    roots = components(links(nodes.select("fp"), radius, tile)).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").withColumn("group", F.coalesce("root", "fp")).drop("root")
    smallest = rooted.groupBy("group").agg(F.min("_id").alias("_c"))
    labels = rooted.join(smallest, "group").select("fp", "group", "_c")
    return (fps.join(labels, "fp")
            .select("doc_id", "row", "fp", "group", F.when(F.col("_c") != NULL_ID, F.col("_c")).alias("component_id")))


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, tile: int = TILE) -> DataFrame:
    """(doc_id, fp, component_id) of every row of (doc_id, text): component_id is the
    smallest doc_id reachable over fingerprints at most ``radius`` bits apart.

    Null or empty text has fingerprint 0, linked like any other.  A null doc_id counts
    as the smallest id.  Rows that repeat a doc_id keep their own fingerprint and
    component.  Other columns are ignored; an empty table gives no rows."""
    return labelled(docs, shingle, radius, tile).select("doc_id", "fp", "component_id")


def hex_fingerprint(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def dedup(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row of ``docs`` of each component: the one with the smallest doc_id, then the
    smallest fingerprint, then the smallest hash of its text.

    A null doc_id is the smallest; null and empty texts are one component with all texts
    near fingerprint 0.  Rows that repeat a doc_id are judged by their texts; of rows equal
    in id and text one stays.  All columns are kept, an empty table gives no rows."""
    first = labelled(docs, shingle, radius).groupBy("group").agg(F.min(F.struct(ordered_id().alias("i"), "fp", "row")).alias("r"))
    kept = first.select(F.col("r.i").alias("_id"), F.col("r.row").alias("_row"))
    plain, own = aside(docs, "_id", "_row")
    keyed = plain.withColumns({"_id": ordered_id(), "_row": row_key()})
    one = keyed.join(kept, ["_id", "_row"], "left_semi").dropDuplicates(["_id", "_row"]).drop("_id", "_row")
    return restored(one, own, docs.columns)
