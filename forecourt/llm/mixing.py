"""Mixing sources to target weights.

The documents of a source, in an order hashed from the seed, lie one after the other on an
axis of words that is cut into blocks of equal length.  A source whose target is t words
gives exactly floor(t) words: its whole axis as often as t holds it, then blocks in a
keyed permutation, the last one in part, so disjoint blocks within each pass.

How many blocks of each source go to which output shard is drawn by a splitting tree: the
shards are halved again and again, and of the block quotas at a node the left half gets a
multivariate hypergeometric draw, so every shard ends with an exact number of blocks and
every quota is used up.  A shard takes the next blocks of each source's permutation and
shuffles them locally, by a hash of the block.

The driver holds numbers only: a row a source and a quota a source and shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.llm.common import copies, row_key, small_batches, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
#: Words of a block; longer where there would be more blocks than numpy draws from.
BLOCK_WORDS, MOST_BLOCKS = 1024, 2 ** 28
#: Rows whose running sizes one window group should have at most.
GROUP_ROWS = 20_000
SPAN = T.ArrayType(T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("place", T.LongType()),
                                 T.StructField("start", T.LongType()), T.StructField("n", T.LongType())]))


def targets(sizes: list[int], weights: list[float], share: float = 1.5, most: float = 2.0) -> list[float]:
    """Words that each source should give: ``share`` of all sizes by weight; a target stops at
    ``most`` times its source's size, and the excess goes to the others by weight."""
    out, left = [0.0] * len(sizes), share * sum(sizes)
    open_ = set(range(len(sizes)))
    while open_:
        each = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if weights[i] * each > most * sizes[i]}
        if not full:
            for i in open_:
                out[i] = weights[i] * each
            return out
        for i in full:
            out[i] = most * sizes[i]
            left -= out[i]
        open_ -= full
    return out


def _mixed(x: np.ndarray, key: np.ndarray | int) -> np.ndarray:
    """64 well mixed bits of x and a key."""
    with np.errstate(over="ignore"):
        x = np.asarray(x, np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def permuted(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0 to n - 1: a Feistel net over the next even number of bits,
    walked on until it falls below n."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    out = np.asarray(x, np.uint64).copy()
    at = np.arange(len(out))
    while len(at):
        left, right = out[at] >> half, out[at] & mask
        for r in range(4):
            left, right = right, left ^ (_mixed(right, (key + 0x632BE59BD9B4E019 * (r + 1)) & (2 ** 64 - 1)) & mask)
        out[at] = (left << half) | right
        at = at[out[at] >= n]
    return out.astype(np.int64)


@dataclass
class Share:
    """What one source gives: passes over its whole axis, then ``blocks`` permuted blocks and
    ``rest`` words of the next one."""
    size: int
    target: float
    key: int
    block: int
    passes: int = 0
    blocks: int = 0
    rest: int = 0
    ends: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # last block and one of each shard

    def __post_init__(self):
        n, left = self.count, int(self.target)
        if not self.size:
            return
        self.passes, left = divmod(left, self.size)
        short = int(permuted(np.array([n - 1]), n, self.key + self.passes)[0])  # the last block may be shorter
        length = self.size - (n - 1) * self.block
        if left < short * self.block:
            self.blocks, self.rest = divmod(left, self.block)
        elif left < short * self.block + length:
            self.blocks, self.rest = short, left - short * self.block
        else:
            more, self.rest = divmod(left - short * self.block - length, self.block)
            self.blocks = short + 1 + more

    @property
    def count(self) -> int:
        return -(-self.size // self.block)

    @property
    def quota(self) -> int:
        return self.passes * self.count + self.blocks + (self.rest > 0)


def split_quotas(quotas: list[int], shards: int, seed: int) -> np.ndarray:
    """Blocks of each source (columns) in each shard (rows).  Shards get equally many blocks,
    or one more; the sources of a shard are a draw without replacement from what is there."""
    rng = np.random.default_rng(seed)
    total = sum(quotas)
    room = np.full(shards, total // shards, np.int64)
    room[:total % shards] += 1
    out = np.zeros((shards, len(quotas)), np.int64)
    todo = [(0, shards, np.array(quotas, np.int64))]
    while todo:
        a, b, have = todo.pop()
        if b - a == 1:
            out[a] = have
            continue
        mid = (a + b) // 2
        left = rng.multivariate_hypergeometric(have, int(room[a:mid].sum()), method="marginals") if len(have) else have
        todo += [(a, mid, left), (mid, b, have - left)]
    return out


@dataclass
class Plan:
    """Shares by source; the null source has the key None."""
    shares: dict[str | None, Share]
    seed: int


def plan(sizes: DataFrame, shards: int = 8, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0,
         seed: int = 2024, block_words: int = BLOCK_WORDS) -> Plan:
    """Targets, quotas and the shards' parts, from (source, size).  Sources are ordered by code
    point, null last, and take the weights in turn.  A row a source comes to the driver."""
    total = {r["source"]: r["n"] or 0 for r in sizes.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    names = sorted((s for s in total if s is not None)) + ([None] if None in total else [])
    size = [int(total[s]) for s in names]
    goal = targets(size, [weights[i % len(weights)] for i in range(len(names))], share, most)
    block = max(block_words, -(-int(sum(goal)) // MOST_BLOCKS))
    keys = _mixed(np.arange(len(names), dtype=np.uint64), seed).tolist()
    shares = [Share(z, t, k >> 1, block) for z, t, k in zip(size, goal, keys)]
    for s, ends in zip(shares, np.cumsum(split_quotas([s.quota for s in shares], shards, seed), axis=0).T):
        s.ends = ends
    return Plan(dict(zip(names, shares)), seed)


def _taken(shared):
    """Adds the spans of every row that the mix takes: shard, place in the shard's order, first
    word in the document and number of words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        the = shared.value
        for batch in batches:
            source = np.array(batch.column("source").to_pylist(), object)
            first, size = (batch.column(c).to_numpy() for c in ("_at", "size"))
            spans: list[list] = [[] for _ in range(batch.num_rows)]
            for name in set(source.tolist()):
                s = the.shares[name]
                rows = np.flatnonzero((source == name) & (size > 0))
                lo, hi = first[rows] // s.block, (first[rows] + size[rows] - 1) // s.block + 1
                count = hi - lo
                row = np.repeat(rows, count)
                block = np.repeat(lo - np.cumsum(count) + count, count) + np.arange(count.sum())
                begin = np.maximum(block * s.block, first[row])
                end = np.minimum((block + 1) * s.block, first[row] + size[row])
                for p in range(s.passes + (s.blocks + s.rest > 0)):
                    rank = permuted(block, s.count, s.key + p)
                    stop = end
                    if p == s.passes:
                        stop = np.where(rank < s.blocks, end, np.where(rank == s.blocks, np.minimum(end, block * s.block + s.rest), begin))
                    at = p * s.count + rank
                    shard = np.searchsorted(s.ends, at, "right")
                    place = (_mixed(at.astype(np.uint64), s.key ^ the.seed) >> np.uint64(1)).astype(np.int64)
                    for i in np.flatnonzero(stop > begin).tolist():
                        r = int(row[i])
                        spans[r].append({"shard": int(shard[i]), "place": int(place[i]), "start": int(begin[i] - first[r]), "n": int(stop[i] - begin[i])})
            target = [the.shares[x].target for x in source.tolist()]
            total = [the.shares[x].size for x in source.tolist()]
            kind = pa.list_(pa.struct([("shard", pa.int32()), ("place", pa.int64()), ("start", pa.int64()), ("n", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(total, pa.int64()), pa.array(target, pa.float64()), pa.array(spans, kind)],
                                             [*batch.schema.names, "source_size", "target", "spans"])
    return run


def mix(docs: DataFrame, shards: int = 8, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0,
        seed: int = 2024, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, source, row, size, source_size, target, spans) of every row of ``docs``
    (doc_id, text, source); other columns are ignored.

    ``row`` is a hash of id and text.  ``size`` counts the words of the text (null or empty: 0,
    no span).  ``spans`` are the pieces of the document in the mix: shard, place (the order in the
    shard; words of one block share it and follow by document), start and n in words.  A span
    within a pass is disjoint from the others, so a document gives at most ``most`` times its
    words, rounded up to whole passes.  Rows with a null source are a source of their own.
    Rows equal in id, source and text share a place in the order and get a part each.  An
    empty table gives an empty one."""
    spark = docs.sparkSession
    small_batches(spark)
    sized = docs.select("doc_id", "source", row_key().alias("row"),
                        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"))
    rows = written(sized.groupBy("doc_id", "source", "row", "size").agg(F.count("*").alias("copies")), "mix-rows")
    all_words = rows.select("source", (F.col("size") * F.col("copies")).alias("size"))
    the = plan(all_words, shards, weights, share, most, seed, block_words)

    groups = max(32, -(-rows.count() // GROUP_ROWS))
    draw = F.xxhash64(F.lit(seed), "doc_id", "source", "row")
    dealt = rows.withColumn("_draw", draw).withColumn("_group", F.pmod(F.xxhash64(F.lit("group"), "_draw"), F.lit(groups)))
    words = F.col("size") * F.col("copies")
    starts = dealt.groupBy(F.col("source").alias("_source"), F.col("_group").alias("_of")).agg(F.sum(words).alias("_words"))
    before = W.partitionBy("_source").orderBy("_of").rowsBetween(W.unboundedPreceding, -1)
    starts = starts.withColumn("_start", F.coalesce(F.sum("_words").over(before), F.lit(0))).drop("_words")
    inside = W.partitionBy("source", "_group").orderBy("_draw", "doc_id", "row").rowsBetween(W.unboundedPreceding, -1)
    placed = (dealt.withColumn("_inside", F.coalesce(F.sum(words).over(inside), F.lit(0)))
              .join(starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_group") == F.col("_of")))
              .withColumn("_first", F.col("_start") + F.col("_inside"))
              .select("doc_id", "source", "row", "size", "copies", "_first"))
    single = copies(placed, "copies", "_copy").select("doc_id", "source", "row", "size",
                                                      (F.col("_first") + F.col("_copy") * F.col("size")).alias("_at"))
    fields = [f for f in single.schema.fields if f.name != "_at"]
    out = T.StructType([*single.schema.fields, T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType()),
                        T.StructField("spans", SPAN)])
    return (single.mapInArrow(_taken(spark.sparkContext.broadcast(the)), out)  # numbers of sources and shards only
            .select(*[f.name for f in fields], "source_size", "target", "spans"))


def shard_texts(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """(shard, place, doc_id, start, text): the mix itself, ordered within each partition, all
    of a shard's rows of one place together.  ``text`` is the span's words, joined by a space."""
    texts = docs.select(row_key().alias("row"), "text").dropDuplicates(["row"])
    spans = mixed.select("doc_id", "row", F.explode("spans").alias("s")).select("doc_id", "row", "s.*")
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))
    return (spans.join(texts, "row").withColumn("text", F.array_join(F.slice(words, (F.col("start") + 1).cast("int"), F.col("n").cast("int")), " "))
            .select("shard", "place", "doc_id", "start", "text")
            .repartitionByRange("shard", "place").sortWithinPartitions("shard", "place", "doc_id", "start"))
