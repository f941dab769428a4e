"""Importance resampling towards a target distribution.

A feature is a run of words; features are hashed into buckets, and a bucket's gain is the
log ratio of its share in the target texts and its share in the documents.  The gains are
one array of fixed size: a document's weight is the floored mean of the gains of its
features.  The weight plus Gumbel noise hashed from the id is the score, and the highest
scores are drawn.

The cutoff is found by weighted median of medians: every task names the median of the keys
that remain in it, weighted by how many they are; the weighted median of those is the next
pivot, and each round a guaranteed fraction of the keys falls away, until the pivot is the
exact cutoff key.  Only the winners are sorted.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.llm.common import copies, ordered_id, shuffle_width, slices, small_batches, texts, written

#: Bytes that part words become spaces, A-Z become a-z; bytes from 0x80 on belong to words.
FOLD = bytes(c if c >= 0x80 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 0x20 for c in range(256))
#: Bytes of text whose words are held at once; words up to this length are hashed together.
PIECE, SHORT = 4 << 20, 48


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> 1), c >> 1)
    return c


CRC = _crc_table()

#: The order of documents: score falling, then id (null first), then what tells equal ids apart.
KEYS = ("k_score", "k_id", "k_given", "k_words", "k_features", "k_weight")
PROBE = ", ".join(["side int", "size long", *(f"{k} long" for k in KEYS)])

Key = tuple[int, ...]


def _spans(buffer: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and ends of the words of a folded buffer, in pieces of bounded size that end
    between words (a longer word is whole)."""
    at = 0
    while at < len(buffer):
        end = at + PIECE
        while end < len(buffer) and buffer[end] != 0x20:
            gap = np.flatnonzero(buffer[end:end + PIECE] == 0x20)
            end += int(gap[0]) if len(gap) else PIECE
        inside = np.concatenate(([False], buffer[at:end] != 0x20, [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + at
        yield edges[::2], edges[1::2]
        at = end


def _extended(crc: np.ndarray, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Running CRC-32 states carried on over one word each, a byte of all words at a time."""
    length = ends - starts
    order = np.argsort(-length, kind="stable")
    at, c = starts[order], crc[order]
    over = np.searchsorted(-length[order], -np.arange(SHORT + 1), "left")  # words longer than j
    for i in range(int(over[SHORT])):
        c[i] = zlib.crc32(buffer[at[i]:ends[order[i]]].tobytes(), int(c[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    for j in range(SHORT):
        k = slice(int(over[SHORT]), int(over[j]))
        c[k] = CRC[(c[k] ^ buffer[at[k] + j]) & 0xFF] ^ (c[k] >> 8)
    out = np.empty_like(c)
    out[order] = c
    return out


def features(parts: list[bytes], longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(run length, text number, CRC-32) of every run of 1 to ``longest`` words of some texts."""
    buffer = np.frombuffer(b" ".join(parts).translate(FOLD), np.uint8)
    ends_of = np.cumsum(np.array([len(p) + 1 for p in parts], np.int64))
    before = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for found in _spans(buffer):
        old = len(before[0])
        starts, ends = (np.concatenate(x) for x in zip(before, found))
        owner = np.searchsorted(ends_of, starts, "right")
        crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
        for k in range(1, longest + 1):
            if k > 1:
                crc = crc[:-1] if len(crc) else crc
                crc = CRC[(crc ^ 0x20) & 0xFF] ^ (crc >> 8)
            crc = _extended(crc, buffer, starts[k - 1:], ends[k - 1:])
            one = owner[:len(crc)]
            new = (one == owner[k - 1:]) & (np.arange(len(crc)) + k > old)
            yield k, one[new], crc[new] ^ np.uint32(0xFFFFFFFF)
        before = (starts[-longest + 1:], ends[-longest + 1:]) if longest > 1 else before


def _counted(longest: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                for _, _, crc in features(texts(part, "text"), longest):
                    n += np.bincount(crc % buckets, minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], ["bucket", "n"])
    return run


def bucket_counts(docs: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """Features of all texts by bucket: ``buckets`` numbers at most come to the driver."""
    small_batches(docs.sparkSession)
    out = np.zeros(buckets, np.int64)
    for r in (docs.select("text").mapInArrow(_counted(longest, buckets), "bucket int, n long")
              .groupBy("bucket").agg(F.sum("n").alias("n")).collect()):
        out[r["bucket"]] = r["n"]
    return out


def gains(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000) -> list[int]:
    """Thousandths of a nat by which a feature of a bucket speaks for the target."""
    have, want = bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets)
    s_all, t_all = float(have.sum() + buckets), float(want.sum() + buckets)
    return [math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(have.tolist(), want.tolist())]


def _weighed(gain: list[int], longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(gain, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                words, n, total = np.zeros((3, part.num_rows), np.int64)
                for k, owner, crc in features(texts(part, "text"), longest):
                    found = np.bincount(owner, minlength=part.num_rows)
                    n += found
                    if k == 1:
                        words += found
                    np.add.at(total, owner, table[crc % len(table)])
                added = [pa.array(c) for c in (words, n, total // np.maximum(n, 1))]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], [*part.schema.names, "n_words", "n_features", "weight"])
    return run


def score(docs: DataFrame, gain: list[int], longest: int = 1, seed: int = 2024) -> DataFrame:
    """All rows and columns of ``docs`` (doc_id, text) with n_words, n_features, weight and
    score, all long; input columns with these names are replaced.

    Null or empty text: no features, weight 0, score the noise alone.  A null doc_id draws
    its noise as the empty id.  Rows equal in id and text get equal scores."""
    base = docs.drop("n_words", "n_features", "weight", "score")
    small_batches(docs.sparkSession)
    fields = [*base.schema.fields, *(T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight"))]
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    drawn = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(F.log(-F.log(drawn)) * -1000.0)
    return base.mapInArrow(_weighed(gain, longest), T.StructType(fields)).withColumn("score", F.col("weight") + noise)


def _key_columns() -> list:
    return [(-F.col("score")).alias("k_score"), ordered_id().alias("k_id"), F.col("doc_id").isNotNull().cast("long").alias("k_given"),
            F.col("n_words").alias("k_words"), F.col("n_features").alias("k_features"), F.col("weight").alias("k_weight")]


def _compared(cols: list[np.ndarray], key: Key) -> np.ndarray:
    """-1, 0, 1 for the rows before, at and after a key."""
    out = np.zeros(len(cols[0]), np.int8)
    for c, v in zip(cols, key):
        out[(out == 0) & (c < v)] = -1
        out[(out == 0) & (c > v)] = 1
    return out


def _median(cols: list[np.ndarray], size: np.ndarray) -> Key:
    order = np.lexsort(cols[::-1])
    total = np.cumsum(size[order])
    at = order[np.searchsorted(total, -(-total[-1] // 2))]
    return tuple(int(c[at]) for c in cols)


def _of_rows(rows: list[tuple[int, Key]]) -> Key:
    return _median([np.array(c, np.int64) for c in zip(*(k for _, k in rows))], np.array([n for n, _ in rows], np.int64))


def _probe(low: Key | None, high: Key | None, pivot: Key | None):
    """Of a task's keys between the bounds: a row for each side of the pivot (-1, 0, 1) with
    its number of documents and, beside the pivot, the median of the medians of its batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        medians: dict[int, list[tuple[int, Key]]] = {}
        for b in batches:
            cols = [b.column(k).to_numpy() for k in KEYS]
            size = b.column("copies").to_numpy()
            side = np.ones(len(size), np.int8) if pivot is None else _compared(cols, pivot)
            if low is not None:
                side[_compared(cols, low) <= 0] = 9
            if high is not None:
                side[_compared(cols, high) >= 0] = 9
            for s in (-1, 0, 1):
                if (at := side == s).any():
                    medians.setdefault(s, []).append((int(size[at].sum()), _median([c[at] for c in cols], size[at])))
        if medians:
            rows = [(s, sum(n for n, _ in m), *_of_rows(m)) for s, m in medians.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 0 else pa.int64()) for i, c in enumerate(zip(*rows))],
                                             ["side", "size", *KEYS])
    return run


def cutoff(keys: DataFrame, n: int) -> tuple[Key, int]:
    """The n-th key (n at least 1, no more than there are documents), and how many of the
    documents with just this key are among the first n.  ``keys`` has KEYS and copies."""
    low = high = None
    before = 0

    def probed(pivot: Key | None):
        rows = keys
        if low is not None:
            rows = rows.where(F.col(KEYS[0]) >= low[0])
        if high is not None:
            rows = rows.where(F.col(KEYS[0]) <= high[0])
        found = rows.mapInArrow(_probe(low, high, pivot), PROBE).collect()
        return {s: [(r["size"], tuple(r[k] for k in KEYS)) for r in found if r["side"] == s] for s in (-1, 0, 1)}

    medians = probed(None)[1]
    while True:
        pivot = _of_rows(medians)
        sides = probed(pivot)
        less, at = (sum(size for size, _ in sides[s]) for s in (-1, 0))
        if before + less >= n:
            high, medians = pivot, sides[-1]
        elif before + less + at >= n:
            return pivot, n - before - less
        else:
            low, before, medians = pivot, before + less + at, sides[1]


def _place(key: Key):
    """-1, 0, 1 as a column, for rows before, at and after the key."""
    out = F.lit(0)
    for k, v in reversed(list(zip(KEYS, key))):
        out = F.when(F.col(k) < v, -1).when(F.col(k) > v, 1).otherwise(out)
    return out


def _grouped(scored: DataFrame, min_words: int) -> DataFrame:
    keyed = scored.select(*_key_columns())
    return written(keyed.groupBy(*KEYS).agg(F.count("*").alias("copies"))
                   .withColumn("eligible", F.col("k_words") >= min_words), "resample-keys")


def _limit(groups: DataFrame, percent: int) -> tuple[Key, int] | None:
    able = groups.where("eligible")
    n = (able.agg(F.sum("copies")).first()[0] or 0) * percent // 100
    return cutoff(able.select(*KEYS, "copies"), n) if n else None


def draw(scored: DataFrame, percent: int = 10, min_words: int = 20) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of a scored table.

    Of the N rows with at least ``min_words`` words, floor(percent * N / 100) are drawn: the
    highest scores, ties to the smaller doc_id (null is the smallest).  rank counts them from 1
    in that order, and is null for the others.  Rows that are equal in all of these are
    interchangeable: as many of them are drawn as the order has room for."""
    groups = _grouped(scored, min_words)
    limit = _limit(groups, percent)
    shown = [F.when(F.col("k_given") == 1, F.col("k_id")).alias("doc_id"), F.col("k_words").alias("n_words"),
             F.col("k_features").alias("n_features"), F.col("k_weight").alias("weight"), (-F.col("k_score")).alias("score")]
    if limit is None:
        return copies(groups, "copies", "_copy").select(*shown, F.lit(None).cast("long").alias("rank"))
    key, room = limit
    place = _place(key)
    taken = F.when(~F.col("eligible") | (place > 0), 0).when(place == 0, room).otherwise(F.col("copies"))
    marked = groups.withColumn("_taken", taken.cast("long"))
    part = (marked.where("_taken > 0").repartitionByRange(shuffle_width(scored.sparkSession), *KEYS)
            .withColumn("_part", F.spark_partition_id()))
    winners = written(part, "resample-winners")
    ends = winners.groupBy("_part").agg(F.sum("_taken").alias("_n"))
    starts = ends.select("_part", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    inside = W.partitionBy("_part").orderBy(*KEYS).rowsBetween(W.unboundedPreceding, -1)
    ranked = (winners.join(F.broadcast(starts), "_part")  # a row a partition
              .withColumn("_first", F.col("_start") + F.coalesce(F.sum("_taken").over(inside), F.lit(0))))
    drawn = copies(ranked, "_taken", "_copy").select(*shown, (F.col("_first") + F.col("_copy") + 1).cast("long").alias("rank"))
    rest = marked.withColumn("_rest", F.col("copies") - F.col("_taken")).where("_rest > 0")
    return drawn.unionByName(copies(rest, "_rest", "_copy").select(*shown, F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, longest: int = 1,
             buckets: int = 10_000, seed: int = 2024) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns and n_words, n_features, weight and score.

    An empty ``docs`` gives no row; with an empty target every bucket wants the same share."""
    scored = score(docs, gains(docs, target, longest, buckets), longest, seed)
    limit = _limit(_grouped(scored, min_words), percent)
    if limit is None:
        return scored.limit(0)
    key, room = limit
    keyed = scored.where(F.col("n_words") >= min_words).select("*", *_key_columns())
    return (keyed.where(_place(key) < 0).unionByName(keyed.where(_place(key) == 0).limit(room))).drop(*KEYS)
