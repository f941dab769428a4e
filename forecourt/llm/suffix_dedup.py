"""Suffix-array dedup by distributed prefix doubling.

The question for every byte position is whether the 100 bytes from it on also start
earlier.  Prefix doubling names the strings at a position by rank pairs at growing
offsets: the name of 2L bytes is made of the names of L bytes at p and p + L.  Names are
64-bit hashes, so tasks name alike without a global sort; within a task they double
from 1 to ``SEED`` = 48 bytes.  Three things keep it small:

* Of the positions of a 100-byte window only the one whose 48-byte name is smallest (the
  leftmost, if several) goes to Spark.  It depends on the window's bytes alone, so equal
  windows send equal names; about one position in 27 is sent.
* Round 1 spreads the names over Spark's partitions and sorts them there; positions whose
  name is unique are done, as in any prefix doubling.  What is left is handed on as a
  Bloom filter of bounded size, whose false positives cost work, never results.
* Round 2 reranks the rest past the threshold: all windows that were named by a repeated
  position travel as one run of text with that position.  A task keeps only the earliest
  of equal runs, so a group of copies sends one run a task; the runs of a name are then
  compared window by window, by 128 bits of hash.  Round 1 counts the runs a name will
  send; a name with more than a task should hold is dealt out by the windows' own names.

The later windows come back as byte ranges, which are united per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import ordered_id, row_key, shuffle_width, slices, small_batches, texts, written

SEED = 48
#: Bits of the Bloom filter at most (32 MB), and hashes a name.
BLOOM_BITS, BLOOM_HASHES = 1 << 28, 4
#: A name is dealt out by windows when round 2 sends more runs of it than this (some 3 MB
#: of text), and more than one in ``HOT_SHARE`` of all runs: there are at most ``HOT_SHARE``
#: such names (80 MB).
HOT_RUNS, HOT_SHARE = 20_000, 10_000_000
#: Bytes of text that a task ranks and compares at a time.
CHUNK = 8 << 20

_rng = np.random.default_rng(20)
BYTE = _rng.integers(0, 2 ** 64, 256, dtype=np.uint64)
BYTE2 = _rng.integers(0, 2 ** 64, 256, dtype=np.uint64)
ODD = np.uint64(0x9E3779B97F4A7C15)
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def names(data: np.ndarray, length: int, table: np.ndarray = BYTE) -> np.ndarray:
    """Name of the ``length`` bytes from each position on, by doubling."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    part, size, power = table[data], 1, np.array([ODD])
    out, done = None, 0
    while True:
        if length & size:
            # The bits of the length, lowest first: what is named so far stands before this part.
            if out is None:
                out, done = part, size
            else:
                m = len(data) - done - size + 1
                out, done = out[:m] * _power(size) + part[done:done + m], done + size
        if done == length:
            return _mix(out[:n])
        part = part[:-size] * power + part[size:]
        size, power = size * 2, power * power


def _power(n: int) -> np.uint64:
    with np.errstate(over="ignore"):
        return np.uint64(pow(int(ODD), n, 2 ** 64))


def anchors(data: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, first window, end window) of every position that names a window, and
    the windows it names: all starts of ``threshold`` bytes in data, in runs."""
    windows = len(data) - threshold + 1
    if windows <= 0:
        return (np.zeros(0, np.int64),) * 3
    rank = names(data, min(SEED, threshold))
    width = threshold - min(SEED, threshold) + 1
    # Sliding minimum by doubling, ties to the left: the position rides along.
    low, at, size = rank, np.arange(len(rank), dtype=np.int32), 1
    while size < width:
        step = min(size, width - size)
        a, b = low[:-step], low[step:]
        right = b < a
        low = np.where(right, b, a)
        at = np.where(right, at[step:], at[:-step])
        size += step
    at = at[:windows]
    first = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
    return at[first].astype(np.int64), first, np.concatenate((first[1:], [windows]))


def _filled(bits: np.ndarray, names_: np.ndarray) -> None:
    size = np.uint64(len(bits) * 8)
    for k in range(BLOOM_HASHES):
        h = _mix(names_ + np.uint64(k) * ODD) % size
        np.bitwise_or.at(bits, (h >> np.uint64(3)).astype(np.int64), (np.uint8(1) << (h & np.uint64(7)).astype(np.uint8)))


def _in(bits: np.ndarray, names_: np.ndarray) -> np.ndarray:
    size, out = np.uint64(len(bits) * 8), np.ones(len(names_), dtype=bool)
    for k in range(BLOOM_HASHES):
        h = _mix(names_ + np.uint64(k) * ODD) % size
        out &= (bits[(h >> np.uint64(3)).astype(np.int64)] >> (h & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return out


def _chunked(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for part in slices(batch, "text", CHUNK):
            yield part, [np.frombuffer(t, np.uint8) for t in texts(part, "text")]


def _packed(buckets: int, threshold: int):
    """Round 1, task side: the distinct names of a chunk, by bucket, and those that the
    chunk holds more than once with the runs it will send (two at least)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data in _chunked(batches):
            spans, found = [], []
            for d in data:
                at, first, end = anchors(d, threshold)
                if len(at):
                    spans.append((d, first, end + threshold - 1))
                    found.append(names(d, min(SEED, threshold))[at])
            if not found:
                continue
            name, which, count = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
            runs = _distinct_runs(spans, which, count)
            bucket = ((name >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            name, bucket, runs = name[order], bucket[order], runs[order]
            edges = np.searchsorted(bucket, np.arange(buckets + 1))
            some = np.flatnonzero(np.diff(edges))
            cut = [slice(edges[b], edges[b + 1]) for b in some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array([name[c].tobytes() for c in cut], pa.binary()),
                 pa.array([name[c][runs[c] > 1].tobytes() for c in cut], pa.binary()),
                 pa.array([runs[c][runs[c] > 1].tobytes() for c in cut], pa.binary())],
                ["bucket", "names", "more", "runs"])
    return run


def _distinct_runs(spans: list[tuple], which: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Runs with distinct bodies of every name of a chunk; two at least if it is met twice."""
    keys, bodies, at = [], [], 0
    for d, start, end in spans:
        own = which[at:at + len(start)]
        at += len(start)
        some = np.flatnonzero(count[own] > 1)
        if len(some):
            keys.append(own[some])
            bodies.append(_span_names(d, start[some], end[some]))
    runs = np.minimum(count, 2)
    if keys:
        key, body = np.concatenate(keys), np.concatenate(bodies)
        order = np.lexsort((body, key))
        key, body = key[order], body[order]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (body[1:] != body[:-1])))
        runs = np.maximum(runs, np.bincount(key[new], minlength=len(count)))
    return runs.astype(np.int64)


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Round 1, after the shuffle: sorted names of a partition; those met again, packed,
    with the runs that round 2 sends of the most frequent ones."""
    held, more, runs = [], [], []
    for b in batches:
        for out, column, kind in ((held, "names", np.uint64), (more, "more", np.uint64), (runs, "runs", np.int64)):
            out += [np.frombuffer(x, kind) for x in b.column(column).to_pylist()]
    if held:
        name, count = np.unique(np.concatenate(held), return_counts=True)
        # A name of ``more`` is in ``names`` once already.
        np.add.at(count, np.searchsorted(name, np.concatenate(more)), np.concatenate(runs) - 1)
        total = int(count.sum())
        name, count = name[count > 1], count[count > 1]
        hot = count > HOT_RUNS
        yield pa.RecordBatch.from_arrays(
            [pa.array([name.tobytes()], pa.binary()), pa.array([len(name)], pa.int64()), pa.array([total], pa.int64()),
             pa.array([name[hot].view(np.int64).tolist()], pa.list_(pa.int64())),
             pa.array([count[hot].tolist()], pa.list_(pa.int64()))], ["names", "n", "total", "hot", "met"])


def _bloom(repeated: DataFrame, n: int) -> np.ndarray:
    """Filter of all repeated names: tasks fill pieces, which come to the driver one by one."""
    bits = min(BLOOM_BITS, max(1 << 13, 1 << (n * 12 - 1).bit_length()))
    out = np.zeros(bits // 8, np.uint8)

    def run(batches):
        own = np.zeros(bits // 8, np.uint8)
        for b in batches:
            for x in b.column("names").to_pylist():
                _filled(own, np.frombuffer(x, np.uint64))
        import zlib
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(own.tobytes(), 1)], pa.binary())], ["bits"])

    import zlib
    pieces = max(1, min(16, n // 500_000))
    for row in repeated.select("names").coalesce(pieces).mapInArrow(run, "bits binary").toLocalIterator():
        out |= np.frombuffer(zlib.decompress(row.bits), np.uint8)
    return out


RUN = "key long, id long, row long, start long, body binary"


def _later(group: np.ndarray, name: np.ndarray, id_: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which of the strings (group, name) are not the first by (id, start)."""
    order = np.lexsort((start, id_, name, group))
    g, m, i, s = group[order], name[order], id_[order], start[order]
    new = np.concatenate(([True], (g[1:] != g[:-1]) | (m[1:] != m[:-1])))
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    out = np.zeros(len(group), dtype=bool)
    out[order] = (i != i[lead]) | (s != s[lead])
    return out


def _runs(shared, threshold: int):
    """Round 2, task side: runs of windows named by a repeated position.  Of equal runs
    in a chunk the earliest goes on; the others are ranges already (body null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, hot = shared.value
        for part, data in _chunked(batches):
            ids, rows = (part.column(c).to_numpy() for c in ("_id", "_row"))
            doc, lo, hi, key, body_name = [], [], [], [], []
            for k, d in enumerate(data):
                at, first, end = anchors(d, threshold)
                if not len(at):
                    continue
                name = names(d, min(SEED, threshold))[at]
                some = np.flatnonzero(_in(bits, name))
                if not len(some):
                    continue
                doc.append(np.full(len(some), k))
                lo.append(first[some])
                hi.append(end[some])
                key.append(name[some])
                body_name.append(_span_names(d, first[some], end[some] + threshold - 1))
            if not doc:
                continue
            doc, lo, hi, key, body_name = map(np.concatenate, (doc, lo, hi, key, body_name))
            later = _later(key, body_name, ids[doc], lo)
            out = [_ranges(ids[doc[later]], rows[doc[later]], lo[later], hi[later] + threshold - 1)]
            dealt = np.isin(key, hot) & ~later
            sent = np.flatnonzero(~later & ~dealt)
            out.append([(key[i], ids[doc[i]], rows[doc[i]], lo[i], data[doc[i]][lo[i]:hi[i] + threshold - 1].tobytes())
                        for i in sent.tolist()])
            out += _windows(np.flatnonzero(dealt), doc, lo, hi, ids, rows, data, threshold)
            flat = [r for rs in out for r in rs]
            for a in range(0, len(flat), 20_000):
                yield _record(flat[a:a + 20_000])
    return run


def _windows(dealt: np.ndarray, doc, lo, hi, ids, rows, data, threshold: int) -> list[list[tuple]]:
    """The windows of runs under their own names.  Of equal ones in a chunk the earliest
    goes on, as with runs."""
    if not len(dealt):
        return []
    size = hi[dealt] - lo[dealt]
    of = np.repeat(doc[dealt], size)
    start = np.concatenate([np.arange(lo[i], hi[i]) for i in dealt.tolist()])
    own, second = (np.concatenate([names(data[doc[i]][lo[i]:hi[i] + threshold - 1], threshold, t) for i in dealt.tolist()])
                   for t in (BYTE, BYTE2))
    later = _later(own, second, ids[of], start)
    sent = np.flatnonzero(~later)
    return [_ranges(ids[of[later]], rows[of[later]], start[later], start[later] + threshold),
            [(own[j], ids[of[j]], rows[of[j]], start[j], data[of[j]][start[j]:start[j] + threshold].tobytes()) for j in sent.tolist()]]


def _record(rows: list[tuple]) -> pa.RecordBatch:
    key, id_, row, start, body = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.array(key, np.uint64).view(np.int64)), pa.array(np.array(id_, np.int64)), pa.array(np.array(row, np.int64)),
         pa.array(np.array(start, np.int64)), pa.array(body, pa.binary())], ["key", "id", "row", "start", "body"])


def _span_names(d: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Names of the spans [start, end) of one text."""
    total = np.concatenate(([np.uint64(0)], np.cumsum(BYTE2[d] * _inverse_powers(len(d)), dtype=np.uint64)))
    return _mix((total[end] - total[start]) * _powers(len(d))[start] + (end - start).astype(np.uint64) * MIX2)


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> np.ndarray:
    _grow(n)
    return _POWERS[0][:n]


def _inverse_powers(n: int) -> np.ndarray:
    _grow(n)
    return _POWERS[1][:n]


def _grow(n: int) -> None:
    if len(_POWERS[0]) < n:
        inverse = np.uint64(pow(int(ODD), -1, 2 ** 64))
        for k, base in enumerate((ODD, inverse)):
            full = np.full(n, base, np.uint64)
            full[0] = 1
            _POWERS[k] = np.multiply.accumulate(full)


def _ranges(id_: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[tuple]:
    """Ranges of bytes as (0, id, row, start << 32 | end, None) rows, touching ones united."""
    if not len(id_):
        return []
    order = np.lexsort((end, start, row, id_))
    id_, row, start, end = id_[order], row[order], start[order], end[order]
    same = np.concatenate(([False], (id_[1:] == id_[:-1]) & (row[1:] == row[:-1])))
    group = np.cumsum(~same) - 1
    # Ends grow with the document's number, so one running maximum does for all.
    reach = np.maximum.accumulate(end + group * (1 << 40)) - group * (1 << 40)
    new = ~same | np.concatenate(([True], start[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:] - 1, [len(id_) - 1]))
    return [(0, i, r, (int(s) << 32) | int(e), None)
            for i, r, s, e in zip(id_[first].tolist(), row[first].tolist(), start[first].tolist(), reach[last].tolist())]


def _compared(threshold: int):
    """Round 2, after the shuffle: runs sorted by name; windows that are not the first
    of their kind, as ranges.  Ranges found before pass through."""
    def compare(held: list[tuple]) -> list[tuple]:
        key = np.array([h[0] for h in held], np.int64)
        id_, row, start = (np.array([h[k] for h in held], np.int64) for k in (1, 2, 3))
        size = np.array([len(h[4]) - threshold + 1 for h in held])
        text = np.frombuffer(b"".join(h[4] for h in held), np.uint8)
        skip = np.concatenate(([0], np.cumsum(size + threshold - 1)))[:-1]
        of = np.repeat(np.arange(len(held)), size)
        off = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
        name = names(text, threshold, BYTE2)[skip[of] + off]  # the key is a name by BYTE
        at = start[of] + off
        later = _later(key[of], name, id_[of], at)
        return _ranges(id_[of][later], row[of][later], at[later], at[later] + threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        out: list[tuple] = []
        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in range(5)]
            for r in zip(*cols):
                if r[4] is None:
                    out.append(r)
                    continue
                if held and size > CHUNK // 4 and r[0] != held[-1][0]:
                    out += compare(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[4])
            if len(out) > 10_000:
                yield _found(out)
                out = []
        if held:
            out += compare(held)
        if out:
            yield _found(out)

    return run


def _found(rows: list[tuple]) -> pa.RecordBatch:
    _, id_, row, both, _ = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(id_, pa.int64()), pa.array(row, pa.int64()), pa.array(both, pa.int64())],
                                      ["_id", "_row", "range"])


def repeats(docs: DataFrame, threshold: int = 100) -> DataFrame:
    """(_id, _row, range) of bytes covered by a string of ``threshold`` bytes that also
    starts earlier; range is start << 32 | end.  docs: _id, _row, text."""
    spark = docs.sparkSession
    width = shuffle_width(spark)
    # Names of a partition are held as 8 bytes each: many buckets keep that small.
    spread = docs.mapInArrow(_packed(4 * width, threshold), "bucket int, names binary, more binary, runs binary").repartition(width, "bucket")
    repeated = written(spread.mapInArrow(_repeated, "names binary, n long, total long, hot array<long>, met array<long>"),
                       "repeated-names")
    n, total = repeated.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    hot = (repeated.select(F.explode(F.arrays_zip("hot", "met")).alias("z"))
           .where(F.col("z.met") > total // HOT_SHARE).select("z.hot").collect())
    shared = spark.sparkContext.broadcast((_bloom(repeated, n), np.array([r.hot for r in hot], np.int64).view(np.uint64)))
    runs = docs.mapInArrow(_runs(shared, threshold), RUN)
    # Ranges found already have key 0; they are spread by their row.
    deal = F.when(F.col("body").isNull(), F.col("row")).otherwise(F.col("key"))
    return (runs.withColumn("_deal", deal).repartition(width, "_deal").sortWithinPartitions("key").drop("_deal")
            .mapInArrow(_compared(threshold), "_id long, _row long, range long"))


def dedup_substrings(docs: DataFrame, threshold: int = 100) -> DataFrame:
    """Every row of (doc_id, text) as (doc_id, kept, n_bytes, removed): the bytes that
    stay, and the maximal removed ranges as an array of (start, end).

    A byte goes when a string of ``threshold`` bytes that covers it also starts earlier:
    in a smaller doc_id, or before in the same document; strings are judged on the
    input.  Null text is empty; a null doc_id is the smallest; rows that repeat a doc_id
    count as starting together, so equal ones both stay.  Texts may have 2**31 bytes."""
    small_batches(docs.sparkSession)
    base = docs.select("doc_id", ordered_id().alias("_id"), row_key().alias("_row"), "text")
    ranges = (repeats(base.select("_id", "_row", "text"), threshold).groupBy("_id", "_row")
              .agg(F.collect_set("range").alias("ranges")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            for part in slices(batch, "text"):
                kept, spans, sizes = [], [], []
                for data, got in zip(texts(part, "text"), part.column("ranges").to_pylist()):
                    merged: list[list[int]] = []
                    for s, e in sorted((x >> 32, x & 0xFFFFFFFF) for x in got or ()):
                        if merged and s <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], e)
                        else:
                            merged.append([s, e])
                    at, stay = 0, []
                    for s, e in merged:
                        stay.append(data[at:s])
                        at = e
                    kept.append(b"".join([*stay, data[at:]]))
                    sizes.append(len(data))
                    spans.append([{"start": s, "end": e} for s, e in merged])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(item))],
                    ["doc_id", "kept", "n_bytes", "removed"])

    kind = dict(docs.dtypes)["doc_id"]
    return (base.join(ranges, ["_id", "_row"], "left").select("doc_id", "text", "ranges")
            .mapInArrow(run, f"doc_id {kind}, kept binary, n_bytes long, removed array<struct<start:long,end:long>>"))
