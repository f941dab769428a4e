"""Benchmark decontamination with a generalised suffix automaton.

The normalised test items are put in blocks of bounded word count; each block becomes
one automaton over words (every item restarts at the root), kept as plain arrays and
broadcast, so a broadcast never exceeds ``BLOCK_WORDS``.  Documents stream through it:
at each word the automaton holds the longest suffix that occurs in an item.  Where that
length reaches the window, the last ``window`` words are hit; an item shorter than the
window is hit where all of it occurs.  Several blocks are passed one after the other
over the same batches, without a shuffle.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import aside, restored, slices, small_batches

#: A word of lower-cased text: ASCII letters, digits, and everything beyond ASCII.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Words of the items in one automaton; an automaton has at most twice as many states.
BLOCK_WORDS = 500_000


def words(text: str | None) -> list[str]:
    return WORD.findall(text.translate(UPPER)) if text else []


class Automaton:
    """Suffix automaton of word sequences, with the items of every window."""

    def __init__(self, items: list[tuple[int, list[str]]], window: int):
        self.window = window
        self.ids: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(item, [self.ids.setdefault(w, len(self.ids)) for w in ws]) for item, ws in items if ws]
        for _, seq in coded:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        #: Items of the window that ends in a state: the state holding its last ``window`` words.
        self.items: dict[int, set[int]] = defaultdict(set)
        #: Whole items shorter than the window, by the state that holds them.
        self.short: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.least = min([window, *(len(s) for _, s in coded)])
        for item, seq in coded:
            state = 0
            for i, c in enumerate(seq):
                state = self.next[state][c]
                if i + 1 >= window:
                    self.items[self.at(state, window)].add(item)
            if len(seq) < window:
                self.short[self.at(state, len(seq))].append((len(seq), item))

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        new = len(length)
        length.append(length[last] + 1)
        nxt.append({})
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return new

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link = self.next, self.link
        twin = len(self.length)
        self.length.append(self.length[p] + 1)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        link[q] = twin
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = twin
            p = link[p]
        return twin

    def at(self, state: int, n: int) -> int:
        """The state on the suffix path of ``state`` that holds the suffix of n words."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def scan(self, text_words: list[str]) -> tuple[np.ndarray, set[int]]:
        """(hit flag of each word, items found)."""
        hit, found = np.zeros(len(text_words) + 1, dtype=np.int32), set()
        if not self.ids or len(text_words) < self.least:
            return hit[:-1] > 0, found
        get = self.ids.get
        codes = np.fromiter((get(w, -1) for w in text_words), np.int32, len(text_words))
        # Only runs of known words can hold a match.
        known = np.flatnonzero(np.diff(np.concatenate(([False], codes >= 0, [False])).astype(np.int8)))
        nxt, link, length, window = self.next, self.link, self.length, self.window
        for s, e in known.reshape(-1, 2).tolist():
            if e - s < self.least:
                continue
            state = n = 0
            for i, c in enumerate(codes[s:e].tolist(), s + 1):
                while c not in nxt[state]:
                    if state == 0:
                        break
                    state = link[state]
                    n = length[state]
                else:
                    state = nxt[state][c]
                    n += 1
                if n >= window:
                    hit[i - window] += 1
                    hit[i] -= 1
                    found |= self.items[self.at(state, window)]
                if self.short:
                    p = state
                    while p > 0:
                        for size, item in self.short.get(p, ()):
                            if size <= n:
                                hit[i - size] += 1
                                hit[i] -= 1
                                found.add(item)
                        p = link[p]
        return np.cumsum(hit[:-1]) > 0, found


def blocks_of(items: DataFrame, window: int, block_words: int = BLOCK_WORDS) -> Iterator[Automaton]:
    """Automata of all items, each over at most ``block_words`` words (or one longer
    item).  Items come to the driver one at a time, in blocks."""
    block, n = [], 0
    for row in items.select(F.col("item_id").cast("long").alias("item_id"), "text").toLocalIterator():
        ws = words(row.text)
        if block and n + len(ws) > block_words:
            yield Automaton(block, window)
            block, n = [], 0
        if ws and row.item_id is not None:
            block.append((row.item_id, ws))
            n += len(ws)
    if block:
        yield Automaton(block, window)


def _pass(shared, first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                n, flags, items = [], [], []
                for k, text in enumerate(part.column("text").to_pylist()):
                    ws = words(text)
                    hit, found = automaton.scan(ws) if automaton else (np.zeros(len(ws), bool), set())
                    if not first:
                        old = np.unpackbits(np.frombuffer(part.column("hit_bits")[k].as_py(), np.uint8), count=len(ws))
                        hit, found = hit | (old > 0), found | set(part.column("items")[k].as_py())
                    n.append(len(ws))
                    flags.append(np.packbits(hit).tobytes())
                    items.append(sorted(found))
                names = [x for x in part.schema.names if x not in ("n_words", "hit_bits", "items")]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(x) for x in names), pa.array(n, pa.int64()), pa.array(flags, pa.binary()),
                     pa.array(items, pa.list_(pa.int64()))], [*names, "n_words", "hit_bits", "items"])
    return run


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with n_words, hit_bits (one bit a word, packed) and items (ids of the
    items found, ascending) added.

    Null or empty text has no words.  Items that are null, empty or without an id are
    not looked for; items that repeat an id count as one.  Every row of ``docs`` comes
    back once; input columns named like an added one are replaced."""
    spark = docs.sparkSession
    small_batches(spark)
    out = docs.drop("n_words", "hit_bits", "items", "n_hit")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields)
    schema += ", n_words long, hit_bits binary, items array<long>"
    first = True
    for automaton in blocks_of(items, window, block_words):
        out = out.mapInArrow(_pass(spark.sparkContext.broadcast(automaton), first), schema)
        first = False
    if first:
        out = out.mapInArrow(_pass(spark.sparkContext.broadcast(None), True), schema)
    return out.withColumn("n_hit", _hits(F.col("hit_bits")))


def _hits(bits):
    """Set bits of a binary column: its hex digits, by the bits they have."""
    digits = F.hex(bits)
    by_bits = {1: "1248", 2: "3569AC", 3: "7BDE", 4: "F"}
    total = F.lit(0).cast("long")
    for k, chars in by_bits.items():
        total = total + F.length(F.regexp_replace(digits, f"[^{chars}]", "")) * k
    return total.cast("long")


def without_hits(text: str | None, hit: np.ndarray) -> str:
    """The text without its hit words and what stands between them."""
    if text is None or not hit.any():
        return text
    spans = [m.span() for m in WORD.finditer(text.translate(UPPER))]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))).reshape(-1, 2)
    out, at = [], 0
    for s, e in edges.tolist():
        out.append(text[at:spans[s][0]])
        at = spans[e - 1][1]
    return "".join([*out, text[at:]])


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, max_coverage: float = 0.8) -> DataFrame:
    """``docs`` without the passages that occur in an item: spans of hit words leave the
    text, and a document with more than ``max_coverage`` of its words hit leaves whole.
    Documents without a hit are returned as they are."""
    plain, own = aside(docs, "n_words", "hit_bits", "items", "n_hit")
    cols = plain.columns
    found = contamination(plain, items, window).where(
        (F.col("n_hit") == 0) | (F.col("n_hit") <= F.col("n_words") * max_coverage))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                new = []
                for text, bits, n in zip(*(part.column(c).to_pylist() for c in ("text", "hit_bits", "n_words"))):
                    new.append(without_hits(text, np.unpackbits(np.frombuffer(bits, np.uint8), count=n) > 0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(new, pa.string()) if c == "text" else part.column(c) for c in cols], cols)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return restored(found.mapInArrow(run, schema), own, docs.columns)
