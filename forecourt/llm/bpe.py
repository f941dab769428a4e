"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A task takes its texts in chunks.  The distinct pieces of a chunk that it has not met
yet are laid out as one row of symbols; an inverted index leads from a token pair to
the places where it stands, and the merges are replayed over all words at once, in
order of rank, touching only the neighbours of a merged place.  The token ids of a
piece are then looked up for its occurrences.  No row leaves its task.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import slices, small_batches

#: Pieces whose ids a task remembers, and bytes of them; beyond that it forgets all.
CACHE_PIECES, CACHE_BYTES = 400_000, 32 << 20

#: Bytes of text whose new pieces are replayed together.
CHUNK = 10 << 20

#: The tokenizer's published pattern, and the same for texts below U+0250 in classes
#: that Python's faster ``re`` knows: its letters, numbers and white space are listed.
GENERAL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LETTER, _NUMBER, _SPACE = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
LATIN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
                   f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
BEYOND = re.compile("[^\x00-\u024f]")


def splitter(pattern: str):
    """Function from a text to the matches of the pattern."""
    general = regex.compile(pattern).findall
    if pattern != GENERAL:
        return general
    return lambda text: (general if BEYOND.search(text) else LATIN.findall)(text)


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken file: lines of base64 bytes and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


#: Rank of what is no token.
NONE = 1 << 30


class Replay:
    """Token ids of whole word lists under the ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.base = max(ranks.values()) + 1
        # Every pair of tokens that makes a token, as left * base + right, sorted.
        made = sorted((ranks[t[:k]] * self.base + ranks[t[k:]], i) for t, i in ranks.items()
                      for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks)
        self.keys = np.array([k for k, _ in made], np.int64)
        self.makes = np.array([i for _, i in made], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank, which is the id, of the tokens that pairs make; NONE where none."""
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.makes[at], NONE) if len(self.keys) else np.full(len(key), NONE)

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, packed as little-endian int32."""
        out: list[bytes] = [b""] * len(pieces)
        todo = []
        for k, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[k] = whole.to_bytes(4, "little")
            elif piece:
                todo.append(k)
        if not todo:
            return out
        size = np.array([len(pieces[k]) for k in todo])
        end = np.cumsum(size)
        word = np.repeat(np.arange(len(todo)), size)
        sym = self.single[np.frombuffer(b"".join(pieces[k] for k in todo), np.uint8)]
        n = len(sym)
        # Neighbours in the word; -1 at its ends, which is read as the spare place n.
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[end - 1] = before[end - size] = -1
        current = np.full(n + 1, NONE)
        sym = np.append(sym, -1)
        inside = np.flatnonzero(after[:n] >= 0)
        current[inside] = self.rank(sym[inside], sym[inside + 1])
        odd = np.zeros(len(todo), dtype=bool)
        # The inverted index: rank of a pair -> places of its left symbol, in pieces as they came up.
        places: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def note(at: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cut = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            lo = 0
            for hi in [*cut.tolist(), len(at)]:
                r = int(ranks[lo])
                if r in places:
                    places[r].append(at[lo:hi])
                else:
                    places[r] = [at[lo:hi]]
                    heapq.heappush(queue, r)
                lo = hi

        found = inside[current[inside] < NONE]
        if len(found):
            note(found, current[found])
        while queue:
            r = heapq.heappop(queue)
            held = places.pop(r)
            at = np.unique(np.concatenate(held))  # in order of place
            at = at[current[at] == r]
            if not len(at):
                continue
            right = after[at]
            clash = right[:-1] == at[1:]
            if clash.any():
                # Places that share a symbol: the leftmost merges first, so every other one of a chain.
                k = np.arange(len(at))
                start = np.maximum.accumulate(np.where(np.concatenate(([True], ~clash)), k, 0))
                at = at[(k - start) % 2 == 0]
                right = after[at]
            sym[at], sym[right] = r, -1
            current[right] = NONE
            beyond = after[right]
            after[at] = beyond
            more = beyond >= 0
            before[beyond[more]] = at[more]
            left = before[at]
            touched = np.concatenate((at, left[left >= 0]))
            follow = after[touched]
            new = np.where(follow >= 0, self.rank(sym[touched], sym[follow]), NONE)
            current[touched] = new
            if (new < r).any():
                # A pair that goes before this one came up: its word is replayed alone.
                odd[word[touched[new < r]]] = True
            live = new < NONE
            if live.any():
                note(touched[live], new[live])
        alive = sym[:n] >= 0
        ids = sym[:n][alive].astype("<i4")
        counts = np.bincount(word[alive], minlength=len(todo))
        edges = np.concatenate(([0], np.cumsum(counts))) * 4
        flat = ids.tobytes()
        for i, (k, lo, hi) in enumerate(zip(todo, edges[:-1].tolist(), edges[1:].tolist())):
            out[k] = self.alone(pieces[k]) if odd[i] else flat[lo:hi]
        return out

    def alone(self, piece: bytes) -> bytes:
        """Ids of one piece, merge by merge."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        get = self.ranks.get
        while len(parts) > 1:
            r, i = min((get(a + b, NONE), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if r == NONE:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return np.array([self.ranks[p] for p in parts], "<i4").tobytes()


def token_bytes(ranks: dict[bytes, int]) -> list[bytes | None]:
    """Bytes of each id."""
    tokens: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for b, i in ranks.items():
        tokens[i] = b
    return tokens


def bytes_of(ids: list[int], tokens: list[bytes | None]) -> bytes:
    return b"".join(map(tokens.__getitem__, ids))


def encode(docs: DataFrame, ranks_path: str, pattern: str, decoded: str | None = None) -> DataFrame:
    """``docs`` with ids (array<int>) of the whole text, each match of ``pattern``
    encoded separately, no special tokens.  Null or empty text: no ids.  Bytes of a
    text outside every match (a pattern may leave some out) get no id.  An input column
    ids is replaced.  ranks_path is read where the tasks run.  With ``decoded`` a column
    of that name gets the bytes of the ids, as ``decode`` gives them, by the same worker."""
    spark = docs.sparkSession
    small_batches(spark)
    base = docs.drop("ids", *([decoded] if decoded else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay, split = Replay(load_ranks(ranks_path)), splitter(pattern)
        tokens = token_bytes(replay.ranks)
        # Number of a piece, in order of its first appearance, and by that number its ids.
        number: defaultdict[str, int] = defaultdict()
        number.default_factory = number.__len__
        packed: list[bytes] = []
        held = 0
        for batch in batches:
            for part in slices(batch, "text", CHUNK):
                if len(packed) > CACHE_PIECES or held > CACHE_BYTES:
                    number.clear()
                    packed.clear()
                    held = 0
                # The pieces of one text at a time: what a chunk holds is their numbers.
                rows = []
                for text in part.column("text"):
                    ws = split(text.as_py() or "")
                    rows.append(np.fromiter(map(number.__getitem__, ws), np.int32, len(ws)))
                new = list(islice(number, len(packed), None))
                ids = replay.encode([w.encode() for w in new])
                packed += ids
                held += sum(map(len, new)) + sum(map(len, ids))
                joined = [b"".join(map(packed.__getitem__, row.tolist())) for row in rows]
                ends = np.cumsum([0, *(len(x) // 4 for x in joined)]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(joined), dtype="<i4"))
                columns = [*part.columns, pa.ListArray.from_arrays(pa.array(ends), flat)]
                if decoded:
                    columns.append(pa.array([bytes_of(np.frombuffer(x, "<i4").tolist(), tokens) for x in joined], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "ids", *([decoded] if decoded else [])])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(run, f"{schema}, ids array<int>" + (f", `{decoded}` binary" if decoded else ""))


def decode(encoded: DataFrame, ranks_path: str, out: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of its ids.  Null ids: no bytes.  An id outside the
    ranks is an error."""
    base = encoded.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_bytes(load_ranks(ranks_path))
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                col = part.column("ids")
                texts = [bytes_of(ids or [], tokens) for ids in col.to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], [*part.schema.names, out])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(run, f"{schema}, `{out}` binary")


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of rows with doc_id, ids, decoded."""
    return encoded.select(
        "doc_id", *more, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
