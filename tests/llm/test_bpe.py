"""Merge replay against the tiktoken library."""

import random

import public_tokenizers
import tiktoken

from forecourt.llm import bpe
from tests.llm.fixtures import documents, frame

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def test_ids_and_round_trip(spark):
    lib = _library()
    rows = documents() + [(700, "<|endoftext|> it's 日本語 ​\U0001f600  \n\n x" * 50, "en", "s", 1),
                          (701, "a" * 5000, "en", "s", 1), (702, "The quick brown fox's 1234567 ...\t\r\n", "en", "s", 1)]
    out = bpe.decode(bpe.encode(frame(spark, rows), PATH, public_tokenizers.PATTERN), PATH).collect()
    want = sorted((repr(d), lib.encode_ordinary(t or "")) for d, t, *_ in rows)
    assert sorted((repr(r.doc_id), list(r.ids)) for r in out) == want
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in out)


def test_random_pieces():
    lib, r = _library(), random.Random(5)
    replay = bpe.Replay(bpe.load_ranks(PATH))
    pieces = [bytes(r.choice(b"aebst htr\xc3\xa9\xff1") for _ in range(r.randint(1, 40))) for _ in range(4000)]
    got = replay.encode(pieces)
    for p, ids in zip(pieces, got):
        assert [int.from_bytes(ids[i:i + 4], "little") for i in range(0, len(ids), 4)] == lib._encode_single_piece(p)


def test_a_pair_of_lower_rank_goes_first():
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 300, b"abc": 260, b"cb": 270, b"abcbc": 280}
    replay = bpe.Replay(ranks)
    r = random.Random(2)
    for _ in range(500):
        p = bytes(r.choice(b"abc") for _ in range(r.randint(1, 12)))
        parts = [p[i:i + 1] for i in range(len(p))]
        while True:
            best = min(((ranks[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in ranks), default=None)
            if best is None or p in ranks:
                break
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        want = [ranks[p]] if p in ranks else [ranks[x] for x in parts]
        got = replay.encode([p])[0]
        assert [int.from_bytes(got[i:i + 4], "little") for i in range(0, len(got), 4)] == want


def test_empty_table(spark):
    docs = frame(spark, documents()).limit(0)
    assert bpe.digests(bpe.decode(bpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH)).count() == 0


def test_fast_split_is_the_pattern():
    lib, r = _library(), random.Random(8)
    assert bpe.GENERAL == public_tokenizers.PATTERN
    fast, replay = bpe.splitter(bpe.GENERAL), bpe.Replay(bpe.load_ranks(PATH))
    chars = [chr(c) for c in range(0x250)] + list(" '  \n\t'strelvdmaz09.!") * 12
    for _ in range(1500):
        text = "".join(r.choice(chars) for _ in range(r.randint(1, 30)))
        packed = b"".join(replay.encode([w.encode() for w in fast(text)]))
        assert [int.from_bytes(packed[i:i + 4], "little") for i in range(0, len(packed), 4)] == lib.encode_ordinary(text), repr(text)


def test_decoded_in_one_pass(spark):
    docs = frame(spark, documents())
    both = bpe.encode(docs, PATH, public_tokenizers.PATTERN, "decoded").select("doc_id", "ids", "decoded")
    apart = bpe.decode(bpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH).select("doc_id", "ids", "decoded")
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.ids)
    assert sorted(both.collect(), key=key) == sorted(apart.collect(), key=key)
