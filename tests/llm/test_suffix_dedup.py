"""Suffix-array dedup against a direct search for every string."""

import random

import numpy as np

from forecourt.llm import suffix_dedup
from tests.llm.fixtures import documents, frame

MIN = -(2 ** 63)


def brute(rows, n=100):
    first = {}
    for doc, text, *_ in rows:
        data, d = (text or "").encode(), MIN if doc is None else doc
        for i in range(len(data) - n + 1):
            s = data[i:i + n]
            first[s] = min(first.get(s, (d, i)), (d, i))
    out = []
    for doc, text, *_ in rows:
        data, d = (text or "").encode(), MIN if doc is None else doc
        gone = bytearray(len(data))
        for i in range(len(data) - n + 1):
            if first[data[i:i + n]] != (d, i):
                gone[i:i + n] = b"\1" * n
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((repr(doc), len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone) if not g)))
    return sorted(out)


def _got(docs, **kw):
    return sorted((repr(r.doc_id), r.n_bytes, sum(x.end - x.start for x in r.removed), len(r.removed), bytes(r.kept))
                  for r in suffix_dedup.dedup_substrings(docs, **kw).collect())


def _rows():
    r = random.Random(9)
    rows = documents()
    passage = "".join(r.choice("abcdef gh") for _ in range(700))
    for k in range(40):
        a = r.randint(0, 500)
        body = "".join(r.choice("abcdef gh") for _ in range(r.randint(0, 300)))
        rows.append((200 + k, body + passage[a:a + r.randint(60, 250)] + body[:150] + "é" * r.randint(0, 80), "en", "s", 1))
    rows += [(300, passage[:99], "en", "s", 1), (301, passage[:100], "en", "s", 1), (302, passage[1:101], "en", "s", 1)]
    return rows


def test_matches_brute_force(spark):
    rows = _rows()
    want = brute(rows)
    assert sum(w[2] for w in want) > 5000
    assert _got(frame(spark, rows)) == want


def test_names_dealt_out_by_windows(spark, monkeypatch):
    rows = _rows()
    monkeypatch.setattr(suffix_dedup, "HOT_SHARE", 10 ** 9)
    hot = suffix_dedup._repeated

    def all_hot(batches):
        suffix_dedup.HOT_RUNS = 2
        yield from hot(batches)
    monkeypatch.setattr(suffix_dedup, "_repeated", all_hot)
    assert _got(frame(spark, rows)) == brute(rows)


def test_passage_of_very_many_documents_is_dealt_out(spark, monkeypatch):
    r = random.Random(4)
    word = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    passage = word(110)
    rows = [(i, word(30) + passage + word(30)) for i in range(suffix_dedup.HOT_RUNS + 1000)]
    dealt = []
    bloom = suffix_dedup._bloom
    monkeypatch.setattr(suffix_dedup, "_bloom", lambda repeated, n: (
        dealt.extend(x for row in repeated.select("hot").collect() for x in row.hot), bloom(repeated, n))[1])
    assert _got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    assert dealt


def test_other_threshold_and_empty(spark):
    rows = _rows()[:90]
    assert _got(frame(spark, rows), threshold=30) == brute(rows, 30)
    assert suffix_dedup.dedup_substrings(frame(spark, rows).limit(0)).count() == 0


def test_names_are_of_the_bytes():
    d = np.frombuffer(b"abcabcabdabcabcabd" * 3, np.uint8)
    for n in (1, 5, 7, 48):
        by = {}
        for i, x in enumerate(suffix_dedup.names(d, n)):
            by.setdefault(d[i:i + n].tobytes(), set()).add(int(x))
        assert all(len(v) == 1 for v in by.values()) and len({next(iter(v)) for v in by.values()}) == len(by)
    start, end = np.array([0, 9, 3, 18]), np.array([9, 18, 12, 27])
    a = suffix_dedup._span_names(d, start, end)
    assert a[0] == a[1] == a[3] != a[2]
