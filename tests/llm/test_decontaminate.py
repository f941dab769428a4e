"""Decontamination against a direct search for every window."""

import random
import re

from pyspark.sql import functions as F

from forecourt.llm import decontaminate
from tests.llm.fixtures import documents, frame

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return PATTERN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, window=10):
    grams = {}
    for item, text in items:
        ws = _words(text)
        size = min(window, len(ws))
        for i in range(len(ws) - size + 1 if ws else 0):
            grams.setdefault(tuple(ws[i:i + size]), set()).add(item)
    out = []
    for doc, text, *_ in rows:
        ws, hit, found = _words(text), set(), set()
        for size in {len(g) for g in grams}:
            for i in range(len(ws) - size + 1):
                if (g := tuple(ws[i:i + size])) in grams:
                    hit |= set(range(i, i + size))
                    found |= grams[g]
        out.append((doc, len(ws), hit, found))
    return out


def _items(rows, seed=3):
    r = random.Random(seed)
    items = []
    for k in range(30):
        ws = _words(r.choice([t for _, t, *_ in rows if t and len(_words(t)) > 30]))
        a = r.randint(0, len(ws) - 25)
        items.append((k, " ".join(ws[a:a + r.choice([1, 4, 9, 10, 11, 25])]).upper()))
    items += [(98, "never seen words here"), (99, None), (100, ""), (101, "... 12 !"), (0, items[0][1]), (102, "b " * 14)]
    return items


def test_windows_match_brute_force(spark):
    rows = documents() + [(900, "a b " + "b " * 40 + "c", "en", "s", 1)]
    items = _items(rows)
    table = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    want = sorted((repr(d), n, len(h), repr(sorted(i for i in f))) for d, n, h, f in brute(rows, items))
    for block in (500_000, 40):
        out = decontaminate.contamination(frame(spark, rows).withColumn("items", F.lit(1)), table, block_words=block)
        got = sorted((repr(r.doc_id), r.n_words, r.n_hit, repr(r["items"])) for r in out.collect())
        assert got == want
    assert any(h for _, _, h, _ in brute(rows, items))


def test_spans_leave_the_text(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, f"Before, it. {item.title()}! After it and more words here to stay", "en", "s", 1),
            (2, item, "en", "s", 1), (3, "clean  text,\nas it was", "en", "s", 1), (4, None, "en", "s", 1)]
    docs = frame(spark, rows).withColumn("n_hit", F.lit("kept"))
    out = decontaminate.decontaminate(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {1: "Before, it. ! After it and more words here to stay", 3: "clean  text,\nas it was", 4: None}


def test_no_items_and_no_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    out = decontaminate.contamination(frame(spark, documents()), none)
    assert out.where("n_hit > 0 or size(items) > 0").count() == 0 and out.count() == len(documents())
    assert decontaminate.contamination(frame(spark, documents()).limit(0), none).count() == 0
