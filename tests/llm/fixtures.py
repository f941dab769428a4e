"""Small awkward tables for the operators' tests."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def documents(seed: int = 7, n: int = 60) -> list[tuple]:
    """Nulls, empties, copies, near copies, shared lines, periodic and long texts."""
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeéß ñ日") for _ in range(r.randint(1, 8))) for _ in range(300)]
    line = lambda k: " ".join(r.choice(words) for _ in range(k))
    shared = [line(12) for _ in range(4)] + ["   A line Shared By many documents, with CAPITALS and spaces \t"]
    rows = []
    for i in range(n):
        parts = [line(r.randint(1, 30)) for _ in range(r.randint(1, 6))]
        parts.insert(r.randint(0, len(parts)), r.choice(shared))
        rows.append((i, "\n".join(parts), r.choice(["en", "fr", None]), f"s{i % 3}", i))
    base = rows[5][1]
    rows += [(n + k, base, "en", "s0", 1) for k in range(8)]
    rows += [(n + 20 + k, base + " tail" * k, "en", "s0", 1) for k in range(6)]
    rows += [(n + 30, None, None, None, None), (n + 31, "", "en", "s1", 0), (n + 32, "  \n\t ", "en", "s1", 4),
             (n + 33, "ab" * 400, "en", "s1", 800), (n + 34, "x" * 999, "en", "s1", 999),
             (n + 35, shared[0].upper() + "\n" + shared[0] + "\n\n", "en", "s1", 9),
             (n + 36, "\n".join(line(20) for _ in range(300)), "en", "s1", 1), (None, base, "en", "s1", 1),
             (3, rows[3][1], "en", "s0", 3), (4, "another text under an id that is used", "en", "s0", 3)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)
