"""Line dedup: lines that many documents share stay in one document only.

Lines become 128-bit hashes with (document, position), stored once: texts are split and
hashed a single time.  The hashes are range-partitioned by (hash, document descending)
and sorted by position within, so the rows of a very common line spread over many
partitions; each (hash, document) run is read off in order, first the document that
keeps the line, as words of 64 line bits.  The runs are stored too; the number of
documents and the keeper of a hash are partial aggregates over them.  What comes back
per document is a compressed keep bitmap: 64 lines to a word, words without a dropped
line left out.  Only DataFrame expressions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import ordered_id, row_key, written

#: White space that is stripped from a line for its key.
STRIPPED = " \t\n\x0b\x0c\r"
#: Parts that the runs of one hash are joined in.
SALTS = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text):
    """Lines of a text column; null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line):
    return F.translate(F.btrim(line, F.lit(STRIPPED)), UPPER, LOWER)


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(_id, _row, words, n_dropped) of every document that loses lines.

    ``words`` is an array of (word, bits): bit b of word w is set when line
    64 * w + b is dropped.  A key of at least ``min_chars`` code points found in at
    least ``min_docs`` documents loses its lines except in the largest doc_id.
    Rows with one doc_id count as one document (a null doc_id is the smallest).
    """
    line = (docs.select(ordered_id().alias("_id"), row_key().alias("_row"),
                        F.posexplode(lines_of(F.col("text"))).alias("_pos", "_line"))
            .withColumn("_key", line_key(F.col("_line")))
            .where(F.char_length("_key") >= min_chars)
            .select(F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit("line"), "_key").alias("_h2"),
                    "_id", "_row", "_pos"))
    ranged = (written(line, "line-hashes").repartitionByRange("_h1", "_h2", F.col("_id").desc(), "_row")
              .sortWithinPartitions("_h1", "_h2", F.col("_id").desc(), "_row", "_pos"))
    runs = written(ranged.groupBy("_h1", "_h2", "_id", "_row", F.expr("_pos div 64").alias("word"))
                   .agg(F.bit_or(F.expr("shiftleft(1L, _pos % 64)")).alias("bits")), "line-runs")
    per_document = runs.select("_h1", "_h2", "_id").distinct()
    shared = (per_document.groupBy("_h1", "_h2").agg(F.count("*").alias("_n"), F.max("_id").alias("_keeper"))
              .where(F.col("_n") >= min_docs).drop("_n"))
    # The keepers of a hash go to every salt, so a very common line is joined in SALTS tasks.
    salted = shared.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dropped = (runs.withColumn("_salt", F.pmod(F.xxhash64("_id", "_row"), F.lit(SALTS)).cast("int"))
               .join(salted, ["_h1", "_h2", "_salt"]).where(F.col("_id") != F.col("_keeper")))
    words = dropped.groupBy("_id", "_row", "word").agg(F.bit_or("bits").alias("bits"))
    return (words.groupBy("_id", "_row")
            .agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"),
                 F.sum(F.bit_count("bits")).cast("long").alias("n_dropped")))


def dropped_positions(words):
    """Line numbers whose bit is set in a bitmap column."""
    return F.flatten(F.transform(words, lambda w: F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.call_function("bit_get", w["bits"], b) == 1),
        lambda b: (w["word"] * 64 + b).cast("int"))))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """All rows of ``docs`` with text replaced by the lines that stay, joined by a
    line feed, and n_lines, n_dropped, keep_words (the bitmap) added.

    Null or empty text: one empty line, nothing dropped, text ''.  Repeated rows get
    equal results.  Other columns are kept; an input column named like an added one
    is replaced."""
    extra = [c for c in docs.columns if c in ("n_lines", "n_dropped", "keep_words", "_id", "_row")]
    base = docs.drop(*extra)
    bits = keep_bitmaps(base, min_chars, min_docs).withColumnRenamed("words", "keep_words")
    keyed = base.withColumn("_id", ordered_id()).withColumn("_row", row_key())
    joined = keyed.join(bits, ["_id", "_row"], "left").withColumn("_lines", lines_of(F.col("text")))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), dropped_positions(F.col("keep_words")))
    kept = F.when(F.col("keep_words").isNull(), F.coalesce("text", F.lit(""))).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n"))
    return (joined.withColumn("n_lines", F.size("_lines").cast("long"))
            .withColumn("n_dropped", F.coalesce("n_dropped", F.lit(0)).cast("long"))
            .withColumn("_kept", kept)
            .select(*[F.col("_kept").alias("text") if c == "text" else F.col(c) for c in base.columns],
                    "n_lines", "n_dropped", "keep_words"))
