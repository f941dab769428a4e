"""Language of a request (STR-17): character trigrams of words, learned from
labelled rows and scored by joins.

A word with a space on either side gives its trigrams.  A language learns from the
counts of its words, so a trigram is made once a distinct word; a text is scored
where its words are read, against the broadcast profile and the sums of the
commonest words, and its sums leave the task as one row.  A language scores the whole milli-nats of its smoothed trigram
frequencies, so sums do not depend on their order.  The profile is a table with a
row a trigram.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.session import materialize

MOST_LANGUAGES = 1000


#: A profile of up to so many trigrams is broadcast, with the scores of so many common words.
MOST_GRAMS, COMMON_WORDS = 300_000, 100_000


def _words(df: DataFrame, key: str, text_col: str) -> DataFrame:
    """(key, _w): the letter runs of a text, lower case, a row each."""
    return df.select(key, F.explode(F.regexp_extract_all(F.lower(F.coalesce(text_col, F.lit(""))), F.lit(r"\p{L}+"), F.lit(0))).alias("_w"))


def _grams() -> Column:
    """The trigrams of the word ``_w``."""
    padded = F.concat(F.lit(" "), F.col("_w"), F.lit(" "))
    return F.transform(F.sequence(F.lit(1), F.char_length("_w")), lambda i: F.substring(padded, i, 3))


def trigrams(df: DataFrame, key: str, text_col: str) -> DataFrame:
    """(key, gram, n): the trigrams of the letter runs of all texts of a key.  Words are counted
    first, so a trigram is made once a distinct word."""
    return _counted_grams(_words(df, key, text_col).groupBy(key, "_w").agg(F.count(F.lit(1)).alias("_n")), key)


def _counted_grams(words: DataFrame, key: str) -> DataFrame:
    return words.select(key, "_n", F.explode(_grams()).alias("gram")).groupBy(key, "gram").agg(F.sum("_n").alias("n"))


@dataclass
class Profiles:
    """``scores``: gram and an array of milli-nats, one a language; ``unseen``: of a gram that no
    training text holds; ``words``: the same sums for the commonest whole words."""
    languages: list[str]
    scores: DataFrame
    unseen: list[int]
    words: DataFrame | None = None


def learn(train: DataFrame, id_col: str, text_col: str, lang_col: str) -> Profiles:
    """Profiles of the languages of ``train``; rows without one are left out.  Languages become
    array places, so more than ``MOST_LANGUAGES`` are an error."""
    rows = train.where(F.col(lang_col).isNotNull())
    words = _words(rows.withColumnRenamed(lang_col, "lang"), "lang", text_col).groupBy("lang", "_w").agg(F.count(F.lit(1)).alias("_n"))
    words = materialize(words, "checkpoint")
    counts = _counted_grams(words, "lang").withColumnRenamed("n", "c").persist()
    sums = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("c").alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(sums) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not sums:
        return Profiles([], train.sparkSession.createDataFrame([], "gram string, score array<bigint>"), [])
    languages, grams = sorted(sums), counts.select("gram").distinct().count()

    def milli(c, lang):
        return F.floor(F.log((c + 1).cast("double") / F.lit(float(sums[lang] + grams))) * 1000)
    wide = counts.groupBy("gram").agg(*[F.coalesce(F.max(F.when(F.col("lang") == x, F.col("c"))), F.lit(0)).alias(f"c{i}") for i, x in enumerate(languages)])
    scores = wide.select("gram", F.array(*[milli(F.col(f"c{i}"), x) for i, x in enumerate(languages)]).alias("score"))
    one = train.sparkSession.range(1).select(*[milli(F.lit(0), x).alias(f"u{i}") for i, x in enumerate(languages)]).first()
    scores = materialize(scores, "checkpoint")
    common = words.groupBy("_w").agg(F.sum("_n").alias("_n")).orderBy(F.desc("_n"), "_w").limit(COMMON_WORDS)
    whole = common.select("_w", F.explode(_grams()).alias("gram")).join(scores, "gram").groupBy("_w").agg(
        F.array(*[F.sum(F.col("score")[i]) for i in range(len(languages))]).alias("_whole"))
    return Profiles(languages, scores, [int(x) for x in one], materialize(whole, "checkpoint"))


def detect(df: DataFrame, id_col: str, text_col: str, profiles: Profiles, out: str = "detected", undefined: str = "Undefined") -> DataFrame:
    """(id, out): the language of the highest score, ties to the first in order; ``undefined`` for
    texts without a letter and without profiles.  Rows with one id are one text."""
    ids = df.select(id_col).distinct()
    if not profiles.languages:
        return ids.withColumn(out, F.lit(undefined))
    unseen = F.array(*[F.lit(u).cast("long") for u in profiles.unseen])
    if profiles.words is not None and profiles.scores.count() <= MOST_GRAMS:
        # Common words are scored whole, the others by their trigrams.
        known = _words(df, id_col, text_col).join(F.broadcast(profiles.words), "_w", "left")
        parts = F.when(F.col("_whole").isNull(), _grams()).otherwise(F.array(F.lit(None).cast("string")))
        met = known.select(id_col, "_whole", F.lit(1).cast("long").alias("n"), F.explode(parts).alias("gram"))
        met = met.join(F.broadcast(profiles.scores), "gram", "left").withColumn("score", F.coalesce("_whole", "score"))
    else:
        met = trigrams(df, id_col, text_col).join(profiles.scores, "gram", "left")
    met = met.withColumn("score", F.coalesce("score", unseen))
    total = met.groupBy(id_col).agg(*[F.sum(F.col("n") * F.col("score")[i]).alias(f"s{i}") for i in range(len(profiles.languages))])
    best = F.array_max(F.array(*[F.struct(F.col(f"s{i}").alias("s"), F.lit(-i).alias("i")) for i in range(len(profiles.languages))]))
    named = total.select(id_col, F.element_at(F.array(*[F.lit(x) for x in profiles.languages]), 1 - best["i"]).alias(out))
    return ids.join(named, id_col, "left").withColumn(out, F.coalesce(out, F.lit(undefined)))
