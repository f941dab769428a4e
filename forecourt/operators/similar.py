"""Cosine similarity of texts without comparing all pairs (STR-27, SRT-02).

Texts with the same words are one bag; similarity is computed between distinct
bags and handed to their members.  The best ``k`` come from an inverted index with
upper bounds: the words of a query bag are looked up from the rarest on, and a text
that shares none of the words looked up so far cannot be nearer than the length of
what is left of the query's unit vector.  A query stops when that is below its
k-th best.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.session import materialize


def bags(df: DataFrame, id_col: str, tokens_col: str) -> DataFrame:
    """(id, bag): the sorted words of a text as its bag's name; texts without words have none."""
    named = F.array_join(F.array_sort(F.filter(F.col(tokens_col), lambda t: t.isNotNull())), " ")
    return df.select(F.col(id_col), named.alias("bag")).where("bag <> ''")


def vectors(members: DataFrame) -> DataFrame:
    """(bag, words: map of word to count, size2: squared length) of distinct bags."""
    words = members.select("bag").distinct().select("bag", F.explode(F.split("bag", " ")).alias("word"))
    counts = words.groupBy("bag", "word").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("bag").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("words"),
                                     F.sum(F.col("n") * F.col("n")).alias("size2"))


def _dot(a, b):
    return F.aggregate(F.map_entries(a), F.lit(0).cast("long"), lambda s, e: s + e["value"] * F.coalesce(b[e["key"]], F.lit(0).cast("long")))


def cosine_pairs(a: DataFrame, b: DataFrame, a_id: str, b_id: str, tokens_col: str = "tokens") -> DataFrame:
    """(a_id, b_id, cosine) of every text of ``a`` with the texts of ``b`` that share a word:
    computed once for each pair of distinct bags."""
    ma, mb = bags(a, a_id, tokens_col), bags(b, b_id, tokens_col)
    va, vb = vectors(ma), vectors(mb)
    one = va.select(F.col("bag").alias("_a"), F.explode("words").alias("word", "na"), F.col("size2").alias("sa"))
    two = vb.select(F.col("bag").alias("_b"), F.explode("words").alias("word", "nb"), F.col("size2").alias("sb"))
    dot = one.join(two, "word").groupBy("_a", "_b", "sa", "sb").agg(F.sum(F.col("na") * F.col("nb")).alias("dot"))
    cos = dot.select("_a", "_b", (F.col("dot") / F.sqrt(F.col("sa") * F.col("sb"))).alias("cosine"))
    return (ma.withColumnRenamed("bag", "_a").join(cos, "_a").join(mb.withColumnRenamed("bag", "_b"), "_b")
            .select(a_id, b_id, "cosine"))


def top_k(a: DataFrame, b: DataFrame, a_id: str, b_id: str, k: int = 5, tokens_col: str = "tokens",
          digits: int = 6) -> tuple[DataFrame, dict[str, int]]:
    """(a_id, b_id, cosine, rank): the ``k`` texts of ``b`` nearest to each of ``a`` among those
    that share a word, by cosine rounded to ``digits``, ties to the smaller b_id; and the
    numbers of pairs of bags compared and possible.  Exact: equal to comparing all."""
    from forecourt.functions.fmt import rnd
    ma, mb = bags(a, a_id, tokens_col), bags(b, b_id, tokens_col)
    nearest_first = Window.partitionBy("bag").orderBy(b_id)
    kept = mb.withColumn("_r", F.row_number().over(nearest_first)).where(F.col("_r") <= k).drop("_r")  # k members of a bag do
    first = mb.groupBy("bag").agg(F.min(b_id).alias("_first"))
    vb = materialize(vectors(mb).join(first, "bag"), "checkpoint").select(F.col("bag").alias("_b"), F.col("words").alias("wb"), F.col("size2").alias("sb"), "_first")
    postings = vb.select("_b", F.explode(F.map_keys("wb")).alias("word"))
    common = postings.groupBy("word").agg(F.count(F.lit(1)).alias("_df"))
    va = vectors(ma)
    order = Window.partitionBy("_a").orderBy("_df", "word")
    terms = (va.select(F.col("bag").alias("_a"), "words", "size2", F.explode("words").alias("word", "n")).join(common, "word", "left")
             .na.fill(0, ["_df"]).withColumn("_at", F.row_number().over(order))
             .withColumn("_used", F.sum(F.col("n") * F.col("n")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    queries = terms.groupBy("_a", "words", "size2").agg(F.sort_array(F.collect_list(F.struct("_at", "word", "_used"))).alias("terms"))
    queries = materialize(queries.select("_a", F.col("words").alias("wa"), F.col("size2").alias("sa"), "terms"), "checkpoint")
    active, best, pairs, low, high = queries, None, 0, 0, 1
    best_first = Window.partitionBy("_a").orderBy(F.desc("cosine"), "_first")
    while True:
        step = active.select("_a", "wa", "sa", F.transform("terms", lambda t: t["word"]).alias("_order"), F.explode(F.slice("terms", low + 1, high - low)).alias("t"))
        met = step.select("_a", "wa", "sa", "_order", F.col("t._at").alias("_at"), F.col("t.word").alias("word")).join(postings, "word").join(vb, "_b")
        # A pair is compared at the first of the query's words that both have.
        new = met.where(~F.exists(F.slice("_order", F.lit(1), F.col("_at") - 1), lambda w: F.array_contains(F.map_keys("wb"), w)))
        cosine = rnd(_dot(F.col("wa"), F.col("wb")) / F.sqrt(F.col("sa") * F.col("sb")), digits)
        scored = materialize(new.select("_a", "_b", "_first", cosine.alias("cosine")), "checkpoint")
        pairs += scored.count()
        found = scored if best is None else best.unionByName(scored)
        best = materialize(found.withColumn("_r", F.row_number().over(best_first)).where(F.col("_r") <= k).drop("_r"), "checkpoint")
        worst = best.groupBy("_a").agg(F.count(F.lit(1)).alias("_m"), F.min("cosine").alias("_k"))
        left = F.sqrt(1 - F.element_at("terms", F.lit(high))["_used"] / F.col("sa"))
        more = active.where(F.size("terms") > high).join(worst, "_a", "left")
        active = materialize(more.where((F.coalesce("_m", F.lit(0)) < k) | (left + 10.0 ** -digits >= F.col("_k"))).drop("_m", "_k"), "checkpoint")
        if active.isEmpty():
            break
        low, high = high, 2 * high + 1
    members = (ma.withColumnRenamed("bag", "_a").join(best.drop("_first"), "_a")
               .join(kept.withColumnRenamed("bag", "_b"), "_b").select(a_id, b_id, "cosine"))
    ranked = members.withColumn("rank", F.row_number().over(Window.partitionBy(a_id).orderBy(F.desc("cosine"), b_id))).where(F.col("rank") <= k)
    return ranked, {"compared": pairs, "possible": queries.count() * vb.count()}
