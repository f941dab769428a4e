"""The registered queries of the operators: each applies its operator to the
whole table with production parameters and derives the result's digest columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm import (ann, bpe, decontaminate, html_text, language, line_dedup, mixing, resample, sharding, simhash,
                           suffix_dedup, toxicity, whitening)
from forecourt.llm.common import table


def _hex(col):
    return F.sha2(col.cast("binary"), 256)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(table(spark, sf_dir, "documents", "doc_id", "text"),
                                      table(spark, sf_dir, "benchmark", "item_id", "text"))
    names = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      _hex(names).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", _hex(F.col("text")).alias("kept_sha256"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return ann.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    net = language.fit(docs, toxicity.fold(4) != 2)
    out = language.predict(docs.select("doc_id", "text"), net)
    return out.select("doc_id", (toxicity.fold(4) == 2).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_text.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents", "doc_id", "text"), path, public_tokenizers.PATTERN, "decoded"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"), toxicity.fold(3) != 1)
    out = toxicity.score(docs, model)
    return out.select("doc_id", (toxicity.fold(3) == 1).alias("held_out"), F.col("toxicity").alias("score"),
                      (F.col("toxicity") >= 0.7).cast("int").alias("predicted"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents", "doc_id", "text"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return out.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components_of(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    taken = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["n"])
    return out.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    scored = resample.score(docs, resample.gains(docs, table(spark, sf_dir, "benchmark", "text")))
    return resample.draw(scored).select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_line_dedup, op3_neighbours, op4_language, op5_html_text, op6_bpe, op7_toxicity,
    op8_suffix_dedup, op9_sharding, op10_simhash, op11_whitening, op12_mixing, op13_resampling)}

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL: dict[str, str] = {
    "op1_decontamination": f"""
WITH items AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(ws[i:i + size - 1], ' ') AS w
  FROM (SELECT item_id, ws, least(len(ws), 10) AS size, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i
        FROM items WHERE len(ws) > 0)),
docs AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
grams AS (
  SELECT doc_id, size, i, array_to_string(ws[i:i + size - 1], ' ') AS w
  FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
        FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(ws) >= size)),
found AS (SELECT doc_id, i, g.size, item_id FROM grams g JOIN windows USING (size, w)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id),
got AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
        FROM found GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN got USING (doc_id)""",
    "op2_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_LETTERS}) AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents)),
shared AS (SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT doc_id, pos, line, keeper IS NOT NULL AND keeper <> doc_id AS dropped FROM lines LEFT JOIN shared USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op13_resampling": rf"""
WITH RECURSIVE steps(i, c, k) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT i, c FROM steps WHERE k = 8),
docs AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
doc_words AS (SELECT w, count(*) AS n FROM (SELECT unnest(ws) AS w FROM docs) GROUP BY w),
item_words AS (SELECT w, count(*) AS n FROM (SELECT unnest({_WORDS}) AS w FROM benchmark) GROUP BY w),
read(w, h, p, c) AS (
  SELECT w, hex(encode(w)), 0, 4294967295 FROM (SELECT w FROM doc_words UNION SELECT w FROM item_words)
  UNION ALL SELECT w, h, p + 1, xor(read.c >> 8, crc.c)
  FROM read JOIN crc ON crc.i = xor(read.c & 255, ('0x' || substr(h, 2 * p + 1, 2))::BIGINT) WHERE 2 * p < length(h)),
bucket AS (SELECT w, xor(c, 4294967295) % 10000 AS b FROM read WHERE 2 * p = length(h)),
s AS (SELECT b, sum(n) AS n FROM doc_words JOIN bucket USING (w) GROUP BY b),
t AS (SELECT b, sum(n) AS n FROM item_words JOIN bucket USING (w) GROUP BY b),
gain AS (
  SELECT b, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE
                           / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS g
  FROM (SELECT DISTINCT b FROM bucket) LEFT JOIN s USING (b) LEFT JOIN t USING (b)),
summed AS (SELECT doc_id, sum(g)::BIGINT AS total FROM (SELECT doc_id, unnest(ws) AS w FROM docs) JOIN bucket USING (w) JOIN gain USING (b)
           GROUP BY doc_id),
weighed AS (
  SELECT doc_id, len(ws)::BIGINT AS n_features,
         CASE WHEN len(ws) = 0 THEN 0 ELSE (total - ((total % len(ws)) + len(ws)) % len(ws)) // len(ws) END::BIGINT AS weight,
         ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h
  FROM docs LEFT JOIN summed USING (doc_id)),
scored AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM weighed),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END::BIGINT AS rank
FROM scored LEFT JOIN ranked USING (doc_id)""",
}
