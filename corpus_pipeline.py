"""The corpus pipeline: five of the training-data operators, one after the other."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm import bpe, decontaminate, line_dedup, simhash, toxicity
from forecourt.llm.common import aside, restored, table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fits on the labels of the documents at hand and keeps those scored under 0.7."""
    model = toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"),
                         toxicity.fold(3) != 1)
    plain, own = aside(docs, "toxicity", "passages")
    return restored(toxicity.score(plain, model).where("toxicity < 0.7").drop("toxicity", "passages"), own, docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 40 code points or more that 5 documents share stay in the last of them."""
    return _documents(line_dedup.dedup_lines(docs.select(*COLUMNS)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the smallest doc_id."""
    return simhash.dedup(docs, shingle=3, radius=2)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of ten words or more of the benchmark leave the texts."""
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    return _documents(decontaminate.decontaminate(docs.select(*COLUMNS), items, window=10))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digests that show the round trip."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(bpe.encode(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN, "decoded"), "ids")


STAGES = [("toxicity", reject_toxic), ("line dedup", drop_lines), ("simhash near-dedup", drop_near_duplicates),
          ("benchmark decontamination", drop_benchmark), ("byte-level bpe", tokenize)]

#: Models, hashes and automata have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
