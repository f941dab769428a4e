"""The pipeline's stages against the operators' brute-force versions."""

from pyspark.sql import functions as F

import corpus_pipeline
from forecourt.llm import toxicity
from tests.llm.fixtures import documents, frame
from tests.llm.test_decontaminate import _words
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_native import brute_lines
from tests.llm.test_simhash import brute_fingerprint, brute_groups

SF = "/root/testdata/sf0.001"


def _stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "simhash near-dedup",
                                                      "benchmark decontamination", "byte-level bpe"]


def test_run_is_the_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256").collect()
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name != "byte-level bpe":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    assert sorted(out) == sorted(docs.select("doc_id", "n_tokens", "ids_sha256").collect())
    assert 0 < len(out) < spark.read.parquet(f"{SF}/documents.parquet").count()


def test_toxic_documents_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), toxicity.fold(3) != 1)
    want = {r.doc_id for r in docs.collect() if model.probability(model.evidence(*model.segments(r.text))) < 0.7}
    assert {r.doc_id for r in _stage("toxicity")(spark, docs, "/root/testdata/sf0.01").collect()} == want


def test_lines_copies_and_passages(spark):
    rows = [r for r in documents() if r[0] is not None and r[0] not in (3, 4)]
    got = {r.doc_id: r.text for r in _stage("line dedup")(spark, frame(spark, rows), SF).collect()}
    assert got == {d: t for d, _, _, t in brute_lines(rows)}
    fps = {d: brute_fingerprint(t) for d, t, *_ in rows}
    group = brute_groups(list(fps.values()))
    want = {min(i for i, g in fps.items() if g in group[f]) for f in fps.values()}
    assert {r.doc_id for r in _stage("simhash near-dedup")(spark, frame(spark, rows), SF).collect()} == want
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 300")
    texts = {r.doc_id: r.text for r in docs.collect()}
    hits = {d: (n, h) for d, n, h, _ in brute_hits(list(texts.items()), items)}
    out = {r.doc_id: r.text for r in _stage("benchmark decontamination")(spark, docs, SF).collect()}
    assert set(out) == {d for d, (n, h) in hits.items() if not h or len(h) <= 0.8 * n}
    for d, t in out.items():
        if hits[d][1]:
            assert _words(t) == [w for i, w in enumerate(_words(texts[d])) if i not in hits[d][1]]
        else:
            assert t == texts[d]


def test_empty_and_clashing_columns(spark):
    odd = frame(spark, documents()).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        odd = stage(spark, odd, SF)
        assert odd.count() == 0
    more = frame(spark, documents()).withColumn("toxicity", F.lit(1)).withColumn("ids", F.lit(1))
    assert _stage("toxicity")(spark, more, SF).columns == more.columns
