"""Ids that many rows share: a third of a table, copies, unusable copies."""

from pyspark.sql import functions as F

from forecourt.llm import ann, language, simhash, toxicity
from tests.llm.fixtures import documents, frame


def test_near_duplicates_keep_one_row_of_each_group(spark):
    t, u = documents()[5][1], documents()[6][1] + " and something else entirely"
    rows = [(i, x, "en", "s", 0) for i, x in ((1, t), (1, t), (3, t), (7, t), (7, u), (9, u), (None, None), (4, ""), (4, ""))]
    kept = simhash.dedup(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted([(1, t), (7, u), (None, None)], key=repr)
    clash = frame(spark, rows).withColumn("_row", F.lit("x")).withColumn("group", F.lit(1))
    out = simhash.dedup(clash).collect()
    assert len(out) == 3 and {r["_row"] for r in out} == {"x"} and {r["group"] for r in out} == {1}


def test_a_query_is_asked_by_its_usable_rows(spark):
    rows = [(100, [0.0, 0.0]), (100, [1.0, 0.0]), (100, [None, 1.0]), (1, [1.0, 1.0]), (2, [2.0, 1.0]), (200, [0.0, 0.0]), (200, None)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.nearest(v, v.where("vec_id % 100 = 0")).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(100, 1, 1), (100, 2, 2)]


def test_language_sample_is_bounded_in_rows(spark, monkeypatch):
    rows = [(i, f"plain words number {i} of a text", "en", "s", 0) for i in range(40)] + [(7, f"le texte numero {i}", "fr", "s", 0) for i in range(400)]
    rows += [(1000 + i, f"autres mots du texte {i}", "fr", "s", 0) for i in range(40)]
    seen = []
    monkeypatch.setattr(language, "train", lambda langs, win, y: seen.append((langs, len(win))))
    language.fit(frame(spark, rows), F.lit(True), per_lang=10)
    assert seen == [(["en", "fr"], 20)]


def test_toxicity_sample_is_bounded_in_rows(spark):
    rows = [(i, f"text {i} with word{i % 3}", "en", "s", 0) for i in range(60)] + [(7, f"copy {i}", "en", "s", 0) for i in range(500)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    sample = toxicity.labelled_sample(frame(spark, rows), labels, F.lit(True), 1000)
    ids = [r.doc_id for r in sample.collect()]
    assert len(ids) == len(set(ids)) == 59 and 7 not in ids
