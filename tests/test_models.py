"""Model search, silhouettes, language profiles and job chains."""

import json

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from forecourt import session
from forecourt.operators import langid, ml, search
from tests.conftest import SF


def labelled(spark, classes, n=240):
    r = np.random.default_rng(classes)
    rows = [(i, [float(x) for x in r.normal(3.0 * (i % classes), 1.0, 3)], float(i % classes)) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, x array<double>, label double")
    return df.select("id", array_to_vector("x").alias("features"), "label").repartition(4)


SMALL = {"dt": {"minInstancesPerNode": [3], "maxDepth": [2, 4]}, "rf": {"numTrees": [5], "maxDepth": [3]}, "lr": {"C": [1.0], "maxIter": [20]},
         "svm": {"C": [1.0], "maxIter": [5]}, "gc": {"maxIter": [2]}, "bayes": {}, "ann": {"hidden": [(5, 5)], "maxIter": [30]}}


def test_published_grids_are_the_defaults():
    assert search.FOLDS == 10 and search.FOLDS_TEXT == 3
    assert {n: len(search.points(g)) for n, g in search.CLASSIFIER_GRIDS.items()} == {"dt": 24, "rf": 21, "lr": 20, "svm": 10, "gc": 10, "bayes": 1, "ann": 1}
    assert search.classifiers.__defaults__[1] == 10 and len(search.points(search.REGRESSOR_GRIDS["rf"])) == 30


def test_search_of_all_classifiers_and_the_vote(spark):
    df = labelled(spark, 3)
    tr, te = df.where("id % 4 <> 0"), df.where("id % 4 = 0")
    found = search.classifiers(tr, "id", ml.eval_f1("label"), SMALL, 2)
    assert [f.name for f in found] == list(SMALL)
    assert all(f.score > 0.7 and f.seconds > 0 for f in found if f.name != "gc")
    assert found[0].params in search.points(SMALL["dt"]) and len(found[1].importances) == 3
    assert {n for n in search.voters(found, te)} == {"dt", "rf", "lr", "bayes", "ann"}
    vote = ml.soft_vote(search.voters(found, te.withColumnRenamed("id", "vec_id")), "vec_id")
    right = vote.join(te, vote["vec_id"] == te["id"]).where(F.col("prediction") == F.col("label")).count()
    assert right > 0.8 * te.count()
    res = search.classification_results(found[:3], {"train": tr, "test": te}).collect()
    assert len(res) == 6 and all(0 <= x.accuracy <= 1 and x.roc_auc is None and x.params for x in res)
    assert json.loads(next(x for x in res if x.model == "rf").importances) == found[1].importances


def test_two_class_results_and_folds(spark):
    df = labelled(spark, 2, 120)
    found = search.classifiers(df, "id", ml.eval_f1("label"), {"lr": {"C": [1.0], "maxIter": [10]}}, 2)
    r = search.classification_results(found, {"all": df}).first()
    assert r.roc_auc > 0.95 and r.accuracy == pytest.approx(r.f1_micro)
    a, b = (sorted((x.id, x.fold) for x in search.with_folds(d, "id", 5).collect()) for d in (df, df.repartition(2)))
    assert a == b and {f for _, f in a} == {0, 1, 2, 3, 4}


def test_regressors(spark):
    r = np.random.default_rng(1)
    rows = [(i, [float(v) for v in x], float(x @ [1.0, -2.0, 0.0])) for i, x in enumerate(r.normal(size=(150, 3)))]
    df = spark.createDataFrame(rows, "id long, x array<double>, label double").select("id", array_to_vector("x").alias("features"), "label")
    grids = {"ridge": {"regParam": [1e-6]}, "lasso": {"regParam": [1e-4]}, "rf": {"maxDepth": [3], "numTrees": [5]}}
    res = {x.model: x for x in search.regression_results(search.regressors(df, "id", ml.eval_rmse("label"), grids, 2), {"all": df}).collect()}
    assert res["ridge"].r2 > 0.999 and res["lasso"].r2 > 0.99 and 0 < res["rf"].r2 < 1


def test_silhouettes_match_the_definition(spark):
    r = np.random.default_rng(2)
    x = np.vstack([r.normal(c, 1.0, (20, 2)) for c in (0, 4, 9)] + [[[50.0, 50.0]]])
    k = [0] * 20 + [1] * 20 + [2] * 20 + [3]
    df = spark.createDataFrame([(i, [float(a) for a in v], c) for i, (v, c) in enumerate(zip(x, k))], "id int, x array<double>, prediction int")
    got = {q.id: q.silhouette for q in ml.silhouettes(df.withColumn("features", array_to_vector("x")), "features").collect()}
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    for i in range(len(x)):
        mean = {c: d[i, [j for j in range(len(x)) if k[j] == c and j != i]].mean() for c in set(k) if any(k[j] == c and j != i for j in range(len(x)))}
        own, other = mean.pop(k[i], None), min(mean.values())
        assert got[i] == pytest.approx(0.0 if own is None else (min(mean.values()) - own) / max(own, other), abs=1e-9)


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    profiles = langid.learn(docs.where("doc_id % 4 <> 0"), "doc_id", "text", "lang")
    out = langid.detect(docs, "doc_id", "text", profiles).join(docs, "doc_id").where("doc_id % 4 = 0 AND lang IS NOT NULL AND detected <> 'Undefined'").collect()
    assert len(out) > 200 and np.mean([x.detected == x.lang for x in out]) > 0.95
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !")], "doc_id long, text string")
    assert {x.detected for x in langid.detect(odd, "doc_id", "text", profiles).collect()} == {"Undefined"}
    assert {x.detected for x in langid.detect(odd, "doc_id", "text", langid.learn(docs.limit(0), "doc_id", "text", "lang")).collect()} == {"Undefined"}


def test_job_chains_run_to_their_sinks(spark):
    from forecourt.plans import all_queries
    q = all_queries()
    parts = q["job_06_part_families"](spark, SF).collect()
    assert len(parts) == spark.read.parquet(f"{SF}/part.parquet").count()
    assert all(p.New_Prediction_95 for p in parts)
    labels = q["job_08_service_desk_labels"](spark, SF).collect()
    assert labels and all(x.label and x.label != "Undefined" for x in labels if x.Classification_Flag == 1)
    sections = {x.section for x in q["job_11_retail_evaluation"](spark, SF).collect()}
    assert {"result", "auc", "frame", "choice"} <= sections


def test_language_scores_are_the_same_by_words_and_by_trigrams(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").repartition(3)
    found = lambda: sorted(map(tuple, langid.detect(docs, "doc_id", "text", langid.learn(docs.where("doc_id % 4 <> 0"), "doc_id", "text", "lang")).collect()))
    one = found()
    monkeypatch.setattr(langid, "COMMON_WORDS", 20)
    two = found()
    monkeypatch.setattr(langid, "MOST_GRAMS", 0)
    assert one == two == found() and len(one) == docs.count()


def test_texts_are_scored_without_a_row_a_trigram_in_the_shuffle(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    plan = langid.detect(docs, "doc_id", "text", langid.learn(docs, "doc_id", "text", "lang"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [doc_id" in plan and not any("gram" in x.split("]")[0] for x in plan.splitlines() if "Aggregate [" in x)


def test_result_rows_need_no_python_worker(spark):
    rows = [(1, None, "a"), (2, float("nan"), None)]
    got = session.few_rows(spark, rows, "k int, x double, s string")
    assert got.dtypes == [("k", "int"), ("x", "double"), ("s", "string")]
    assert [(r.k, r.s) for r in got.orderBy("k").collect()] == [(1, "a"), (2, None)] and got.where("isnan(x)").count() == 1
    df = labelled(spark, 2, 40).select("features")
    scan = ml.kmeans_scan(df, "features", [2], restarts=1)
    assert "PythonRDD" not in scan._jdf.queryExecution().toRdd().toDebugString()


def test_labels_are_broadcast_never_the_rows(spark, tmp_path):
    from forecourt.plans.ml import labelled_parts
    rows = [(i, f"name {i % 5}", ["PROMO", "SMALL", "ECONOMY", None][i % 4], i % 7, float(i)) for i in range(40)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    got = labelled_parts(spark, str(tmp_path))
    assert {(r.p_type, r.label) for r in got.collect()} == {("PROMO", 0.0), ("SMALL", 1.0), ("ECONOMY", 2.0)} and got.count() == 30
    plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")
    assert "BuildRight" in plan and "BuildLeft" not in plan  # the labels are on the right
