"""Queries that do their whole job: rows made here, against direct computation."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

import __spark_entry__ as E
from forecourt.operators import ml, search
from forecourt.plans import jobs_chains


def test_every_pair_of_texts_has_its_similarity(spark, tmp_path):
    rows = [(1, "red car", "SMALL", "Brand#1"), (2, "car red", "SMALL", "Brand#1"), (3, None, None, "Brand#1"), (4, "blue", "PROMO", "Brand#1"),
            (11, "red car", "SMALL", "Brand#2"), (12, "small red", "car", "Brand#3"), (13, "red red van", "LARGE", "Brand#2"), (14, "red", "car", None)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_type string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    bags = {k: Counter(f"{n or ''} {t or ''}".lower().split()) for k, n, t, _ in rows}
    cos = lambda p, q: sum(n * q[w] for w, n in p.items()) / math.sqrt(sum(n * n for n in p.values()) * sum(n * n for n in q.values()))
    old, new = [r[0] for r in rows if r[3] == "Brand#1"], [r[0] for r in rows if r[3] not in ("Brand#1", None)]
    want = {(a, b): round(cos(bags[a], bags[b]), 6) for a in old for b in new if set(bags[a]) & set(bags[b])}
    df = E.queries()["str_27_cosine_similarity"](spark, str(tmp_path))
    assert df.columns == ["old_key", "new_key", "cosine"]
    got = {(r.old_key, r.new_key): r.cosine for r in df.collect()}
    assert got == want and {(1, 11), (1, 12), (2, 11), (2, 12)} <= set(got)


def numbers(spark, n=90):
    r = np.random.default_rng(6)
    rows = [(i, [float(v) for v in x], float(x @ [1.0, -2.0]) + float(r.normal()), float(x[0] > 0.2)) for i, x in enumerate(r.normal(size=(n, 2)))]
    return spark.createDataFrame(rows, "id long, x array<double>, y double, c double").select("id", array_to_vector("x").alias("features"), "y", "c").repartition(3)


@pytest.mark.parametrize("kind", ["regression", "classification"])
def test_points_that_share_a_fit_score_as_fits_of_their_own(spark, kind):
    df = numbers(spark)
    if kind == "regression":
        df, evaluator, make = df.select("id", "features", F.col("y").alias("label")), ml.eval_rmse("label"), search._regressor
        grids = {"xgb": {"maxDepth": [2], "maxIter": [2, 5]}, "lasso": {"regParam": [1e-3], "maxIter": [1, 50, 90]}}
    else:
        df, evaluator, make = df.select("id", "features", F.col("c").alias("label")), ml.eval_f1("label"), lambda n, p: search._classifier(n, 90, 2, 2, None, p)
        grids = {"gc": {"maxIter": [1, 4]}}
    held = search._held(search.with_folds(df, "id", 2), 90)
    for name, grid in grids.items():
        for chain in search._chains(search.points(grid)):
            for i in range(2):
                train, rest = held.filter(F.col("fold") != i), held.filter(F.col("fold") == i)
                for p, m in search._fitted(lambda q: make(name, q), chain, train):
                    assert evaluator.evaluate(m.transform(rest)) == pytest.approx(evaluator.evaluate(make(name, p).fit(train).transform(rest)), abs=1e-12)
    held.unpersist()


def test_importer_models_search_the_published_grids_and_folds(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(jobs_chains, "importer_datasets", lambda *a: {"train": "rows", "test": "rows"})
    monkeypatch.setattr(search, "regressors", lambda train, key, evaluator, grids=None, folds=search.FOLDS: seen.append((grids or search.REGRESSOR_GRIDS, folds)) or [])
    jobs_chains.importer_models(spark, "nowhere")
    grids, folds = seen[0]
    assert folds == 10 and {n: len(search.points(g)) for n, g in grids.items()} == {"rf": 30, "xgb": 30, "lasso": 21, "ridge": 7, "elastic": 4}


def test_classification_results_search_the_published_grids_and_folds(spark, monkeypatch):
    from forecourt.plans import ml as plans
    seen = []
    rows = spark.createDataFrame([(i, "a", [float(i)], float(i % 3)) for i in range(20)], "contract_customer long, customer_group string, x array<double>, label double")
    monkeypatch.setattr(plans, "_contract_features", lambda *a: rows.withColumn("features", array_to_vector("x")))
    monkeypatch.setattr(search, "classifiers", lambda train, key, evaluator, grids=None, folds=search.FOLDS: seen.append((grids or search.CLASSIFIER_GRIDS, folds)) or [])
    E.queries()["mlx_22_classification_results"](spark, "nowhere")
    grids, folds = seen[0]
    assert folds == 10 and {n: len(search.points(g)) for n, g in grids.items()} == {"dt": 24, "rf": 21, "lr": 20, "svm": 10, "gc": 10, "bayes": 1, "ann": 1}
