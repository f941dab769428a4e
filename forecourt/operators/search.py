"""Model search (MLX-15/16/22/23/24/26/36): every listed estimator over its grid
with k folds, the best refitted, timed and reported with its importances.

All models of a search share one hashed fold column, so they are compared on the
same splits and a rerun deals the same folds.  The grids default to the published
ones; callers shrink them.
"""

from __future__ import annotations

import itertools
import json
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, NaiveBayes, OneVsRest, RandomForestClassifier)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, LinearRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.operators import ml
from forecourt.session import few_rows

#: Folds of the retail and importer searches, and of the part and request models.
FOLDS, FOLDS_TEXT = 10, 3
#: Fits of a search that run at once.
AT_ONCE = 4

# The parameter grids of the jobs, in MLlib's names (C = 1 / (n * regParam)).
CLASSIFIER_GRIDS: dict[str, dict[str, list]] = {
    "dt": {"minInstancesPerNode": [3, 5, 7, 9, 10, 15, 20, 30], "maxDepth": [3, 5, 6]},
    "rf": {"numTrees": [10, 25, 50, 100, 200, 500, 1000], "maxDepth": [5, 10, 20]},
    "lr": {"C": [10 ** (-2 + 4 * i / 19) for i in range(20)], "maxIter": [1000]},
    "svm": {"C": [10 ** (-2 + 4 * i / 9) for i in range(10)]},
    "gc": {"maxIter": [10, 20, 30, 40, 50, 60, 70, 80, 90, 100]},
    "bayes": {},
    "ann": {"hidden": [(100, 100)], "maxIter": [1000]},
}
REGRESSOR_GRIDS: dict[str, dict[str, list]] = {
    "rf": {"maxDepth": [3, 5, 7, 9, 11, 13], "numTrees": [50, 100, 200, 250, 500]},
    "xgb": {"maxDepth": [3, 5, 7, 9, 11, 13], "maxIter": [50, 100, 200, 250, 500]},
    "lasso": {"regParam": [1e-4, 1e-5, 1e-6, 1e-7, 1e-8, 1e-9, 1e-10], "maxIter": [1000, 2000, 5000]},
    "ridge": {"regParam": [1e-4, 1e-5, 1e-6, 1e-7, 1e-8, 1e-9, 1e-10]},
    "elastic": {"regParam": [1e-4, 1e-6, 1e-8, 1e-10]},
}


@dataclass
class Found:
    """The best model of one estimator: its grid point, mean score over the folds, seconds of
    the search, importances by feature (None where the model has none)."""
    name: str
    model: Model
    params: dict
    score: float
    seconds: float
    importances: list[float] | None


def points(grid: dict[str, list]) -> list[dict]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def _classifier(name: str, n_rows: int, n_features: int, n_classes: int, weight: str | None, point: dict):
    p = dict(point)
    if "C" in p:
        p["regParam"] = 1.0 / (p.pop("C") * max(n_rows, 1))
    cols = {"featuresCol": "features", "labelCol": "label"}
    weighted = cols | ({"weightCol": weight} if weight else {})
    if name == "dt":
        return DecisionTreeClassifier(**weighted, seed=7, **p)
    if name == "rf":
        return RandomForestClassifier(**weighted, seed=7, **p)
    if name == "lr":
        return LogisticRegression(**weighted, **p)
    if name == "bayes":
        return NaiveBayes(**cols, modelType="gaussian", **p)
    if name == "ann":
        return MultilayerPerceptronClassifier(**cols, seed=7, layers=[n_features, *p.pop("hidden"), n_classes], **p)
    inner = LinearSVC(**cols, **p) if name == "svm" else GBTClassifier(**cols, seed=7, **p)
    return inner if n_classes == 2 else OneVsRest(classifier=inner, **cols, parallelism=4)


def _regressor(name: str, point: dict):
    cols = {"featuresCol": "features", "labelCol": "label"}
    if name == "rf":
        return RandomForestRegressor(**cols, seed=7, **point)
    if name == "xgb":
        return GBTRegressor(**cols, seed=7, **point)
    return LinearRegression(**cols, elasticNetParam={"ridge": 0.0, "lasso": 1.0, "elastic": 0.5}[name], **point)


def _importances(model: Model) -> list[float] | None:
    return model.featureImportances.toArray().tolist() if hasattr(model, "featureImportances") else None


def with_folds(df: DataFrame, key: str, folds: int, seed: int = 0) -> DataFrame:
    """The fold of a row, from a hash of its key alone."""
    return df.withColumn("fold", F.pmod(ml.knuth_hash(F.col(key), seed), F.lit(folds)).cast("int"))


def balanced(df: DataFrame) -> DataFrame:
    """Class weights n / (classes * n of the class)."""
    sizes = df.groupBy("label").agg(F.count(F.lit(1)).alias("_n"))
    n, k = sizes.agg(F.sum("_n")).scalar(), sizes.agg(F.count(F.lit(1))).scalar()
    return df.join(sizes, "label").withColumn("weight", n / (k * F.col("_n"))).drop("_n")


def _held(df: DataFrame, rows: int) -> DataFrame:
    """What a fit reads, persisted for the search, a partition per 100,000 rows: an iteration is one job."""
    return df.select(*[c for c in ("features", "label", "weight", "fold") if c in df.columns]).repartition(max(1, -(-rows // 100_000)), "fold", F.xxhash64("label")).persist()


def _filled(df: DataFrame, folds: int) -> None:
    if df.select("fold").distinct().count() < folds:
        raise ValueError("a fold of the search is empty")


def _chains(grid: list[dict]) -> list[list[dict]]:
    """The points in groups that differ in their iterations alone, fewest first."""
    chains: dict[str, list[dict]] = {}
    for point in grid:
        chains.setdefault(repr([(k, v) for k, v in point.items() if k != "maxIter"]), []).append(point)
    return [sorted(c, key=lambda p: p.get("maxIter", 0)) for c in chains.values()]


def _first_trees(model: Model, n: int, spark: SparkSession) -> Model:
    """The boosted model after its first ``n`` iterations: what a fit of ``n`` iterations gives."""
    java, kind, ml_ = model._java_obj, type(model), spark._jvm.org.apache.spark.ml
    new_array, all_trees, all_weights = spark.sparkContext._gateway.new_array, java.trees(), java.treeWeights()
    trees, weights = new_array(ml_.regression.DecisionTreeRegressionModel, n), new_array(spark._jvm.double, n)
    for i in range(n):
        trees[i], weights[i] = all_trees[i], all_weights[i]
    package = ml_.regression if kind is GBTRegressionModel else ml_.classification
    return kind(getattr(package, kind.__name__)(java.uid(), trees, weights))


def _fitted(make, chain: list[dict], train: DataFrame):
    """(point, model) of a group of points.  Boosting of the most iterations holds the models of fewer;
    a linear fit that ended before its last iteration is the fit of more iterations too."""
    if len(chain) > 1 and isinstance(longest := make(chain[-1]), (GBTRegressor, GBTClassifier)):
        model = longest.fit(train)
        for p in chain:
            yield p, _first_trees(model, p["maxIter"], train.sparkSession)
        return
    model, ended = None, False
    for p in chain:
        if not ended:
            model = make(p).fit(train)
            ended = isinstance(model, LinearRegressionModel) and model.hasSummary and model.summary.totalIterations < p.get("maxIter", 0)
        yield p, model


def _search(name: str, make, grid: list[dict], train: DataFrame, evaluator: Evaluator, folds: int) -> Found:
    """Every grid point is fitted without and scored on each of the shared folds, read from the held
    rows, some fits at once; the best point alone is refitted on all rows."""
    started, best, scores = time.time(), None, {}

    def score(chain: list[dict], i: int) -> list[tuple]:
        held = train.filter(F.col("fold") == i)
        return [(repr(p), i, evaluator.evaluate(m.transform(held))) for p, m in _fitted(make, chain, train.filter(F.col("fold") != i))]
    with ThreadPoolExecutor(AT_ONCE) as pool:
        jobs = [pool.submit(inheritable_thread_target(train.sparkSession)(score), chain, i) for chain in _chains(grid) for i in range(folds)]
        try:
            for job in jobs:
                scores.update({(p, i): x for p, i, x in job.result()})
        except BaseException:
            pool.shutdown(cancel_futures=True)
            raise
    for point in grid:
        mean = float(np.mean([scores[repr(point), i] for i in range(folds)]))
        if best is None or (mean > best[0] if evaluator.isLargerBetter() else mean < best[0]):
            best = (mean, point)
    mean, point = best
    model = make(point).fit(train)
    return Found(name, model, point, mean, time.time() - started, _importances(model))


def classifiers(train: DataFrame, key: str, evaluator: Evaluator, grids: dict[str, dict[str, list]] | None = None, folds: int = FOLDS,
                weighted: bool = True) -> list[Found]:
    """MLX-15: the best of every estimator in ``grids`` for (features, label) of ``train``.  Boosting
    and the linear machine are binary in MLlib: with more classes they are fitted one against the rest."""
    grids = CLASSIFIER_GRIDS if grids is None else grids
    n, classes = train.agg(F.count(F.lit(1)), F.max("label")).first()
    x = _held(with_folds(balanced(train) if weighted else train, key, folds), n)
    _filled(x, folds)
    width = len(x.first()["features"])
    out = [_search(name, lambda p, name=name: _classifier(name, n, width, int(classes) + 1, "weight" if weighted else None, p),
                   points(grid), x, evaluator, folds) for name, grid in grids.items()]
    x.unpersist()
    return out


def regressors(train: DataFrame, key: str, evaluator: Evaluator, grids: dict[str, dict[str, list]] | None = None, folds: int = FOLDS) -> list[Found]:
    """MLX-16: the best of every regressor in ``grids`` for (features, label) of ``train``."""
    x = _held(with_folds(train, key, folds), train.count())
    _filled(x, folds)
    out = [_search(name, lambda p, name=name: _regressor(name, p), points(grid), x, evaluator, folds)
           for name, grid in (REGRESSOR_GRIDS if grids is None else grids).items()]
    x.unpersist()
    return out


def probabilities(found: Found, df: DataFrame) -> DataFrame:
    """MLX-24: prediction and, where the model gives them, class probabilities as an array."""
    out = found.model.transform(df)
    p = vector_to_array("probability") if "probability" in out.columns else F.lit(None).cast("array<double>")
    return out.withColumn("p", p)


def voters(found: list[Found], df: DataFrame) -> dict[str, DataFrame]:
    """Scored frames of the models that give probabilities, for MLX-36."""
    scored = {f.name: f.model.transform(df) for f in found}
    return {n: s for n, s in scored.items() if "probability" in s.columns}


RESULT = "model string, dataset string, {} cv_score double, seconds double, params string, importances string"


def _tail(f: Found) -> tuple:
    return f.score, round(f.seconds, 3), json.dumps(f.params), json.dumps(f.importances)


def classification_results(found: list[Found], datasets: dict[str, DataFrame]) -> DataFrame:
    """MLX-22: a row per model and dataset: accuracy, F1 (micro, macro, weighted), precision and
    recall, ROC area of two-class models, search score, seconds, parameters, importances."""
    from forecourt.operators.ml import auc, classification_metrics, classification_summary, roc_points
    names = ["accuracy", "f1_micro", "f1_macro", "f1_weighted", "precision_macro", "recall_macro"]
    rows, spark = [], next(iter(datasets.values())).sparkSession
    for f in found:
        for dataset, df in datasets.items():
            s = probabilities(f, df).select("label", "prediction", "p").persist()
            r = classification_summary(classification_metrics(s, "label", "prediction")).first()
            two = s.where("size(p) = 2")
            area = None if two.isEmpty() else auc(roc_points(two.select(F.col("label").cast("int").alias("label"), F.get("p", F.lit(1)).alias("score")), "label", "score")).first()
            rows.append((f.name, dataset, *[float(r[n]) for n in names], area[0] if area else None, *_tail(f)))
            s.unpersist()
    return few_rows(spark, rows, RESULT.format(", ".join(f"{n} double" for n in [*names, "roc_auc"]) + ","))


def regression_results(found: list[Found], datasets: dict[str, DataFrame]) -> DataFrame:
    """MLX-23: a row per model and dataset: MSE, RMSE, R2, search score, seconds, parameters, importances."""
    spark, metrics = next(iter(datasets.values())).sparkSession, {}
    for dataset, df in datasets.items():  # one pass scores all models
        scored = df.select("features", "label")
        for i, f in enumerate(found):
            scored = f.model.copy().setPredictionCol(f"_p{i}").transform(scored)
        metrics[dataset] = ml.regression_metrics_of(scored, "label", [f"_p{i}" for i in range(len(found))])
    rows = [(f.name, dataset, *metrics[dataset][i], *_tail(f)) for i, f in enumerate(found) for dataset in datasets]
    return few_rows(spark, rows, RESULT.format("mse double, rmse double, r2 double,"))
