"""MLX-* registered queries: preparation and evaluation with SQL twins;
model fitting (MLlib) rows-only."""

from __future__ import annotations

import json
import math
import uuid
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from forecourt.functions.fmt import big, rnd, sql_rnd
from forecourt.operators import ml, search
from forecourt.operators.features import FeaturePipeline, FittedFeatures
from forecourt.plans.measures import featured_contracts
from forecourt.plans.registry import query
from forecourt.session import few_rows, materialize, scratch_table_path
from forecourt.sources.fixtures import EVENTS_GAPS_SQL, LANG_PRED_SQL, events_gaps, lang_predictions
from forecourt.sources.tables import read

ORACLE: dict[str, str] = {}
DIMS = 64
TOP_DUMMIES = 100
H = "(({k} * 2654435761 + {s}) % 4294967296)"


def sql(name, text):
    ORACLE[name] = text.strip()


def emb(spark, d):
    e = read(spark, d, "embeddings", "vec_id", "embedding", "label")
    return e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(DIMS)], "embedding")


EMB_SQL = "emb AS (SELECT vec_id, label, " + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(DIMS)) + " FROM embeddings)"


@query("mlx_01_stratified_split")
def mlx01(spark, d):
    return ml.stratified_split(emb(spark, d).select("vec_id", "label"), "label", "vec_id", 0.25, seed=11)


sql("mlx_01_stratified_split", f"""SELECT vec_id, label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY {H.format(k='vec_id', s=11)}, vec_id)
  <= floor(count(*) OVER (PARTITION BY label) * 0.75) THEN 'train' ELSE 'test' END AS split FROM embeddings""")


@query("mlx_02_oversampling")
def mlx02(spark, d):
    base = emb(spark, d).select("vec_id", "label").filter((F.col("vec_id") % 7 != 0) | (F.col("label") > 2))
    o = ml.oversample(base, "label", "vec_id", seed=3)
    return o.select("vec_id", "label", F.col("replica").cast("bigint").alias("replica"))


sql("mlx_02_oversampling", f"""WITH b AS (SELECT vec_id, label FROM embeddings WHERE vec_id % 7 <> 0 OR label > 2),
n AS (SELECT label, count(*) AS n FROM b GROUP BY label), mx AS (SELECT max(n) AS m FROM n),
r AS (SELECT b.*, n.n, row_number() OVER (PARTITION BY b.label ORDER BY {H.format(k='b.vec_id', s=3)}, b.vec_id) AS rn FROM b JOIN n USING (label)),
c AS (SELECT r.*, CAST(floor(m / n) AS BIGINT) AS fullc, m - CAST(floor(m / n) AS BIGINT) * n AS rem FROM r, mx)
SELECT vec_id, label, CAST(unnest(generate_series(0, CASE WHEN rn <= rem THEN fullc ELSE fullc - 1 END)) AS BIGINT) AS replica FROM c""")


@query("mlx_03_one_hot")
def mlx03(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_type")
    vals = ml.all_values(p, "p_type")
    return ml.dummies(p, "p_type", vals).select("p_partkey", *[F.col(f"p_type_{v}").cast("bigint").alias(f"p_type_{v}") for v in vals])


_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
sql("mlx_03_one_hot", "SELECT p_partkey, " + ", ".join(f"CAST(p_type = '{t}' AS BIGINT) AS p_type_{t}" for t in _TYPES) + " FROM part")


@query("mlx_05_top_dummies")
def mlx05(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_name")
    vals = sorted(ml.top_values(p, "p_name", TOP_DUMMIES))
    out = ml.dummies(p, "p_name", vals, prefix="name")
    # one column a value: reported as the position of the one that is set
    at = F.array_position(F.array(*[F.col(f"name_{v}") for v in vals]), 1)
    return out.select("p_partkey", at.alias("dummy"), F.lit(len(vals)).cast("bigint").alias("n_dummies"))


sql("mlx_05_top_dummies", f"""WITH t AS (SELECT p_name, row_number() OVER (ORDER BY p_name) AS i
  FROM (SELECT p_name FROM part GROUP BY p_name ORDER BY count(*) DESC, p_name LIMIT {TOP_DUMMIES}))
SELECT p_partkey, CAST(coalesce(i, 0) AS BIGINT) AS dummy, (SELECT count(*) FROM t) AS n_dummies FROM part LEFT JOIN t USING (p_name)""")


@query("mlx_06_anova_selection")
def mlx06(spark, d):
    f = ml.anova_f(emb(spark, d), "label", [f"e{i}" for i in range(DIMS)])
    return f.select("feature", rnd("f_score", 4).alias("f_score"))


def _anova_sql():
    parts = []
    for i in range(DIMS):
        c = f"e{i}"
        parts.append(f"""SELECT '{c}' AS feature, {sql_rnd(f'((sum(sc * sc / nc) - sum(sc) * sum(sc) / sum(nc)) / (count(*) - 1)) / ((sum(qc) - sum(sc * sc / nc)) / (sum(nc) - count(*)))', 4)} AS f_score
  FROM (SELECT label, count(*) AS nc, sum({c}) AS sc, sum({c} * {c}) AS qc FROM emb GROUP BY label)""")
    return f"WITH {EMB_SQL} " + " UNION ALL ".join(parts)


sql("mlx_06_anova_selection", _anova_sql())


@query("mlx_06_k_best")
def mlx06k(spark, d):
    return ml.select_k_best(mlx06(spark, d), 10, "e1")


sql("mlx_06_k_best", f"SELECT * FROM ({_anova_sql()}) WHERE contains(feature, 'e1') ORDER BY f_score DESC, feature LIMIT 10")


KNN_LABELLED, KNN_K = 2000, 5


@query("mlx_35_nearest_neighbours")
def mlx35(spark, d):
    s = ml.stratified_split(read(spark, d, "embeddings", "vec_id", "embedding", "label"), "label", "vec_id", 0.25, seed=11)
    return ml.knn_classify(s.filter("split = 'test'"), s.filter("split = 'train'"), "vec_id", "embedding", "label", KNN_K, bound=KNN_LABELLED)


sql("mlx_35_nearest_neighbours", f"""WITH s AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label, row_number() OVER (PARTITION BY label ORDER BY {H.format(k='vec_id', s=11)}, vec_id)
  <= floor(count(*) OVER (PARTITION BY label) * 0.75) AS train FROM embeddings),
k AS (SELECT * FROM s WHERE train ORDER BY {H.format(k='vec_id', s=0)}, vec_id LIMIT {KNN_LABELLED}),
n AS (SELECT s.vec_id, k.label, row_number() OVER (PARTITION BY s.vec_id ORDER BY list_distance(s.v, k.v), k.vec_id) AS r FROM s, k WHERE NOT s.train),
votes AS (SELECT vec_id, label, count(*) AS c FROM n WHERE r <= {KNN_K} GROUP BY vec_id, label)
SELECT vec_id, CAST(arg_max(label, (c, -label)) AS BIGINT) AS prediction FROM votes GROUP BY vec_id""")


def _train_test(spark, d):
    e = events_gaps(spark, d)
    return e.filter(F.col("event_id") % 4 != 0), e.filter(F.col("event_id") % 4 == 0)


@query("mlx_07_type_casting")
def mlx07(spark, d):
    e = events_gaps(spark, d).withColumn("ts2", F.when(F.col("event_id") % 6 == 0, F.lit(None)).otherwise(F.col("ts")))
    sec = F.unix_timestamp("ts2").cast("double")
    mean = e.agg(F.avg(sec)).scalar()
    return e.select("event_id", F.col("event_type").cast("string").alias("category"), F.coalesce(sec, mean).alias("ts_seconds")) \
            .select("event_id", "category", rnd("ts_seconds", 2).alias("ts_seconds"))


sql("mlx_07_type_casting", f"""WITH e AS (SELECT event_id, event_type, CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(floor(epoch(ts)) AS BIGINT) END AS s FROM events)
SELECT event_id, event_type AS category, {sql_rnd('coalesce(CAST(s AS DOUBLE), (SELECT avg(CAST(s AS DOUBLE)) FROM e))', 2)} AS ts_seconds FROM e""")


@query("mlx_08_imputation")
def mlx08(spark, d):
    tr, te = _train_test(spark, d)
    te = te.withColumn("event_type", F.when(F.col("event_id") % 8 == 0, F.lit(None)).otherwise(F.col("event_type")))
    _, t = ml.impute(tr, te, {"value": "mean", "value2": "median", "event_type": "mode"})
    return t.select("event_id", rnd("value").alias("value"), rnd("value2").alias("value2"), "event_type")


sql("mlx_08_imputation", f"""WITH {EVENTS_GAPS_SQL.strip()}, tr AS (SELECT * FROM events_gaps WHERE event_id % 4 <> 0),
mode_t AS (SELECT event_type FROM tr WHERE event_type IS NOT NULL GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)
SELECT event_id, {sql_rnd('coalesce(value, (SELECT avg(value) FROM tr))')} AS value, {sql_rnd('coalesce(value2, (SELECT quantile_cont(value2, 0.5) FROM tr))')} AS value2,
  coalesce(CASE WHEN event_id % 8 = 0 THEN NULL ELSE event_type END, (SELECT event_type FROM mode_t)) AS event_type FROM events_gaps WHERE event_id % 4 = 0""")


@query("mlx_09_drop_missing")
def mlx09(spark, d):
    tr, _ = _train_test(spark, d)
    return tr.na.drop(subset=["value", "value2"]).select("event_id")


sql("mlx_09_drop_missing", f"WITH {EVENTS_GAPS_SQL.strip()} SELECT event_id FROM events_gaps WHERE event_id % 4 <> 0 AND value IS NOT NULL AND value2 IS NOT NULL")


@query("mlx_10_rescale")
def mlx10(spark, d):
    tr, te = _train_test(spark, d)
    _, t = ml.rescale(tr, te, {"value": "minmax", "value2": "standard"})
    return t.select("event_id", rnd("value", 6).alias("value"), rnd("value2", 6).alias("value2"))


sql("mlx_10_rescale", f"""WITH {EVENTS_GAPS_SQL.strip()}, tr AS (SELECT * FROM events_gaps WHERE event_id % 4 <> 0)
SELECT event_id, {sql_rnd('(value - (SELECT min(value) FROM tr)) / ((SELECT max(value) FROM tr) - (SELECT min(value) FROM tr))', 6)} AS value,
  {sql_rnd('(value2 - (SELECT avg(value2) FROM tr)) / (SELECT stddev_samp(value2) FROM tr)', 6)} AS value2 FROM events_gaps WHERE event_id % 4 = 0""")


@query("mlx_14_label_index")
def mlx14(spark, d):
    doc = read(spark, d, "documents", "doc_id", "source")
    return ml.first_seen_index(doc, "source", ["doc_id"])


sql("mlx_14_label_index", "SELECT source, CAST(row_number() OVER (ORDER BY min(doc_id)) - 1 AS BIGINT) AS label_index FROM documents GROUP BY source")


@query("mlx_19_classification_metrics")
def mlx19(spark, d):
    per = ml.classification_metrics(lang_predictions(spark, d), "actual", "predicted")
    return per.select(F.col("cls").alias("class"), big("tp").alias("tp"), big("support").alias("support"), big("predicted").alias("predicted"),
                      rnd("precision", 6).alias("precision"), rnd("recall", 6).alias("recall"), rnd("f1", 6).alias("f1"))


_CM_SQL = f"""{LANG_PRED_SQL.strip()},
cells AS (SELECT actual AS l, predicted AS p, count(*) AS c FROM lang_pred GROUP BY ALL),
cl AS (SELECT l AS cls FROM cells UNION SELECT p FROM cells),
per AS (SELECT cl.cls, coalesce((SELECT c FROM cells WHERE l = cls AND p = cls), 0) AS tp, coalesce((SELECT sum(c) FROM cells WHERE l = cls), 0) AS support,
  coalesce((SELECT sum(c) FROM cells WHERE p = cls), 0) AS predicted FROM cl),
per2 AS (SELECT *, coalesce(tp / NULLIF(predicted, 0), 0.0) AS precision, coalesce(tp / NULLIF(support, 0), 0.0) AS recall FROM per),
per3 AS (SELECT *, coalesce(2 * precision * recall / NULLIF(precision + recall, 0), 0.0) AS f1 FROM per2)"""

sql("mlx_19_classification_metrics", f"""WITH {_CM_SQL} SELECT cls AS class, CAST(tp AS BIGINT) AS tp, CAST(support AS BIGINT) AS support, CAST(predicted AS BIGINT) AS predicted,
  {sql_rnd('precision', 6)} AS precision, {sql_rnd('recall', 6)} AS recall, {sql_rnd('f1', 6)} AS f1 FROM per3""")


@query("mlx_19_classification_summary")
def mlx19s(spark, d):
    s = ml.classification_summary(ml.classification_metrics(lang_predictions(spark, d), "actual", "predicted"))
    return s.select(*[rnd(c, 6).alias(c) for c in s.columns])


sql("mlx_19_classification_summary", f"""WITH {_CM_SQL} SELECT {sql_rnd('sum(tp) / sum(support)', 6)} AS accuracy, {sql_rnd('avg(f1)', 6)} AS f1_macro,
  {sql_rnd('sum(f1 * support) / sum(support)', 6)} AS f1_weighted, {sql_rnd('sum(tp) / sum(support)', 6)} AS f1_micro,
  {sql_rnd('avg(precision)', 6)} AS precision_macro, {sql_rnd('avg(recall)', 6)} AS recall_macro FROM per3""")


def _group_mean_predictions(spark, d):
    li = read(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_extendedprice")
    p = read(spark, d, "part", "p_partkey", "p_type")
    x = li.join(p, F.col("l_partkey") == F.col("p_partkey"))
    tr, te = x.filter(F.col("l_orderkey") % 4 != 0), x.filter(F.col("l_orderkey") % 4 == 0)
    m = tr.groupBy("p_type").agg(F.avg("l_extendedprice").alias("prediction"))
    return te.join(m, "p_type")


@query("mlx_20_regression_metrics")
def mlx20(spark, d):
    r = ml.regression_metrics(_group_mean_predictions(spark, d), "l_extendedprice", "prediction")
    return r.select(rnd("mse", 2).alias("mse"), rnd("rmse", 4).alias("rmse"), rnd("r2", 6).alias("r2"))


sql("mlx_20_regression_metrics", f"""WITH x AS (SELECT l.l_orderkey, l.l_extendedprice, p.p_type FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
m AS (SELECT p_type, avg(l_extendedprice) AS prediction FROM x WHERE l_orderkey % 4 <> 0 GROUP BY p_type),
te AS (SELECT x.*, m.prediction FROM x JOIN m USING (p_type) WHERE l_orderkey % 4 = 0)
SELECT {sql_rnd('avg((l_extendedprice - prediction) ^ 2)', 2)} AS mse, {sql_rnd('sqrt(avg((l_extendedprice - prediction) ^ 2))', 4)} AS rmse,
  {sql_rnd('1 - sum((l_extendedprice - prediction) ^ 2) / sum((l_extendedprice - (SELECT avg(l_extendedprice) FROM te)) ^ 2)', 6)} AS r2 FROM te""")


def _scored_docs(spark, d):
    doc = read(spark, d, "documents", "doc_id", "n_chars")
    lab = read(spark, d, "labels", "doc_id", "quality")
    return doc.join(lab, "doc_id").withColumn("score", F.log10(F.col("n_chars") + 1))


@query("mlx_27_roc_auc")
def mlx27(spark, d):
    pts = ml.roc_points(_scored_docs(spark, d), "quality", "score")
    a = ml.auc(pts)
    return pts.select(rnd("score", 6).alias("score"), rnd("tpr", 6).alias("tpr"), rnd("fpr", 6).alias("fpr"),
                   F.lit(a.select(rnd("auc", 6)).scalar()).alias("auc"))


sql("mlx_27_roc_auc", f"""WITH s AS (SELECT l.quality, log10(d.n_chars + 1) AS score FROM documents d JOIN labels l USING (doc_id)),
c AS (SELECT score, sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS p, sum(CASE WHEN quality <> 1 THEN 1 ELSE 0 END) AS n FROM s GROUP BY score),
pt AS (SELECT score, sum(p) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(p) OVER () AS tpr,
  sum(n) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(n) OVER () AS fpr FROM c),
a AS (SELECT sum((fpr - pf) * (tpr + pt) / 2) AS auc FROM (SELECT *, coalesce(lag(fpr) OVER (ORDER BY fpr, tpr), 0.0) AS pf, coalesce(lag(tpr) OVER (ORDER BY fpr, tpr), 0.0) AS pt FROM pt))
SELECT {sql_rnd('score', 6)} AS score, {sql_rnd('tpr', 6)} AS tpr, {sql_rnd('fpr', 6)} AS fpr, (SELECT {sql_rnd('auc', 6)} FROM a) AS auc FROM pt""")


@query("mlx_28_confusion_normalized")
def mlx28(spark, d):
    lp = lang_predictions(spark, d)
    c = lp.groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("n"))
    t = c.groupBy("actual").agg(F.sum("n").alias("row_total"))
    return c.join(t, "actual").select("actual", "predicted", rnd(F.col("n") / F.col("row_total"), 6).alias("share"))


sql("mlx_28_confusion_normalized", f"WITH {LANG_PRED_SQL.strip()} SELECT actual, predicted, {sql_rnd('count(*) / sum(count(*)) OVER (PARTITION BY actual)', 6)} AS share FROM lang_pred GROUP BY actual, predicted")


@query("mlx_25_model_choice")
def mlx25(spark, d):
    lp = lang_predictions(spark, d).join(read(spark, d, "documents", "doc_id", "source"), "doc_id")
    res = lp.groupBy(F.col("source").alias("model")).agg(F.avg((F.col("actual") == F.col("predicted")).cast("double")).alias("accuracy"))
    c = ml.model_choice(res, "accuracy", 0.5, previous=0.9)
    return c.select("best_model", rnd("best_score", 6).alias("best_score"), "choice_flag")


sql("mlx_25_model_choice", f"""WITH {LANG_PRED_SQL.strip()}, r AS (SELECT d.source AS model, avg(CAST(lp.actual = lp.predicted AS DOUBLE)) AS accuracy FROM lang_pred lp JOIN documents d USING (doc_id) GROUP BY d.source),
b AS (SELECT arg_max(model, (accuracy, model)) AS best_model, max(accuracy) AS best_score FROM r WHERE accuracy > 0.5)
SELECT best_model, {sql_rnd('best_score', 6)} AS best_score, CAST(CASE WHEN best_model IS NULL THEN 4 WHEN best_score > 0.9 THEN 3 WHEN best_score = 0.9 THEN 2 WHEN 0.9 - best_score <= 0.02 THEN 1 ELSE 0 END AS BIGINT) AS choice_flag FROM b""")

# ------------------------------------------------------------ rows-only fits


def _emb_split(spark, d):
    e = ml.vectors(emb(spark, d), "embedding").select("vec_id", "label", "features")
    s = materialize(ml.stratified_split(e, "label", "vec_id", 0.25, seed=11), "checkpoint")
    return s.filter("split = 'train'"), s.filter("split = 'test'")


# The registered searches run the folds of the part and request models over a few grid points
# an estimator; the whole published grids are the defaults of ``search``.
SEARCH = {"dt": {"minInstancesPerNode": [5], "maxDepth": [3, 5]}, "rf": {"numTrees": [10], "maxDepth": [5]}, "lr": {"C": [1.0], "maxIter": [30]},
          "svm": {"C": [1.0], "maxIter": [10]}, "gc": {"maxIter": [3], "maxDepth": [3]}, "bayes": {}, "ann": {"hidden": [(20, 20)], "maxIter": [30]}}
SEARCH_REGRESSION = {"rf": {"maxDepth": [5], "numTrees": [10]}, "xgb": {"maxDepth": [3], "maxIter": [5]}, "lasso": {"regParam": [1e-4], "maxIter": [50]},
                     "ridge": {"regParam": [1e-4, 1e-10]}, "elastic": {"regParam": [1e-4], "maxIter": [50]}}


@query("mlx_15_classifier_grid")
def mlx15(spark, d):
    tr, te = _emb_split(spark, d)
    found = search.classifiers(tr.select("vec_id", "features", "label"), "vec_id", ml.eval_f1("label"), SEARCH, search.FOLDS_TEXT)
    return reduce(lambda a, b: a.unionByName(b), [
        f.model.transform(te).select("vec_id", F.lit(f.name).alias("model"), F.col("prediction").cast("bigint").alias("prediction"),
                                     F.lit(json.dumps(f.params)).alias("params"), F.lit(round(f.score, 6)).alias("cv_f1")) for f in found])


@query("mlx_36_soft_voting")
def mlx36(spark, d):
    """All models with probabilities vote."""
    tr, te = _emb_split(spark, d)
    grids = {n: g for n, g in SEARCH.items() if n in ("dt", "rf", "lr", "bayes", "ann")}
    found = search.classifiers(tr.select("vec_id", "features", "label"), "vec_id", ml.eval_f1("label"), grids, search.FOLDS_TEXT)
    v = ml.soft_vote(search.voters(found, te), "vec_id")
    return v.select("vec_id", F.col("prediction").cast("bigint").alias("prediction"), rnd("max_prob", 6).alias("max_prob"))


def _contract_features(spark, d):
    c = featured_contracts(spark, d).withColumn("label", F.coalesce("target_cost", F.lit(0.0)))
    return ml.assemble(["power_kw", "weight_empty", "contract_km", "mean_repair_value_cust_full", "power_weight_ratio"]).transform(c)


@query("mlx_16_regressor_grid")
def mlx16(spark, d):
    x = materialize(_contract_features(spark, d).select("contract_customer", "features", "label"), "checkpoint")
    tr, te = x.filter(F.col("contract_customer") % 5 != 0), x.filter(F.col("contract_customer") % 5 == 0)
    found = search.regressors(tr.select("contract_customer", "features", "label"), "contract_customer", ml.eval_rmse("label"), SEARCH_REGRESSION, search.FOLDS_TEXT)
    return reduce(lambda a, b: a.unionByName(b), [f.model.transform(te).select("contract_customer", F.lit(f.name).alias("model"), rnd("prediction", 2).alias("prediction"),
                                                                               F.lit(json.dumps(f.params)).alias("params")) for f in found])


@query("mlx_17_kmeans_scan")
def mlx17(spark, d):
    e = ml.vectors(emb(spark, d), "embedding").select("features")
    return ml.kmeans_scan(e, "features", [2, 3, 4, 5], restarts=3)


@query("mlx_18_gap_statistic")
def mlx18(spark, d):
    e = ml.vectors(emb(spark, d), "embedding").select("features")
    arr = e.select(vector_to_array("features").alias("x"))
    bounds = arr.select(F.array(*[F.min(F.col("x")[i]) for i in range(64)]).alias("lo"),
                        F.array(*[F.max(F.col("x")[i]) for i in range(64)]).alias("hi")).first()
    n = e.count()
    rows = []
    for k in (2, 3, 4, 5):
        wk = KMeans(k=k, seed=7, maxIter=20).fit(e).summary.trainingCost
        refs = []
        for b in range(3):
            ref = e.sparkSession.range(n).select(F.array(*[F.lit(bounds["lo"][i]) + F.rand(seed=100 * k + 10 * b + i) * (bounds["hi"][i] - bounds["lo"][i])
                                                            for i in range(64)]).alias("x"))
            ref = ml.vectors(ref, "x")
            refs.append(math.log(KMeans(k=k, seed=7, maxIter=20).fit(ref).summary.trainingCost))
        rows.append((k, sum(refs) / len(refs) - math.log(wk)))
    return few_rows(e.sparkSession, rows, "k int, gap double")


@query("mlx_21_cluster_evaluation")
def mlx21(spark, d):
    """Silhouette of every point, with the size and mean of its cluster."""
    e = ml.vectors(emb(spark, d), "embedding").select("vec_id", "features")
    s = ml.silhouettes(ml.kmeans_best(e, "features", 10, restarts=3).transform(e), "features")
    by_cluster = s.groupBy("prediction").agg(F.count(F.lit(1)).alias("size"), rnd(F.avg("silhouette"), 6).alias("cluster_silhouette"))
    return s.join(by_cluster, "prediction").select("vec_id", F.col("prediction").cast("bigint").alias("cluster"), rnd("silhouette", 6).alias("silhouette"),
                                                   "size", "cluster_silhouette")


def _doc_text_model_input(spark, d):
    doc = read(spark, d, "documents", "doc_id", "text", "n_chars", "source")
    lab = read(spark, d, "labels", "doc_id", "quality")
    x = doc.join(lab, "doc_id", "left").withColumn("clean", F.lower(F.regexp_replace("text", r"[^\p{L}\s]", " ")))
    return x.drop("text")  # the cleaned text goes on, once


def requests_features():
    """MLX-13: length, category dummies, the text's components."""
    return FeaturePipeline({"n_chars": "standard"}, ["source"], ["clean"])


@query("mlx_31_requests_model")
def mlx31(spark, d):
    """Fitted on the labelled requests, predicts the undefined ones."""
    x = _doc_text_model_input(spark, d)
    train = x.filter(F.col("quality").isNotNull())
    fitted = requests_features().fit(train)
    model = LogisticRegression(labelCol="quality", maxIter=30, regParam=0.01).fit(fitted.transform(train))
    out = model.transform(fitted.transform(x.filter(F.col("quality").isNull())))
    return out.select("doc_id", F.col("prediction").cast("bigint").alias("prediction"),
                      rnd(F.array_max(vector_to_array("probability")), 4).alias("max_prob"))


@query("mlx_11_text_svd")
def mlx11(spark, d):
    """Components of every text, learned on three quarters of them, stored and read back."""
    x = _doc_text_model_input(spark, d).select("doc_id", "clean").withColumn("split", F.when(F.col("doc_id") % 4 == 0, "test").otherwise("train"))
    path = scratch_table_path(spark, f"mlx11_{uuid.uuid4().hex[:8]}")
    FeaturePipeline(texts=["clean"]).fit(x.filter("split = 'train'")).save(spark, path)
    out = FittedFeatures.load(spark, path).transform(x)
    return out.select("doc_id", "split", vector_to_array("features").alias("components"))


def part_features():
    """MLX-12: standardised numbers and the components of the name."""
    return FeaturePipeline({"p_size": "standard", "p_retailprice": "standard"}, texts=["p_name"])


def cascade_models(main_rows, other_rows, rows):
    """MLX-30: every row scored by the model of the main families; rows whose highest
    probability is at most 0.5 by the other families' model.  Each model has
    features learned on its own families.  Adds prediction, max_prob, stage."""
    def stage(train, name):
        fitted = part_features().fit(train)
        model = LogisticRegression(maxIter=20).fit(fitted.transform(train))
        return lambda df: (model.transform(fitted.transform(df)).withColumn("max_prob", F.array_max(vector_to_array("probability")))
                           .withColumn("stage", F.lit(name)).select(*df.columns, F.col("prediction").cast("bigint").alias("prediction"), "stage", "max_prob"))
    s1 = stage(main_rows, "main")(rows)
    rest = s1.filter(F.col("max_prob") <= 0.5).select(*rows.columns)
    return s1.filter(F.col("max_prob") > 0.5).unionByName(stage(other_rows, "other")(rest))


def labelled_parts(spark, d):
    """Parts with their family, and its number in first-seen order as the label."""
    p = read(spark, d, "part", "p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    p = p.withColumn("family", F.when(F.col("p_type").isin("PROMO", "ECONOMY"), F.lit("other")).otherwise(F.col("p_type")))
    idx = ml.first_seen_index(p, "p_type", ["p_partkey"]).withColumnRenamed("label_index", "label")
    return p.join(idx, "p_type").withColumn("label", F.col("label").cast("double"))


def cascade(spark, d):
    """(p_partkey, prediction, stage, max_prob) of the two models."""
    x = labelled_parts(spark, d)
    out = cascade_models(x.filter(F.col("family") != "other"), x.filter(F.col("family") == "other"), x)
    return out.select("p_partkey", "prediction", "stage", "max_prob")


@query("mlx_30_two_stage_cascade")
def mlx30(spark, d):
    return cascade(spark, d).select("p_partkey", "prediction", "stage")


@query("mlx_32_accident_models")
def mlx32(spark, d):
    x = featured_contracts(spark, d)
    x = ml.assemble(["power_kw", "weight_empty", "contract_km", "mean_repair_value_cust_full", "contract_start_month"]).transform(x)
    x = materialize(x.select("contract_customer", "contract_start_date", "features", "target_cost", "target_qiv", "target_dp"), "checkpoint")
    split = "1998-01-01"
    out = None
    for target in ("target_cost", "target_qiv", "target_dp"):
        y = x.withColumn("label", F.col(target).isNotNull().cast("double"))
        tr, te = y.filter(F.col("contract_start_date") < split), y.filter(F.col("contract_start_date") >= split)
        m = LogisticRegression(maxIter=30).fit(tr)
        auc = BinaryClassificationEvaluator().evaluate(m.transform(te)) if te.count() else None
        r = m.transform(y).select("contract_customer", F.lit(target).alias("target"),
                                  rnd(vector_to_array("probability")[1], 6).alias("probability"),
                                  F.lit(None if auc is None else round(auc, 6)).cast("double").alias("test_auc"))
        out = r if out is None else out.unionByName(r)
    return out


@query("mlx_33_model_persistence")
def mlx33(spark, d):
    x = _contract_features(spark, d)
    model = Pipeline(stages=[LogisticRegression(maxIter=10, labelCol="y")]).fit(x.withColumn("y", (F.col("label") > 0).cast("double")))
    path = scratch_table_path(spark, f"mlx33_{uuid.uuid4().hex[:8]}")
    ml.save_model(model, path)
    return ml.load_model(path).transform(x).select("contract_customer", F.col("prediction").cast("bigint").alias("prediction"))
