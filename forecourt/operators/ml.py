"""Machine-learning operators (MLX-*) on MLlib and DataFrame aggregations.

Data preparation (splits, oversampling, encoders, imputation, scaling,
ANOVA selection) and evaluation (metrics, ROC, confusion, model choice) are
plain aggregations, so they scale and can be checked against SQL; model
model searches are in ``search``, learned features in ``features``.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.operators.quantiles import quantile_values
from forecourt.operators.windows import chunked_running
from forecourt.session import few_rows, small

# -------------------------------------------------------------- preparation


def knuth_hash(key: Column, seed: int = 0) -> Column:
    """Deterministic multiplicative hash of an integer key (same value in
    every engine), used to order rows pseudo-randomly but reproducibly."""
    k = F.pmod(key, F.lit(4294967296))
    # In two halves of 16 bits, so no key overflows a long.
    high = F.pmod(F.floor(k / 65536) * F.lit(2654435761), F.lit(4294967296)) * 65536
    return F.pmod(high + F.pmod(k, F.lit(65536)) * F.lit(2654435761) + F.lit(seed), F.lit(4294967296))


def _hash_chunk(rows: Column) -> Column:
    """Chunk of the hash column ``_h`` in a class of so many rows: about
    100,000 rows to a chunk, whatever the size."""
    return F.floor(F.col("_h") * F.ceil(rows / 100_000) / F.lit(4294967296))


def stratified_split(df: DataFrame, label: str, key: str, test_frac: float = 0.25, seed: int = 0) -> DataFrame:
    """MLX-01: exact stratified split: within each class rows are ranked by
    a seeded hash of the key; the first floor(n_c * (1 - test)) go to train.
    The ranking is a chunked scan, so a dominant class is not one task."""
    h = knuth_hash(F.col(key), seed)
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    x = df.withColumn("_h", h).join(n, label)
    ranked = chunked_running(x, [label], ["_h", key], _hash_chunk(F.col("_n")), [], [], "_s")
    return (ranked.withColumn("split", F.when(F.col("_s_rn") <= F.floor(F.col("_n") * (1 - test_frac)), "train").otherwise("test"))
                  .drop("_h", "_s_rn", "_n"))


def oversample(df: DataFrame, label: str, key: str, seed: int = 0) -> DataFrame:
    """MLX-02: replicate every class up to the majority count: whole copies
    plus the first ``remainder`` rows (seeded hash order) of one more copy;
    adds the replica number as origin column."""
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    mx = n.agg(F.max("_n")).scalar()
    x = df.join(n, label).withColumn("_h", knuth_hash(F.col(key), seed))
    ranked = chunked_running(x, [label], ["_h", key], _hash_chunk(F.col("_n")), [], [], "_s")
    full = F.floor(mx / F.col("_n")).cast("int")
    rem = (mx - full * F.col("_n"))
    reps = F.when(F.col("_s_rn") <= rem, full + 1).otherwise(full)
    return (ranked.withColumn("replica", F.explode(F.sequence(F.lit(0), reps - 1)))
                  .drop("_n", "_h", "_s_rn"))


def top_values(df: DataFrame, col: str, limit: int = 100) -> list:
    """SRT-03 / MLX-05: the ``limit`` most frequent values (count desc,
    value asc).  At most ``limit`` values reach the driver (they become
    column names)."""
    c = df.groupBy(col).agg(F.count(F.lit(1)).alias("_c")).orderBy(F.desc("_c"), col).limit(limit)
    return [r[0] for r in c.collect()]


def all_values(df: DataFrame, col: str, limit: int = 10_000) -> list:
    """MLX-03: every value of a category, in order.  They become columns, so more
    than ``limit`` of them is an error, never a cut."""
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{col} has more than {limit} values")
    return sorted(r[0] for r in rows)


def dummies(df: DataFrame, col: str, values: list, prefix: str | None = None, drop_source: bool = True) -> DataFrame:
    """MLX-03 / MLX-05: 0/1 columns for a bounded value list (unknown
    values -> all zeros)."""
    p = prefix or col
    out = df.withColumns({f"{p}_{v}": (F.col(col) == F.lit(v)).cast("int") for v in values})
    return out.drop(col) if drop_source else out


def encoder_pipeline(cols: list[str]) -> Pipeline:
    """MLX-04: StringIndexer (unknown kept) + OneHotEncoder fitted on train
    and applied to new rows; unknown categories become the extra slot."""
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in cols]
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_ohe" for c in cols], handleInvalid="keep")
    return Pipeline(stages=[*idx, ohe])


def anova_f(df: DataFrame, label: str, features: list[str]) -> DataFrame:
    """MLX-06: one-way ANOVA F statistic of each numeric feature against
    the class label, from per-class sums (one aggregation), ranked."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"),
                                *[F.sum(f).alias(f"_s{i}") for i, f in enumerate(features)],
                                *[F.sum(F.col(f) * F.col(f)).alias(f"_q{i}") for i, f in enumerate(features)])
    long = per.select("_n", F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"_s{i}").alias("s"), F.col(f"_q{i}").alias("q"))
                                                for i, f in enumerate(features)])).alias("_f")).select("_n", "_f.*")
    tot = long.groupBy("feature").agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("k"), F.sum("s").alias("s"), F.sum("q").alias("q"),
                                      F.sum(F.col("s") * F.col("s") / F.col("_n")).alias("b"))
    ssb = F.col("b") - F.col("s") * F.col("s") / F.col("n")
    ssw = F.col("q") - F.col("b")
    return tot.select("feature", ((ssb / (F.col("k") - 1)) / (ssw / (F.col("n") - F.col("k")))).alias("f_score"))


def select_k_best(scores: DataFrame, k: int, name_part: str = "") -> DataFrame:
    """MLX-06: the k features of the highest score (ties by name) among those whose
    name holds ``name_part``."""
    return scores.filter(F.col("feature").contains(name_part)).orderBy(F.desc("f_score"), "feature").limit(k)


def impute(train: DataFrame, test: DataFrame, spec: dict[str, str | tuple]) -> tuple[DataFrame, DataFrame]:
    """MLX-08: per feature 'mean' | 'median' | 'mode' | ('constant', v) |
    ('category', v), learned on train, applied to both."""
    fills = {}
    for c, how in spec.items():
        if how == "mean":
            fills[c] = train.agg(F.avg(c)).scalar()
        elif how == "median":
            fills[c] = quantile_values(train, c, [0.5])[0]
        elif how == "mode":
            fills[c] = train.agg(F.mode(F.col(c), True)).scalar()
        else:
            fills[c] = F.lit(how[1])
    def apply(df):
        return df.withColumns({c: F.coalesce(F.col(c), v) for c, v in fills.items()})
    return apply(train), apply(test)


def rescale(train: DataFrame, test: DataFrame, spec: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """MLX-10: 'minmax' or 'standard' (mean / sample std) learned on train;
    a constant feature (zero range / std) is dropped."""
    spread = train.agg(*[F.count_distinct(F.col(c)).alias(c) for c in spec]).first()
    exprs, drop = {}, [c for c in spec if spread[c] < 2]
    for c, how in spec.items():
        if how == "minmax":
            lo, hi = train.agg(F.min(c)).scalar(), train.agg(F.max(c)).scalar()
            exprs[c] = F.try_divide(F.col(c) - lo, hi - lo)
        else:
            mu, sd = train.agg(F.avg(c)).scalar(), train.agg(F.stddev_samp(c)).scalar()
            exprs[c] = F.try_divide(F.col(c) - mu, sd)
    return train.withColumns(exprs).drop(*drop), test.withColumns(exprs).drop(*drop)


def first_seen_index(df: DataFrame, label: str, order_cols: list) -> DataFrame:
    """MLX-14: label -> integer in first-seen order (by ``order_cols``); marked for broadcast
    where the labels are few, as its size is unknown to the planner, which would broadcast
    the rows it is joined to."""
    first = df.groupBy(label).agg(F.min(F.struct(*order_cols)).alias("_first"))
    from forecourt.operators.clean import sequence_number
    return small(sequence_number(first, ["_first"], out="label_index").drop("_first"))


# ------------------------------------------------------------------ fitting

def soft_vote(scored: dict[str, DataFrame], id_col: str, prob_col: str = "probability") -> DataFrame:
    """MLX-36: mean of the models' probability vectors, predicted class =
    position of the maximum."""
    parts = [df.select(id_col, vector_to_array(prob_col).alias("p")).withColumn("model", F.lit(n)) for n, df in scored.items()]
    u = reduce(lambda a, b: a.unionByName(b), parts)
    ex = u.select(id_col, F.posexplode("p").alias("cls", "p"))
    avg = ex.groupBy(id_col, "cls").agg(F.avg("p").alias("p"))
    return avg.groupBy(id_col).agg(F.max_by("cls", F.struct("p", -F.col("cls"))).alias("prediction"),
                                   F.max("p").alias("max_prob"))


def kmeans_best(df: DataFrame, features: str, k: int, restarts: int = 100, max_iter: int = 10, seed: int = 7):
    """The k-means model of the lowest cost among ``restarts`` seeds."""
    models = (KMeans(featuresCol=features, k=k, seed=seed + i, maxIter=max_iter, initSteps=2).fit(df) for i in range(restarts))
    return min(models, key=lambda m: m.summary.trainingCost)


def silhouettes(clustered: DataFrame, features: str, cluster: str = "prediction") -> DataFrame:
    """MLX-21: every row with its silhouette under squared distances, from the moments of
    the clusters: the mean squared distance of x to a cluster is |x - c|^2 + v, with c its
    centre and v its mean squared distance to it, so no pairs are formed.  The centres are
    broadcast: clusters x dimension numbers.  A cluster of one row has silhouette 0."""
    x = clustered.withColumn("_x", vector_to_array(features))
    at = x.select(cluster, F.posexplode("_x").alias("_i", "_v"))
    cells = at.groupBy(cluster, "_i").agg(F.count(F.lit(1)).alias("_n"), F.avg("_v").alias("_c"), F.var_pop("_v").alias("_w"))
    centres = cells.groupBy(cluster).agg(F.max("_n").alias("n"), F.sum("_w").alias("v"),
                                         F.transform(F.sort_array(F.collect_list(F.struct("_i", "_c"))), lambda s: s["_c"]).alias("c"))
    known = [r for r in centres.collect()]
    table = F.array(*[F.struct(F.lit(r[cluster]).alias("k"), F.lit(float(r["n"])).alias("n"), F.lit(r["v"]).alias("v"),
                               F.split(F.lit(",".join(map(repr, r["c"]))), ",").cast("array<double>").alias("c")) for r in known])

    def distance(s):
        return F.aggregate(F.zip_with("_x", s["c"], lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, d: t + d) + s["v"]
    x = x.withColumn("_d", F.transform(table, lambda s: F.struct(s["k"].alias("k"), s["n"].alias("n"), distance(s).alias("d"))))
    own = F.filter("_d", lambda s: s["k"] == F.col(cluster))[0]
    a = own["d"] * own["n"] / (own["n"] - 1)  # a row is no neighbour of its own
    b = F.array_min(F.transform(F.filter("_d", lambda s: s["k"] != F.col(cluster)), lambda s: s["d"]))
    s = F.when(own["n"] > 1, F.try_divide(b - a, F.greatest(a, b))).otherwise(F.lit(0.0))
    return x.withColumn("silhouette", F.coalesce(s, F.lit(0.0))).drop("_x", "_d")


def kmeans_scan(df: DataFrame, features: str, k_values: list[int], restarts: int = 100, seed: int = 7) -> DataFrame:
    """MLX-17: k-means per k, the best of ``restarts`` starts, with mean silhouette, inertia,
    Calinski-Harabasz and between-cluster share from the sums of squares (total SS =
    between + within; no pairwise distances)."""
    at = df.select(F.posexplode(vector_to_array(features)).alias("_i", "_v"))
    n = df.count()
    total_ss = at.groupBy("_i").agg((F.var_pop("_v") * F.count("_v")).alias("s")).agg(F.sum("s")).first()[0]
    rows = []
    for k in k_values:
        model = kmeans_best(df, features, k, restarts, seed=seed)
        inertia = model.summary.trainingCost
        sil = silhouettes(model.transform(df), features).agg(F.avg("silhouette")).first()[0]
        between = total_ss - inertia
        ch = (between / (k - 1)) / (inertia / (n - k)) if inertia > 0 else None
        rows.append((k, float(sil), float(inertia), ch, float(between / total_ss * 100)))
    return few_rows(df.sparkSession, rows, "k int, silhouette double, inertia double, calinski_harabasz double, between_pct double")


# --------------------------------------------------------------- evaluation

def classification_metrics(pairs: DataFrame, label: str, pred: str) -> DataFrame:
    """MLX-19: accuracy, per-class precision / recall / F1, micro, macro and
    weighted F1 from confusion counts (one aggregation)."""
    cells = pairs.groupBy(F.col(label).alias("l"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("c"))
    tp = cells.filter(F.col("l") == F.col("p")).select(F.col("l").alias("cls"), F.col("c").alias("tp"))
    support = cells.groupBy(F.col("l").alias("cls")).agg(F.sum("c").alias("support"))
    predicted = cells.groupBy(F.col("p").alias("cls")).agg(F.sum("c").alias("predicted"))
    per = (support.join(predicted, "cls", "full").join(tp, "cls", "left").na.fill(0, ["tp", "support", "predicted"])
                  .withColumn("precision", F.coalesce(F.try_divide(F.col("tp"), F.col("predicted")), F.lit(0.0)))
                  .withColumn("recall", F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))))
    per = per.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))
    return per


def classification_summary(per: DataFrame) -> DataFrame:
    n = F.sum("support")
    return per.agg((F.sum("tp") / n).alias("accuracy"), F.avg("f1").alias("f1_macro"),
                   (F.sum(F.col("f1") * F.col("support")) / n).alias("f1_weighted"),
                   (F.sum("tp") / n).alias("f1_micro"), F.avg("precision").alias("precision_macro"),
                   F.avg("recall").alias("recall_macro"))


def regression_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """MLX-20: MSE, RMSE, R2 (= 1 - SSE / SST)."""
    mu = df.agg(F.avg(label)).first()[0]   # one number to the driver
    r = df.agg(F.avg((F.col(label) - F.col(pred)) ** 2).alias("mse"),
               F.sum((F.col(label) - F.col(pred)) ** 2).alias("_sse"), F.sum((F.col(label) - mu) ** 2).alias("_sst"))
    return r.select("mse", F.sqrt("mse").alias("rmse"), (1 - F.col("_sse") / F.col("_sst")).alias("r2"))


def regression_metrics_of(df: DataFrame, label: str, preds: list[str]) -> list[tuple[float, float, float]]:
    """MLX-20 for several predictions in one pass: (MSE, RMSE, R2) of each."""
    error = [(F.col(label) - F.col(p)) ** 2 for p in preds]
    r = df.agg((F.var_pop(label) * F.count(label)).alias("sst"), *[x.alias(f"{n}{i}") for i, e in enumerate(error) for n, x in (("m", F.avg(e)), ("s", F.sum(e)))]).first()
    return [(float(r[f"m{i}"]), float(r[f"m{i}"] ** 0.5), float(1 - r[f"s{i}"] / r["sst"])) for i in range(len(preds))]


def roc_points(df: DataFrame, label: str, score: str, group: str | None = None, chunks: int = 200) -> DataFrame:
    """MLX-27: ROC curve points (one per distinct score, descending), each with the
    point before it; rates are null where a class is missing.  Computed on per-score counts as a scan over ``chunks`` score
    ranges, so no task holds the whole curve."""
    g = [group] if group else []
    c = df.groupBy(*g, score).agg(F.sum((F.col(label) == 1).cast("long")).alias("_p"),
                                  F.sum((F.col(label) != 1).cast("long")).alias("_n"))
    top, low = c.agg(F.max(score)).scalar(), c.agg(F.min(score)).scalar()
    chunk = F.floor(F.try_divide(top - F.col(score), top - low) * chunks)
    x = chunked_running(c, g, [F.desc(score)], chunk, ["_p", "_n"], [], "_r")
    if g:
        x = x.join(c.groupBy(*g).agg(F.sum("_p").alias("_tp"), F.sum("_n").alias("_tn")), g)
    else:
        x = x.withColumns({"_tp": c.agg(F.sum("_p")).scalar(), "_tn": c.agg(F.sum("_n")).scalar()})
    p, n = F.col("_r_cum__p"), F.col("_r_cum__n")
    return x.select(*g, score, F.try_divide(p, F.col("_tp")).alias("tpr"), F.try_divide(n, F.col("_tn")).alias("fpr"),
                    F.try_divide(p - F.col("_p"), F.col("_tp")).alias("tpr_before"), F.try_divide(n - F.col("_n"), F.col("_tn")).alias("fpr_before"))


def auc(points: DataFrame, group: str | None = None) -> DataFrame:
    """Trapezoid area under the points of ``roc_points``."""
    area = (F.col("fpr") - F.col("fpr_before")) * (F.col("tpr") + F.col("tpr_before")) / 2
    return points.groupBy(*([group] if group else [])).agg(F.sum(area).alias("auc"))


def knn_classify(rows: DataFrame, labelled: DataFrame, id_col: str, features: str, label: str, k: int = 5,
                 key_hash: Column | None = None, bound: int = 2000) -> DataFrame:
    """MLX-35: k-nearest-neighbour classifier.  The labelled set is a documented
    sample, the ``bound`` smallest hashes of the id, so that every row is scored
    exactly against a broadcast of known size; ties in distance go to the smaller
    id, ties in votes to the smaller label.  ``features``: array column."""
    h = knuth_hash(F.col(id_col)) if key_hash is None else key_hash
    known = labelled.select(id_col, features, label).where(F.col(features).isNotNull() & F.col(label).isNotNull())
    known = known.orderBy(h, id_col).limit(bound).toPandas().sort_values(id_col)
    shared = rows.sparkSession.sparkContext.broadcast((np.array(known[features].tolist(), dtype=float), known[label].to_numpy()))

    def run(frames):
        x, y = shared.value
        classes = np.unique(y)
        for pdf in frames:
            out = []
            for v in pdf[features]:
                near = np.argsort(((x - np.asarray(v, dtype=float)) ** 2).sum(axis=1), kind="stable")[:k]
                out.append(classes[np.argmax([(y[near] == c).sum() for c in classes])])
            yield pd.DataFrame({id_col: pdf[id_col], "prediction": np.array(out, dtype="int64")})

    return (rows.select(id_col, features).where(F.col(features).isNotNull())
            .mapInPandas(run, f"{id_col} bigint, prediction bigint"))


def model_choice(results: DataFrame, metric: str, threshold: float, previous: float | None, tolerance: float = 0.02) -> DataFrame:
    """MLX-25: best model above the threshold; against the previous run's
    score: worse beyond tolerance -> keep (0), within tolerance -> replace
    (1), equal -> replace (2), better -> replace (3), no candidate -> keep
    (4)."""
    best = results.filter(F.col(metric) > threshold).agg(F.max_by("model", F.struct(metric, F.col("model"))).alias("best_model"),
                                                          F.max(metric).alias("best_score"))
    prev = F.lit(previous) if previous is not None else F.lit(None).cast("double")
    flag = (F.when(F.col("best_model").isNull(), 4)
             .when(prev.isNull() | (F.col("best_score") > prev), 3)
             .when(F.col("best_score") == prev, 2)
             .when(prev - F.col("best_score") <= tolerance, 1).otherwise(0))
    return best.withColumn("choice_flag", flag.cast("bigint"))


def save_model(model: PipelineModel, path: str) -> None:
    """MLX-33: persistence through MLlib's writer (shared storage)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def vectors(df: DataFrame, array_col: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(array_col)))


def assemble(cols: list[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep")


def eval_f1(label: str = "label") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(metricName="f1", labelCol=label)


def eval_rmse(label: str = "label") -> RegressionEvaluator:
    return RegressionEvaluator(metricName="rmse", labelCol=label)
