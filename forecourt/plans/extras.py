"""Remaining inventory rows: sink and reader variants, model result tables,
job compositions, lemmatisation, isolation forest, small helpers."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from forecourt.functions import text as T
from forecourt.functions.fmt import big, dstr, rnd, sql_rnd
from forecourt.operators import aggs, clean, forest, joins, ledger, ml, search, windows
from forecourt.plans import parts as PP
from forecourt.plans import retail as PR
from forecourt.plans.registry import query
from forecourt.session import materialize, scratch_table_path
from forecourt.sources import io
from forecourt.sources.fixtures import (ODOMETER_SQL, REQUESTS_SQL, LANG_PRED_SQL, contracts, lang_predictions, odometer,
                                        requests)
from forecourt.sources.tables import LINE_KEY, read

LK = ", ".join(LINE_KEY)
ORACLE: dict[str, str] = {}


def sql(name, text):
    ORACLE[name] = text.strip()


def _run():
    return uuid.uuid4().hex[:8]


@query("agg_09_solver_dataset")
def agg09(spark, d):
    m = PP.metrics(spark, d)
    ta = ledger.part_type(PP._ta_input(spark, d), "part", "product_group", "part_desc", PP.OIL_WORDS)
    current = F.date_add(PP.period(spark, d)[1], 1)
    bd = ledger.business_days(F.add_months(current, -12), current)
    return m.join(ta, "part", "left").select("part", "ta", F.lit("P0").alias("pse_code"), big(bd).alias("business_days"),
                                             rnd("dii_year_weekdays_v2").alias("dii_year_weekdays_v2"))


def _agg09_sql():
    oil = " OR ".join(f"contains(lower(dsc), '{w}')" for w in PP.OIL_WORDS)
    return f"""WITH {PP._METRICS_SQL},
tx AS (SELECT l.l_partkey AS part, CASE WHEN l.l_linestatus = 'O' THEN l.l_returnflag ELSE l.l_returnflag || CAST(l.l_linenumber AS VARCHAR) END AS g,
  p.p_name AS dsc FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
mg AS (SELECT part, g FROM (SELECT part, g, row_number() OVER (PARTITION BY part ORDER BY count(*) DESC, g) AS rn FROM tx WHERE g IS NOT NULL GROUP BY part, g) WHERE rn = 1),
md AS (SELECT part, dsc FROM (SELECT part, dsc, row_number() OVER (PARTITION BY part ORDER BY count(*) DESC, dsc) AS rn FROM tx WHERE g IS NOT NULL GROUP BY part, dsc) WHERE rn = 1),
tt AS (SELECT part, CASE WHEN length(g) >= 2 THEN substr(g, 2, 1) WHEN {oil} THEN '1' ELSE 'NO_TA' END AS ta FROM mg JOIN md USING (part))
SELECT mm.part, tt.ta, 'P0' AS pse_code, CAST({PP._BDAYS} AS BIGINT) AS business_days, {sql_rnd('dii_year_weekdays_v2')} AS dii_year_weekdays_v2
FROM mm LEFT JOIN tt USING (part)"""


sql("agg_09_solver_dataset", _agg09_sql())


@query("agg_36_ledger_per_part")
def agg36(spark, d):
    x = PP.the_ledger(spark, d)  # a row per part: the one that holds at the end of the period
    return x.where(F.col("valid_to") == PP.period(spark, d)[1]).select("part", rnd("stock_end").alias("stock_end"), rnd("offset").alias("offset"),
                                                                       "stock_evolution_correct_flag")


sql("agg_36_ledger_per_part", f"WITH {PP._LEDGER_SQL} SELECT DISTINCT part, {sql_rnd('stock_end')} AS stock_end, {sql_rnd(chr(34) + 'offset' + chr(34))} AS \"offset\", stock_evolution_correct_flag FROM led")


@query("app_03_confusion_by_class")
def app03(spark, d):
    path = scratch_table_path(spark, f"app03_{_run()}")
    io.write_table(io.confusion_table(lang_predictions(spark, d), "actual", "predicted", ["de", "en", "es", "fr"]), path)
    t = io.scan_filter(spark.read.parquet(path), columns=["Actual", "de", "en", "es", "fr", "Totals"])
    return t.select("Actual", *[big(c).alias(c) for c in ["de", "en", "es", "fr", "Totals"]])


sql("app_03_confusion_by_class", f"""WITH {LANG_PRED_SQL.strip()} SELECT actual AS Actual, {', '.join(f"CAST(count(*) FILTER (WHERE predicted = '{c}') AS BIGINT) AS {c}" for c in ['de', 'en', 'es', 'fr'])},
  CAST(count(*) AS BIGINT) AS Totals FROM lang_pred GROUP BY actual""")


@query("job_02_retail_b_scored")
def job02(spark, d):
    from forecourt.operators import classify as C
    from forecourt.plans.classify import _model_desc
    base = materialize(PR.scored(spark, d))
    md = _model_desc(spark, d).select(F.col("p_partkey").alias("l_partkey"), C.model_name(F.col("model_desc"), "first_word").alias("model"),
                                      C.engine_token(F.lower("model_desc")).alias("engine"))
    x = base.join(md, "l_partkey", "left").withColumn("engine", F.when(F.col("ptype") == "PROMO", F.lit("N/A")).otherwise(F.col("engine")))
    h = windows.previous_sales_features(x, ["brand", "model"], PR.ORDER, chunk=F.trunc("sale_date", "month"))
    out = aggs.multi_grain_averages(h, ["brand", "model"], [("", []), ("_local", ["place"])], source=x)
    return out.select(*LINE_KEY, "model", "engine", "number_prev_sales", "nr_cars_sold", "average_score_local")


@query("job_07_service_desk_inputs")
def job07(spark, d):
    r = requests(spark, d)
    kw = io.mapping_long(spark.createDataFrame([("Access", "of the", "del", 2), ("Billing", "from;with", None, 1)],
                                               "label string, kw_pt string, kw_es string, rank int"), "label", ["kw_pt", "kw_es"], "rank")
    cats = r.groupBy("category").agg(F.count(F.lit(1)).alias("n_requests"))
    n_kw = kw.agg(F.count(F.lit(1))).scalar()
    return r.join(cats, "category").select("request_num", "category", "n_requests", n_kw.alias("n_keywords"))


sql("job_07_service_desk_inputs", f"WITH {REQUESTS_SQL.strip()} SELECT request_num, category, count(*) OVER (PARTITION BY category) AS n_requests, 3 AS n_keywords FROM requests")


@query("jon_14_brand_dependent_join")
def jon14(spark, d):
    from forecourt.plans.jobs import opt05
    s = opt05(spark, d)
    codes = read(spark, d, "part", "p_brand", "p_type", "p_size").groupBy("p_brand", "p_type").agg(F.min("p_size").alias("factory_code"))
    codes_b = codes.groupBy("p_brand").agg(F.min("factory_code").alias("brand_code"))
    x = s.join(codes, ["p_brand", "p_type"], "left").join(codes_b, "p_brand", "left")
    # brand decides the join columns: brands 1-9 use (brand, type), others brand only
    return x.select("p_brand", "p_type", "quantity",
                    F.when(F.length("p_brand") <= 7, F.col("factory_code")).otherwise(F.col("brand_code")).cast("bigint").alias("factory_code"))


@query("jon_22_range_anti_join")
def jon22(spark, d):
    from forecourt.plans.windows import win06
    return win06(spark, d)


def _jon22_sql():
    from forecourt.plans.windows import ORACLE as WO
    return WO["win_06_mileage_repair_1"]


sql("jon_22_range_anti_join", _jon22_sql())


@query("mlx_04_encoder_apply")
def mlx04(spark, d):
    c = contracts(spark, d).na.fill({"fuel": "0"})
    tr, te = c.filter(F.col("contract_customer") % 4 != 0), c.filter(F.col("contract_customer") % 4 == 0)
    te = te.withColumn("make", F.when(F.col("contract_customer") % 8 == 0, F.lit("unseen")).otherwise(F.col("make")))
    model = ml.encoder_pipeline(["customer_group", "make", "fuel"]).fit(tr)
    out = model.transform(te)
    return out.select("contract_customer", F.size(vector_to_array("make_ohe")).alias("make_width"),
                      F.array_max(vector_to_array("make_ohe")).alias("known_make"))


def _parts_text_frame(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    idx = ml.first_seen_index(p, "p_type", ["p_partkey"]).withColumnRenamed("label_index", "label")
    return p.join(idx, "p_type").withColumn("split", F.when(F.col("p_partkey") % 4 == 0, "test").otherwise("train"))


@query("mlx_12_parts_feature_pipeline")
def mlx12(spark, d):
    from forecourt.plans.ml import part_features
    p = _parts_text_frame(spark, d)
    out = part_features().fit(p.filter("split = 'train'")).transform(p)
    return out.select("p_partkey", "split", F.col("label").cast("bigint").alias("label"), vector_to_array("features").alias("features"))


@query("mlx_13_requests_feature_pipeline")
def mlx13(spark, d):
    from forecourt.plans.ml import _doc_text_model_input, requests_features
    x = _doc_text_model_input(spark, d).withColumn("split", F.when(F.col("doc_id") % 4 == 0, "test").otherwise("train"))
    out = requests_features().fit(x.filter("split = 'train'")).transform(x)
    return out.select("doc_id", "split", vector_to_array("features").alias("features"))


def _binary_fits(spark, d, grids=search.CLASSIFIER_GRIDS, folds=search.FOLDS):
    """Whether a contract costs more than the mean: train and test rows and the searched models."""
    from forecourt.plans.ml import _contract_features
    x = materialize(_contract_features(spark, d).select("contract_customer", "customer_group", "features", "label"), "checkpoint")
    x = x.withColumn("label", (F.col("label") > x.agg(F.avg("label")).first()[0]).cast("double"))
    tr, te = x.filter(F.col("contract_customer") % 5 != 0), x.filter(F.col("contract_customer") % 5 == 0)
    return tr, te, search.classifiers(tr, "contract_customer", ml.eval_f1("label"), grids, folds)


def _few(*names):
    """Grids and folds of a short search of the estimators."""
    from forecourt.plans.ml import SEARCH
    return {n: SEARCH[n] for n in names or SEARCH}, search.FOLDS_TEXT


@query("mlx_22_classification_results")
def mlx22(spark, d):
    tr, te, found = _binary_fits(spark, d)
    return search.classification_results(found, {"train": tr, "test": te})


@query("mlx_23_regression_results")
def mlx23(spark, d):
    from forecourt.plans.ml import SEARCH_REGRESSION, _contract_features
    x = materialize(_contract_features(spark, d).select("contract_customer", "features", "label"), "checkpoint")
    tr, te = x.filter(F.col("contract_customer") % 5 != 0), x.filter(F.col("contract_customer") % 5 == 0)
    found = search.regressors(tr, "contract_customer", ml.eval_rmse("label"), SEARCH_REGRESSION, search.FOLDS_TEXT)
    return search.regression_results(found, {"train": tr, "test": te})


@query("mlx_24_probabilities")
def mlx24(spark, d):
    tr, te, found = _binary_fits(spark, d, *_few("lr", "rf", "bayes"))
    frames = [search.probabilities(f, df).select("contract_customer", F.lit(f.name).alias("model"), F.lit(n).alias("dataset"), rnd(F.get("p", F.lit(1)), 6).alias("p1"))
              for f in found for n, df in (("train", tr), ("test", te))]
    return reduce(lambda a, b: a.unionByName(b), frames)


@query("mlx_26_per_model_evaluation")
def mlx26(spark, d):
    tr, te, found = _binary_fits(spark, d, *_few())
    u = reduce(lambda a, b: a.unionByName(b), [f.model.transform(te).select("contract_customer", "customer_group", F.lit(f.name).alias("model"), "prediction") for f in found])
    return u.groupBy("model", "customer_group").agg(F.count(F.lit(1)).alias("n"), rnd(F.avg("prediction"), 6).alias("average_score_pred"))


@query("mlx_29_parts_model")
def mlx29(spark, d):
    """Features and classifier learned on train, scored on both; confusion
    counts per split with the mean of the highest probability."""
    from forecourt.plans.ml import part_features
    p = _parts_text_frame(spark, d).withColumn("label", F.col("label").cast("double"))
    train = p.filter("split = 'train'")
    fitted = part_features().fit(train)
    s = LogisticRegression(maxIter=20).fit(fitted.transform(train)).transform(fitted.transform(p))
    return s.groupBy("split", F.col("label").cast("bigint").alias("actual"), F.col("prediction").cast("bigint").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"), rnd(F.avg(F.array_max(vector_to_array("probability"))), 4).alias("mean_max_prob"))


@query("mlx_34_metric_rows")
def mlx34(spark, d):
    tr, te, found = _binary_fits(spark, d, *_few("lr", "dt"))
    res = search.classification_results(found, {"train": tr, "test": te}).withColumn("Date", F.lit("2001-01-01"))
    path = scratch_table_path(spark, f"mlx34_{_run()}")
    io.write_table(res, path, mode="append")
    return spark.read.parquet(path)


@query("prj_10_string_coercion")
def prj10(spark, d):
    e = read(spark, d, "events", "event_id", "value").withColumn("value", F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("value")))
    return e.select("event_id", F.coalesce(F.col("value").cast("decimal(18,2)").cast("string"), F.lit("nan")).alias("value_text"))


sql("prj_10_string_coercion", "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'nan' ELSE coalesce(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), 'nan') END AS value_text FROM events")


@query("prj_22_numeric_columns")
def prj22(spark, d):
    li = read(spark, d, "lineitem")
    return li.select(*[rnd(c, 2).alias(c) if t == "double" else F.col(c) for c, t in li.select(*clean.numeric_columns(li)).dtypes])


_DOUBLES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
sql("prj_22_numeric_columns", f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {', '.join(f'{sql_rnd(c, 2)} AS {c}' for c in _DOUBLES)} FROM lineitem")


@query("prj_23_category_codes")
def prj23(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_mktsegment")
    m = StringIndexer(inputCol="c_mktsegment", outputCol="segment_code", stringOrderType="frequencyDesc").fit(c)
    return m.transform(c).select("c_custkey", F.col("segment_code").cast("bigint").alias("segment_code"))


sql("prj_23_category_codes", """WITH k AS (SELECT c_mktsegment, CAST(row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS BIGINT) AS segment_code FROM customer GROUP BY c_mktsegment)
SELECT c.c_custkey, k.segment_code FROM customer c JOIN k USING (c_mktsegment)""")


@query("rul_03_request_matches")
def rul03(spark, d):
    from forecourt.plans.text import rul02
    return rul02(spark, d).select("request_num", "label", "rank")


def _rul03_sql():
    from forecourt.plans.text import _MATCH_SQL
    return f"WITH {_MATCH_SQL} SELECT request_num, label, CAST(rank AS BIGINT) AS rank FROM matches"


sql("rul_03_request_matches", _rul03_sql())


@query("snk_01_overwrite_frames")
def snk01(spark, d):
    base = scratch_table_path(spark, f"snk01_{_run()}")
    frames = {"orders_f": read(spark, d, "orders", "o_orderkey", "o_orderstatus").filter("o_orderstatus = 'F'"),
              "orders_o": read(spark, d, "orders", "o_orderkey", "o_orderstatus").filter("o_orderstatus = 'O'")}
    for n, f in frames.items():
        io.write_table(f, f"{base}/{n}")
        io.write_table(f, f"{base}/{n}")   # overwrite: second write replaces the first
    return spark.read.parquet(f"{base}/orders_f").unionByName(spark.read.parquet(f"{base}/orders_o"))


sql("snk_01_overwrite_frames", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O')")


@query("snk_03_batched_insert_cleanup")
def snk03(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_mktsegment")
    path = scratch_table_path(spark, f"snk03_{_run()}")
    io.append_rows(c, path, "2000-12-31")
    c = c.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 9 == 0, F.lit("NULL")).otherwise(F.col("c_mktsegment")))
    io.append_rows(c, path, "2001-01-01", truncate=True)   # the rows of the day before go
    return spark.read.parquet(path)


sql("snk_03_batched_insert_cleanup", "SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment, '2001-01-01' AS Date FROM customer")


@query("snk_04_single_row_append")
def snk04(spark, d):
    path = scratch_table_path(spark, f"snk04_{_run()}")
    row = io.stamp(read(spark, d, "orders", "o_orderkey").agg(F.count_distinct("o_orderkey").alias("units")).withColumn("project", F.lit("demo")), "2001-01-01")
    io.write_table(row, path, mode="append")
    return spark.read.parquet(path)


sql("snk_04_single_row_append", "SELECT count(DISTINCT o_orderkey) AS units, 'demo' AS project, '2001-01-01' AS Date FROM orders")


@query("snk_06_partition_overwrite")
def snk06(spark, d):
    path = scratch_table_path(spark, f"snk06_{_run()}")
    o = read(spark, d, "orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    io.write_table(o, path, partition_by=["o_orderstatus"])
    # replace only the 'P' partition (dynamic partition overwrite)
    io.write_table(o.filter("o_orderstatus = 'P'").withColumn("o_totalprice", F.lit(0.0)), path, partition_by=["o_orderstatus"])
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus", rnd("o_totalprice", 2).alias("o_totalprice"))


sql("snk_06_partition_overwrite", f"SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE {sql_rnd('o_totalprice', 2)} END AS o_totalprice FROM orders")


@query("snk_08_label_overwrite", stored=True)
def snk08(spark, d):
    doc = read(spark, d, "documents", "doc_id", "source").withColumnRenamed("source", "Label")
    manual = read(spark, d, "labels", "doc_id", "toxic").filter("toxic = 1").select("doc_id", F.lit("manual").alias("Label"))
    return io.keyed_update(doc, manual, ["doc_id"], ["Label"])


sql("snk_08_label_overwrite", "SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN 'manual' ELSE d.source END AS Label FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1) l USING (doc_id)")


@query("snk_09_version_match_update", stored=True)
def snk09(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_brand", "p_type", "p_name")
    table = p.select("p_partkey", F.lit("old").alias("matched"), F.lit(0).cast("bigint").alias("flag"))
    new = p.filter(F.col("p_brand") == "Brand#1").select("p_partkey", F.when(F.col("p_type") == "SMALL", F.col("p_name")).alias("matched"),
                                                         F.lit(1).cast("bigint").alias("flag"))
    return io.keyed_update(table, new, ["p_partkey"], ["matched", "flag"], set_null=True)


sql("snk_09_version_match_update", "SELECT p_partkey, CASE WHEN p_brand <> 'Brand#1' THEN 'old' WHEN p_type = 'SMALL' THEN p_name END AS matched, CAST(p_brand = 'Brand#1' AS BIGINT) AS flag FROM part")


@query("snk_14_retail_b_output", stored=True)
def snk14(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_acctbal", "c_mktsegment")
    return io.cast_output(c.withColumn("c_acctbal", rnd("c_acctbal", 2)), {"c_custkey": "VHE_Number", "c_acctbal": "Margin", "c_mktsegment": "Site"})


sql("snk_14_retail_b_output", f"SELECT CAST(c_custkey AS VARCHAR) AS VHE_Number, CAST({sql_rnd('c_acctbal', 2)} AS VARCHAR) AS Margin, c_mktsegment AS Site FROM customer")


@query("snk_15_importer_output", stored=True)
def snk15(spark, d):
    from forecourt.plans.jobs_importer import collapsed
    c = collapsed(spark, d).withColumn("invoice_date", F.when(F.col("quantity") == 0, F.lit(None)).otherwise(F.col("invoice_date")))
    return c.select(F.col("l_orderkey").alias("Chassis_Number"), dstr("invoice_date").alias("SLR_Document_Date_CHS"), rnd("measure_2", 2).alias("Measure_2"))


def _snk15_sql():
    from forecourt.plans.jobs_importer import ORACLE as JO
    s = JO["agg_32_vehicle_collapse"]
    head, tail = s.rsplit("SELECT l_orderkey, l_linenumber,", 1)
    return (head.rstrip() + ",\nfin AS (SELECT l_orderkey, l_linenumber," + tail + ")\n"
            "SELECT l_orderkey AS Chassis_Number, CASE WHEN quantity = 0 THEN NULL ELSE invoice_date END AS SLR_Document_Date_CHS, "
            "CAST(round_even(CAST(measure_2 AS DECIMAL(38,10)), 2) AS DOUBLE) AS Measure_2 FROM fin")


sql("snk_15_importer_output", _snk15_sql())


@query("snk_17_master_matched_output", stored=True)
def snk17(spark, d):
    from forecourt.plans.joins import jon04
    return jon04(spark, d).select(*LINE_KEY, F.coalesce("matched_desc", F.lit("")).alias("matched_desc"))


def _snk17_sql():
    from forecourt.plans.joins import ORACLE as JO
    s = JO["jon_04_cascade_match"]
    head, tail = s.rsplit("SELECT ", 1)
    return head + f"SELECT {LK}, coalesce(matched_desc, '') AS matched_desc FROM stock LEFT JOIN best USING (ref)"


sql("snk_17_master_matched_output", _snk17_sql())


@query("snk_18_classified_parts_output", stored=True)
def snk18(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_type", "p_retailprice").withColumn("family", F.when(F.col("p_partkey") % 9 == 0, F.lit(None)).otherwise(F.col("p_type")))
    x = p.na.drop(subset=["family"])
    return io.cast_output(x.select("p_partkey", "family", rnd("p_retailprice", 2).alias("p_retailprice")), {"p_partkey": "Part_Ref"})


sql("snk_18_classified_parts_output", f"SELECT CAST(p_partkey AS VARCHAR) AS Part_Ref, p_type AS family, CAST({sql_rnd('p_retailprice', 2)} AS VARCHAR) AS p_retailprice FROM part WHERE p_partkey % 9 <> 0")


@query("snk_19_requests_output", stored=True)
def snk19(spark, d):
    from forecourt.plans.text import rul01
    return io.cast_output(rul01(spark, d), {"request_num": "Request_Num", "label": "Label"})


def _snk19_sql():
    from forecourt.plans.text import _LABEL_SQL
    return f"WITH {_LABEL_SQL} SELECT CAST(request_num AS VARCHAR) AS Request_Num, label AS Label FROM final"


sql("snk_19_requests_output", _snk19_sql())


@query("snk_20_scored_contracts_file")
def snk20(spark, d):
    path = scratch_table_path(spark, f"snk20_{_run()}")
    c = contracts(spark, d).select("contract_customer", rnd("power_kw", 2).alias("power_kw"))
    c.write.mode("overwrite").option("header", True).csv(path)
    return io.read_delimited(spark, path, "contract_customer bigint, power_kw double")


sql("snk_20_scored_contracts_file", f"SELECT c_custkey AS contract_customer, {sql_rnd('abs(c_acctbal) + 50', 2)} AS power_kw FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey)")


@query("snk_24_family_override_append", stored=True)
def snk24(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_type")
    sel = p.filter(F.col("p_partkey") % 50 == 0).withColumn("p_type", F.lit("NEWFAM")).withColumn("source", F.lit("override"))
    return p.withColumn("source", F.lit("model")).unionByName(sel)


sql("snk_24_family_override_append", "SELECT p_partkey, p_type, 'model' AS source FROM part UNION ALL SELECT p_partkey, 'NEWFAM', 'override' FROM part WHERE p_partkey % 50 = 0")


@query("snk_25_rule_append", stored=True)
def snk25(spark, d):
    p = read(spark, d, "part", "p_retailprice")
    rule = p.agg(F.lit("starts").alias("match_type"), F.lit("red").alias("word"), F.lit("F-RED").alias("family"),
                 rnd(F.min("p_retailprice"), 2).alias("price_min"), rnd(F.max("p_retailprice"), 2).alias("price_max"))
    return rule


sql("snk_25_rule_append", f"SELECT 'starts' AS match_type, 'red' AS word, 'F-RED' AS family, {sql_rnd('min(p_retailprice)', 2)} AS price_min, {sql_rnd('max(p_retailprice)', 2)} AS price_max FROM part")


@query("snk_27_suggestion_replace", stored=True)
def snk27(spark, d):
    from forecourt.plans.alloc import opt02
    stored = opt02(spark, d).withColumn("client", F.lit("ALL"))
    new = stored.filter(F.col("p_type") == "SMALL").withColumn("quantity", F.col("quantity") + 1)
    return io.upsert(stored, new, ["p_type", "p_brand", "client"]).select("p_type", "p_brand", "client", "quantity")


def _snk27_sql():
    from forecourt.plans.alloc import _VEH_SQL
    return f"WITH {_VEH_SQL} SELECT p_type, p_brand, 'ALL' AS client, CASE WHEN p_type = 'SMALL' THEN quantity + 1 ELSE quantity END AS quantity FROM va"


sql("snk_27_suggestion_replace", _snk27_sql())


@query("src_08_headerless_semicolon")
def src08(spark, d):
    path = scratch_table_path(spark, f"src08_{_run()}")
    read(spark, d, "part", "p_partkey", "p_name", "p_type").write.mode("overwrite").option("sep", ";").option("header", False).csv(path)
    return io.read_delimited(spark, path, "part_ref string, part_desc string, extra string", sep=";", header=False, columns=["part_ref", "part_desc"])


sql("src_08_headerless_semicolon", "SELECT CAST(p_partkey AS VARCHAR) AS part_ref, p_name AS part_desc FROM part")


@query("src_10_manual_files_union")
def src10(spark, d):
    base = scratch_table_path(spark, f"src10_{_run()}")
    p = read(spark, d, "part", "p_partkey", "p_type")
    p.filter("p_partkey % 2 = 0").write.mode("overwrite").option("header", True).csv(f"{base}/a")
    p.filter("p_partkey % 2 = 1").write.mode("overwrite").option("header", True).csv(f"{base}/b")
    return io.read_delimited(spark, [f"{base}/a", f"{base}/b"], "p_partkey bigint, p_type string")


sql("src_10_manual_files_union", "SELECT p_partkey, p_type FROM part")


@query("src_11_classification_refs")
def src11(spark, d):
    return io.scan_filter(read(spark, d, "part"), columns=["p_partkey", "p_type"], renames={"p_type": "family"})


sql("src_11_classification_refs", "SELECT p_partkey, p_type AS family FROM part")

# Fixed lemma dictionary of this fixture (inflected -> lemma).
LEMMAS = {"the": "the", "was": "be", "are": "be", "is": "be", "les": "le", "des": "de"}


@query("str_12_lemmatisation")
def str12(spark, d):
    doc = read(spark, d, "documents", "doc_id", "text").withColumn("tokens", aggs.tokens(F.col("text")))
    table = spark.createDataFrame(list(LEMMAS.items()), "word string, stem string")
    out = T.apply_word_table(doc, "doc_id", "tokens", table, "lemmas")
    return out.select("doc_id", F.size(F.filter("lemmas", lambda x: x == "be")).alias("n_be"))


sql("str_12_lemmatisation", f"""SELECT doc_id, CAST(len(list_filter(list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda t: t <> ''), lambda x: x IN ('was', 'are', 'is', 'be'))) AS INT) AS n_be FROM documents""")


@query("win_02_history_driver")
def win02(spark, d):
    s = materialize(PR.scored(spark, d).na.drop().select(*PR.HIST_IN))
    h = windows.previous_sales_features(s, PR.CONFIG, PR.ORDER, chunk=F.trunc("sale_date", "month"))
    return h.select(*LINE_KEY, *PR.CONFIG, *PR._fmt(PR.HIST_OUT))


sql("win_02_history_driver", PR.ORACLE["win_01_previous_sales"])

IF_LEVELS = 24  # of the twin: more than any group's depth limit here


@query("win_19_isolation_forest")
def win19(spark, d):
    """WIN-19: 100 trees a vehicle and owner over all its readings."""
    o = windows.keep_group_max(odometer(spark, d), ["vehicle", "owner", "day"], "kms")
    x = forest.isolation_outliers(o, ["vehicle", "owner"], "kms")
    return x.select("vehicle", "owner", "event_id", rnd("if_score", 6).alias("if_score"), "if_outlier")


def _win19_sql():
    def c(n):
        return f"CASE WHEN {n} > 2 THEN 2.0 * (ln(CAST({n} - 1 AS DOUBLE)) + 0.5772156649) - 2.0 * ({n} - 1) / {n} WHEN {n} = 2 THEN 1.0 ELSE 0.0 END"
    levels = []
    for k in range(IF_LEVELS):
        levels.append(f"""w{k} AS MATERIALIZED (SELECT *, min(v) OVER w AS lo, max(v) OVER w AS hi, sum(c) OVER w AS size FROM l{k} WINDOW w AS (PARTITION BY vehicle, owner, tree, node)),
e{k} AS (SELECT vehicle, owner, v, n, sum(CAST(floor(({k} + {c('size')}) * 1000000000 + 0.5) AS BIGINT)) AS path FROM w{k} WHERE lo = hi OR lim <= {k} GROUP BY ALL),
l{k + 1} AS MATERIALIZED (SELECT vehicle, owner, v, c, n, lim, tree, node * 2 + CAST(v >= lo + (hi - lo) * ((CAST('0x' || substr(md5('17|' || vehicle || '|' || owner || '|' || tree || '|' || node), 1, 8) AS BIGINT) + 0.5) / 4294967296.0) AS BIGINT) AS node
  FROM w{k} WHERE NOT (lo = hi OR lim <= {k}))""")
    ended = " UNION ALL ".join(f"SELECT * FROM e{k}" for k in range(IF_LEVELS))
    return f"""WITH {ODOMETER_SQL.strip()},
s1 AS (SELECT * FROM (SELECT *, max(kms) OVER (PARTITION BY vehicle, owner, day) AS mx FROM odometer) WHERE kms = mx),
cn AS (SELECT vehicle, owner, CAST(kms AS DOUBLE) AS v, count(*) AS c FROM s1 GROUP BY ALL),
bs AS (SELECT *, sum(c) OVER (PARTITION BY vehicle, owner) AS n FROM cn),
l0 AS MATERIALIZED (SELECT vehicle, owner, v, c, n, ceil(log2(greatest(n, 2))) AS lim, tree, CAST(1 AS BIGINT) AS node FROM bs, range(1, 101) t(tree)),
{', '.join(levels)},
p AS (SELECT vehicle, owner, v, n, sum(path) AS path FROM ({ended}) GROUP BY ALL),
sc AS (SELECT s1.vehicle, s1.owner, event_id, pow(2.0, -(CAST(path AS DOUBLE) / 1000000000 / 100) / CASE WHEN n > 2 THEN {c('n')} ELSE 1.0 END) AS if_score
  FROM s1 JOIN p ON s1.vehicle = p.vehicle AND s1.owner = p.owner AND CAST(s1.kms AS DOUBLE) = p.v),
th AS (SELECT vehicle, owner, quantile_cont(if_score, 0.9) AS t FROM sc GROUP BY ALL)
SELECT vehicle, owner, event_id, {sql_rnd('if_score', 6)} AS if_score, CAST({sql_rnd('if_score', 6)} > {sql_rnd('t', 6)} AS BIGINT) AS if_outlier FROM sc JOIN th USING (vehicle, owner)"""


sql("win_19_isolation_forest", _win19_sql())

# ------------------------------------------------- SQL twins of composed queries


def _nested(module, name):
    import importlib
    return importlib.import_module(f"forecourt.plans.{module}").ORACLE[name]


sql("jon_14_brand_dependent_join", f"""WITH s AS ({_nested("jobs", "opt_05_importer_suggestion")}),
codes AS (SELECT p_brand, p_type, min(p_size) AS code FROM part GROUP BY p_brand, p_type),
brands AS (SELECT p_brand, min(code) AS code FROM codes GROUP BY p_brand)
SELECT s.p_brand, s.p_type, s.quantity, CAST(CASE WHEN length(s.p_brand) <= 7 THEN c.code ELSE b.code END AS BIGINT) AS factory_code
FROM s LEFT JOIN codes c USING (p_brand, p_type) LEFT JOIN brands b USING (p_brand)""")
sql("app_02_parts_screen", _agg09_sql().rsplit("SELECT mm.part", 1)[0]
    + f"SELECT mm.part, tt.ta, {sql_rnd('days_to_sell_1_part', 6)} AS days_to_sell_1_part, {sql_rnd('cost')} AS cost "
      "FROM mm JOIN tt USING (part) WHERE days_to_sell_1_part > 0 AND ta NOT IN ('NO_TA', 'Outros')")


def _job10_sql():
    first = _nested("windows", "win_06_mileage_repair_1").rsplit("SELECT ", 1)[0].replace("kept AS (", "kept1 AS (")
    second = _nested("windows", "win_07_mileage_repair_2").split("rk AS (", 1)[1]
    again = """x2 AS (SELECT * EXCLUDE (pos), row_number() OVER (PARTITION BY vehicle, owner ORDER BY day, event_id) AS pos FROM kept1),
gg AS (SELECT vehicle, owner, kms AS gk, min(day) AS dmin, max(day) AS dmax FROM x2 GROUP BY vehicle, owner, kms
      HAVING count(*) > 1 AND max(pos) - min(pos) + 1 > count(*)),
"""
    import re
    second = re.sub(r"\bx\b", "x2", "rk AS (" + second)
    second = re.sub(r"\bFROM g JOIN\b", "FROM gg g JOIN", second)
    return first.rstrip() + ",\n" + again + second


sql("job_10_odometer_repair", _job10_sql())
