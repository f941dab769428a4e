"""MTH-* measures, DAT-* date helpers, JSN-01 payloads."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, LongType, DoubleType

from forecourt.functions import measures as M
from forecourt.functions.fmt import big, dstr, rnd, sql_rnd
from forecourt.plans.registry import query
from forecourt.sources.fixtures import (COLLAPSE_SQL, CONTRACTS_SQL, IMPORTER_SQL, LANG_PRED_SQL, collapse_input,
                                        contracts, importer_sales, lang_predictions)
from forecourt.sources.tables import LINE_KEY, read

LK = ", ".join(LINE_KEY)
ORACLE: dict[str, str] = {}


def sql(name, text):
    ORACLE[name] = text.strip()


MEASURE_MAP = {2: "measure_2", 3: "measure_3", 4: "measure_4", 5: "measure_5", 13: "measure_13", 14: "measure_14"}
MTH03_OUT = ["Total_Sales", "Total_Discount", "Total_Discount_pct", "Total_Net_Sales", "Total_Cost", "Fixed_Margin_I",
             "Fixed_Margin_I_pct", "Quality_Margin", "Total_Network_Support", "Fixed_Margin_II", "Fixed_Margin_II_pct",
             "HME_Support"]


@query("mth_03_importer_measures")
def mth03(spark, d):
    x = M.importer_measures(collapse_input(spark, d), MEASURE_MAP)
    return x.select(*LINE_KEY, *[rnd(c).alias(c) for c in MTH03_OUT])


def _mth03_sql():
    def g(i):
        return MEASURE_MAP.get(i, "0.0")
    ts = f"{g(2)} + {g(3)} + {g(4)}"
    td = f"{g(5)} + {g(6)} + {g(7)}"
    net = f"({g(2)} - {g(5)}) + ({g(3)} - {g(6)}) + ({g(4)} - {g(7)})"
    fm1 = (f"(((({g(2)} - {g(5)}) + ({g(3)} - {g(6)})) + ({g(4)} - {g(7)})) + (({g(9)} + {g(10)}) + ({g(11)} + {g(12)}))"
           f" + (({g(13)} + {g(14)}) + {g(15)}))")
    q = f"{g(17)} + {g(18)} + {g(19)} + {g(20)} + {g(40)} + {g(41)} + {g(42)}"
    sup = "(" + q + ")" + "".join(f" + {g(i)}" for i in (21, 22, 23, 24, 25, 26, 27, 28, 29, 30, 40, 41, 42, 43))

    def ratio(n, dd):
        return f"CASE WHEN ({dd}) = 0 THEN (CASE WHEN ({n}) = 0 THEN NULL ELSE 0.0 END) ELSE ({n}) / ({dd}) END"
    cols = {"Total_Sales": ts, "Total_Discount": td, "Total_Discount_pct": ratio(td, ts), "Total_Net_Sales": net,
            "Total_Cost": f"{g(9)} + {g(10)} + {g(11)} + {g(12)}", "Fixed_Margin_I": fm1,
            "Fixed_Margin_I_pct": ratio(fm1, net), "Quality_Margin": q, "Total_Network_Support": sup,
            "Fixed_Margin_II": f"({fm1}) + ({sup})", "Fixed_Margin_II_pct": ratio(f"({fm1}) + ({sup})", net),
            "HME_Support": f"{g(13)} + {g(14)} + {g(15)}"}
    return f"WITH {COLLAPSE_SQL.strip()} SELECT {LK}, " + ", ".join(f"{sql_rnd(e)} AS {k}" for k, e in cols.items()) + " FROM collapse_input"


sql("mth_03_importer_measures", _mth03_sql())


@query("mth_04_zscore")
def mth04(spark, d):
    li = read(spark, d, "lineitem", *LINE_KEY, "l_discount")
    z = M.zscore(li.withColumn("zq", F.col("l_quantity")).withColumn("zd", F.col("l_discount")), ["zq", "zd"])
    return z.select(*LINE_KEY, rnd("zq", 6).alias("zq"), rnd("zd", 6).alias("zd"))


sql("mth_04_zscore", f"""SELECT {LK}, {sql_rnd('(l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_pop(l_quantity) FROM lineitem)', 6)} AS zq,
  {sql_rnd('(l_discount - (SELECT avg(l_discount) FROM lineitem)) / (SELECT stddev_pop(l_discount) FROM lineitem)', 6)} AS zd FROM lineitem""")


@query("mth_05_minmax_scaling")
def mth05(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_retailprice", "p_size")
    s = M.minmax(p, ["p_retailprice", "p_size"], suffix="_scaled")
    s = M.minmax_inverse(s, "p_retailprice_scaled", p, "p_retailprice", "p_retailprice_back")
    return s.select("p_partkey", rnd("p_retailprice_scaled", 6).alias("price_scaled"), rnd("p_size_scaled", 6).alias("size_scaled"),
                    rnd("p_retailprice_back", 4).alias("price_back"))


sql("mth_05_minmax_scaling", f"""WITH b AS (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi, min(p_size) AS slo, max(p_size) AS shi FROM part),
s AS (SELECT p_partkey, (p_retailprice - lo) / (hi - lo) AS ps, (p_size - slo) / (shi - slo) AS ss, lo, hi FROM part, b)
SELECT p_partkey, {sql_rnd('ps', 6)} AS price_scaled, {sql_rnd('ss', 6)} AS size_scaled, {sql_rnd('ps * (hi - lo) + lo', 4)} AS price_back FROM s""")


@query("mth_06_robust_scaling")
def mth06(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_retailprice")
    return M.robust_scale(p, ["p_retailprice"]).select("p_partkey", rnd("p_retailprice", 6).alias("price_robust"))


sql("mth_06_robust_scaling", f"""WITH q AS (SELECT quantile_cont(p_retailprice, 0.5) AS med, quantile_cont(p_retailprice, 0.25) AS q1, quantile_cont(p_retailprice, 0.75) AS q3 FROM part)
SELECT p_partkey, {sql_rnd('(p_retailprice - med) / (q3 - q1)', 6)} AS price_robust FROM part, q""")


@query("mth_07_skewness_reduction")
def mth07(spark, d):
    li = read(spark, d, "lineitem", "l_quantity", "l_extendedprice", "l_tax")
    r = M.skew_report(li, ["l_quantity", "l_extendedprice", "l_tax"])
    return r.select("column_name", rnd("original_skew", 6).alias("original_skew"), rnd("log_skew", 6).alias("log_skew"), "applied")


sql("mth_07_skewness_reduction", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, {sql_rnd(f'skewness({c})', 6)} AS original_skew,
  {sql_rnd(f'skewness(ln(1 + {c})) * (count({c}) - 2) / sqrt(count({c}) * (count({c}) - 1))', 6)} AS log_skew,
  CAST(min({c}) >= 0 AND abs(skewness(ln(1 + {c})) * (count({c}) - 2) / sqrt(count({c}) * (count({c}) - 1))) < abs(skewness({c})) AS BIGINT) AS applied FROM lineitem"""
    for c in ["l_quantity", "l_extendedprice", "l_tax"]))

# Fixed score weights of this fixture (criterion -> weight); reversed =
# lower is better.
WEIGHTS = {"sum_qty": 0.3, "avg_price": 0.2, "avg_disc": 0.15, "n_orders": 0.15, "avg_tax": 0.1, "margin_ratio": 0.1}
REVERSED = ["avg_disc", "avg_tax"]


def config_criteria(spark, d):
    s = importer_sales(spark, d).join(read(spark, d, "lineitem", *LINE_KEY, "l_discount", "l_tax"), LINE_KEY)
    return s.groupBy("p_brand", "p_type").agg(
        F.sum("l_quantity").alias("sum_qty"), F.avg("l_extendedprice").alias("avg_price"), F.avg("l_discount").alias("avg_disc"),
        F.count_distinct("l_orderkey").cast("double").alias("n_orders"), F.avg("l_tax").alias("avg_tax"),
        F.avg(1 - F.col("l_discount")).alias("margin_ratio"))


def normalized_configs(spark, d):
    c = config_criteria(spark, d)
    n = M.minmax(c, list(WEIGHTS), reverse=REVERSED, suffix="_normalized")
    return n.na.fill(0.0, subset=["avg_tax_normalized", "margin_ratio_normalized"])


@query("mth_08_criteria_normalization")
def mth08(spark, d):
    n = normalized_configs(spark, d)
    return n.select("p_brand", "p_type", *[rnd(f"{c}_normalized", 6).alias(f"{c}_normalized") for c in WEIGHTS])


_CRIT_SQL = f"""{IMPORTER_SQL.strip()},
crit AS (SELECT s.p_brand, s.p_type, sum(s.l_quantity) AS sum_qty, avg(s.l_extendedprice) AS avg_price, avg(l.l_discount) AS avg_disc,
  CAST(count(DISTINCT s.l_orderkey) AS DOUBLE) AS n_orders, avg(l.l_tax) AS avg_tax, avg(1 - l.l_discount) AS margin_ratio
  FROM importer_sales s JOIN lineitem l USING ({LK}) GROUP BY s.p_brand, s.p_type),
nrm AS (SELECT p_brand, p_type, {', '.join(
    (f"(({c} - (SELECT max({c}) FROM crit)) / NULLIF((SELECT min({c}) FROM crit) - (SELECT max({c}) FROM crit), 0))" if c in REVERSED
     else f"(({c} - (SELECT min({c}) FROM crit)) / NULLIF((SELECT max({c}) FROM crit) - (SELECT min({c}) FROM crit), 0))")
    + (" " if c not in ("avg_tax", "margin_ratio") else "") + f" AS {c}_normalized" for c in WEIGHTS)} FROM crit),
nrm2 AS (SELECT * REPLACE (coalesce(avg_tax_normalized, 0.0) AS avg_tax_normalized, coalesce(margin_ratio_normalized, 0.0) AS margin_ratio_normalized) FROM nrm)"""

sql("mth_08_criteria_normalization", f"WITH {_CRIT_SQL} SELECT p_brand, p_type, " + ", ".join(
    f"{sql_rnd(f'{c}_normalized', 6)} AS {c}_normalized" for c in WEIGHTS) + " FROM nrm2")


@query("mth_09_weighted_score")
def mth09(spark, d):
    n = normalized_configs(spark, d)
    return n.select("p_brand", "p_type", rnd(M.weighted_score(WEIGHTS), 6).alias("score"))


sql("mth_09_weighted_score", f"WITH {_CRIT_SQL} SELECT p_brand, p_type, {sql_rnd(' + '.join(f'{c}_normalized * {w}' for c, w in WEIGHTS.items()), 6)} AS score FROM nrm2")

HISTORY_FILL = ["mean_repair_value_cust_full"]


def featured_contracts(spark, d):
    c = contracts(spark, d)
    x = (c.withColumn("power_weight_ratio", F.col("power_kw") / F.col("weight_empty"))
          .withColumn("contract_km", F.col("contract_km") / 1000)
          .withColumn("contract_start_month", F.month("contract_start_date"))
          .withColumnsRenamed({"target": "target_cost", "target_QIV": "target_qiv", "target_DP": "target_dp"})
          .na.fill(0.0, subset=HISTORY_FILL))
    # Fixed coverage prefixes (values the reference simplifies to).
    x = (x.withColumn("LL", F.when(F.col("LL").startswith("€50.000.000"), F.lit("€50.000.000")).otherwise(F.col("LL")))
          .withColumn("AR", F.nullif(F.regexp_extract("AR", r"^(.+%)", 1), F.lit("")))
          .withColumn("FI", F.when(F.col("FI").startswith("Até €1.000/Ano"), F.lit("Até €1.000/Ano")).otherwise(F.col("FI"))))
    return x.na.fill("0", subset=["LL", "AR", "FI", "fuel"])


@query("mth_10_contract_features")
def mth10(spark, d):
    x = featured_contracts(spark, d)
    return x.select("contract_customer", rnd("power_weight_ratio", 6).alias("power_weight_ratio"), rnd("contract_km", 4).alias("contract_km"),
                    big("contract_start_month").alias("contract_start_month"), rnd("target_cost", 2).alias("target_cost"),
                    rnd("mean_repair_value_cust_full", 4).alias("mean_repair_value_cust_full"), "LL", "AR", "FI", "fuel")


sql("mth_10_contract_features", f"""WITH {CONTRACTS_SQL.strip()}
SELECT contract_customer, {sql_rnd('power_kw / weight_empty', 6)} AS power_weight_ratio, {sql_rnd('contract_km / 1000')} AS contract_km,
  CAST(month(contract_start_date) AS BIGINT) AS contract_start_month, {sql_rnd('target', 2)} AS target_cost,
  {sql_rnd('coalesce(mean_repair_value_cust_full, 0.0)')} AS mean_repair_value_cust_full,
  coalesce(CASE WHEN starts_with(LL, '€50.000.000') THEN '€50.000.000' ELSE LL END, '0') AS LL,
  coalesce(nullif(regexp_extract(AR, '^(.+%)', 1), ''), '0') AS AR,
  coalesce(CASE WHEN starts_with(FI, 'Até €1.000/Ano') THEN 'Até €1.000/Ano' ELSE FI END, '0') AS FI,
  coalesce(fuel, '0') AS fuel FROM contracts""")


def _pred_probs(spark, d):
    lp = lang_predictions(spark, d)
    doc = read(spark, d, "documents", "doc_id", "text")
    x = lp.join(doc, "doc_id").withColumn("max_prob", (F.col("doc_id") % 100) / 100.0)
    return x.withColumn("text_copy", F.when(F.col("text").contains(" und "), F.lit("de")).otherwise(F.col("text")))


@query("mth_11_probability_thresholds")
def mth11(spark, d):
    x = M.threshold_predictions(_pred_probs(spark, d), "max_prob", "predicted")
    return x.select("doc_id", *[f"New_Prediction_{t}" for t in ("50", "80", "85", "90", "95")])


_TH = [("50", 0.5, "<="), ("80", 0.8, "<"), ("85", 0.85, "<"), ("90", 0.9, "<"), ("95", 0.95, "<")]
_PP_SQL = f"""{LANG_PRED_SQL.strip()},
pp AS (SELECT lp.doc_id, lp.predicted, (lp.doc_id % 100) / 100.0 AS max_prob, d.text,
  CASE WHEN contains(d.text, ' und ') THEN 'de' ELSE d.text END AS text_copy FROM lang_pred lp JOIN documents d USING (doc_id)),
th AS (SELECT *, {', '.join(f"CASE WHEN max_prob {op} {cut} THEN '1' ELSE predicted END AS New_Prediction_{t}" for t, cut, op in _TH)} FROM pp)"""

sql("mth_11_probability_thresholds", f"WITH {_PP_SQL} SELECT doc_id, " + ", ".join(f"New_Prediction_{t}" for t, _, _ in _TH) + " FROM th")


@query("mth_12_forced_predictions")
def mth12(spark, d):
    x = M.threshold_predictions(_pred_probs(spark, d), "max_prob", "predicted")
    x = M.force_predictions(x, "text", "text_copy", "max_prob", "predicted")
    return x.select("doc_id", rnd("max_prob").alias("max_prob"), "predicted", *[f"New_Prediction_{t}" for t in ("50", "80", "85", "90", "95")])


sql("mth_12_forced_predictions", f"""WITH {_PP_SQL} SELECT doc_id, {sql_rnd("CASE WHEN text <> text_copy THEN 1.0 ELSE max_prob END")} AS max_prob,
  CASE WHEN text <> text_copy THEN text_copy ELSE predicted END AS predicted, """ + ", ".join(
    f"CASE WHEN text <> text_copy THEN text_copy ELSE New_Prediction_{t} END AS New_Prediction_{t}" for t, _, _ in _TH) + " FROM th")


@query("dat_01_time_tags")
def dat01(spark, d):
    e = read(spark, d, "events", "event_id", "ts")
    return e.select("event_id", *M.time_tags(F.col("ts")))


sql("dat_01_time_tags", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS date_tag, strftime(ts, '%H:%M:%S') AS time_tag FROM events")


@query("dat_02_year_to_date")
def dat02(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_orderdate")
    ps, pm = M.year_to_date(F.col("o_orderdate"))
    return o.select("o_orderkey", dstr(ps).alias("period_start"), big(pm).alias("period_months"))


sql("dat_02_year_to_date", "SELECT o_orderkey, strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS period_start, CAST(month(o_orderdate) AS BIGINT) AS period_months FROM orders")


@query("dat_04_split_date")
def dat04(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_orderdate")
    return o.select("o_orderkey", dstr(M.split_date(F.col("o_orderdate"))).alias("split_date"))


sql("dat_04_split_date", "SELECT o_orderkey, strftime(date_trunc('month', o_orderdate - INTERVAL 37 MONTH), '%Y-%m-%d') AS split_date FROM orders")

PAYLOAD = StructType([StructField("event_id", LongType()), StructField("value", DoubleType())])


@query("jsn_01_json_round_trip")
def jsn01(spark, d):
    e = read(spark, d, "events", "event_id", "value", "props", "user_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    payload = e.groupBy("user_id").agg(F.to_json(F.sort_array(F.collect_list(F.struct("event_id", "value")))).alias("records"))
    back = payload.select(F.explode(F.from_json("records", "array<struct<event_id:bigint,value:double>>")).alias("r")).select("r.*")
    return e.select("event_id", k.alias("k")).join(back, "event_id").select("event_id", "k", rnd("value").alias("value"))


sql("jsn_01_json_round_trip", f"SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, {sql_rnd('value')} AS value FROM events")
