"""End-to-end jobs (JOB-*), app datasets (APP-*) and the composed operators
(OPT-05 / OPT-06, AGG-04, AGG-26, WIN-12, WIN-20, RUL-08, RUL-09).  Jobs are
compositions of the registered operators; the pieces carry SQL twins, the
ML-bearing jobs are rows-only."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from forecourt.functions import measures as M
from forecourt.functions import text as T
from forecourt.functions.fmt import big, dstr, rnd, sql_rnd
from forecourt.operators import aggs, alloc, clean, joins, ledger, rules, windows
from forecourt.plans import alloc as PA
from forecourt.plans import measures as PM
from forecourt.operators.quantiles import quantile_values
from forecourt.plans import parts as PP
from forecourt.plans import retail as PR
from forecourt.plans.registry import query
from forecourt.session import materialize
from forecourt.sources import io
from forecourt.sources.fixtures import (CONTRACTS_SQL, EVENTS_GAPS_SQL, ODOMETER_SQL, REQUESTS_SQL, contracts, odometer,
                                        requests)
from forecourt.sources.tables import LINE_KEY, read

LK = ", ".join(LINE_KEY)
ORACLE: dict[str, str] = {}


def sql(name, text):
    ORACLE[name] = text.strip()


# ------------------------------------------------------------- OPT-05 / 06
SEL_TYPE, MIN_SOLD, TOP_N, ORDER_SIZE = "SMALL", 100.0, 5, 50


@query("opt_05_importer_suggestion")
def opt05(spark, d):
    n = PM.normalized_configs(spark, d).withColumn("score", M.weighted_score(PM.WEIGHTS))
    f = clean.dash_filter(n, [SEL_TYPE, MIN_SOLD], ["p_type", "sum_qty"], qty_col="sum_qty")
    w = Window.partitionBy("p_type").orderBy(F.desc("score"), "p_brand")
    top = f.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= TOP_N).drop("_r")
    q = windows.quantity_share(top, ["p_type"], "score", ORDER_SIZE, [], repair=False)
    co2 = n.filter(F.col("p_type") == SEL_TYPE).withColumn("nedc", F.col("avg_tax") * 100)
    total, co2_total = co2.agg(F.sum("sum_qty")).scalar(), co2.agg(F.sum(F.col("sum_qty") * F.col("nedc"))).scalar()
    qn = q.join(co2.select("p_brand", "p_type", "nedc"), ["p_brand", "p_type"])
    add_q, add_c = qn.agg(F.sum("quantity")).scalar(), qn.agg(F.sum(F.col("quantity") * F.col("nedc"))).scalar()
    return qn.select("p_brand", "p_type", "quantity", rnd("score", 6).alias("score"),
                     rnd(co2_total / total, 6).alias("co2_before"), rnd((co2_total + add_c) / (total + add_q), 6).alias("co2_after"))


sql("opt_05_importer_suggestion", f"""WITH {PM._CRIT_SQL},
sc AS (SELECT n.*, c.sum_qty, c.avg_tax, {' + '.join(f'{k}_normalized * {v}' for k, v in PM.WEIGHTS.items())} AS score FROM nrm2 n JOIN crit c USING (p_brand, p_type)),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY score DESC, p_brand) AS r FROM sc WHERE p_type = '{SEL_TYPE}' AND sum_qty >= {MIN_SOLD}) WHERE r <= {TOP_N}),
q AS (SELECT *, CAST(CAST(round_even(CAST(score / sum(score) OVER (PARTITION BY p_type) * {ORDER_SIZE} AS DECIMAL(38,10)), 0) AS DOUBLE) AS BIGINT) AS quantity FROM top),
co2 AS (SELECT p_brand, sum_qty, avg_tax * 100 AS nedc FROM sc WHERE p_type = '{SEL_TYPE}'),
tot AS (SELECT sum(sum_qty) AS t, sum(sum_qty * nedc) AS c FROM co2),
add AS (SELECT sum(q.quantity) AS aq, sum(q.quantity * co2.nedc) AS ac FROM q JOIN co2 USING (p_brand))
SELECT p_brand, p_type, quantity, {sql_rnd('score', 6)} AS score, {sql_rnd('(SELECT c / t FROM tot)', 6)} AS co2_before,
  {sql_rnd('(SELECT (c + ac) / (t + aq) FROM tot, add)', 6)} AS co2_after FROM q""")

MIN_CONFIGS = 8


@query("opt_06_retail_suggestion")
def opt06(spark, d):
    c = clean.generic_filter(PA.configurations(spark, d), [10, ["SMALL", "LARGE", "MEDIUM"]], ["n", "p_type"], ["ge", "in"])
    c = aggs.group_number(c, ["p_type", "p_brand"], out="configuration_id")
    a = alloc.vehicles_allocation(c, ["p_type"], ["p_brand"], "score", F.lit(PA.ORDER_SIZE))
    chosen = a.groupBy("p_type").agg(F.sum((F.col("quantity") > 0).cast("int")).alias("_sel"))
    a = a.join(chosen, "p_type")
    w = Window.partitionBy("p_type").orderBy(F.desc("score"), "p_brand")
    comp = a.filter(F.col("quantity") == 0).withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= F.lit(MIN_CONFIGS) - F.col("_sel"))
    sel = a.filter(F.col("quantity") > 0).select(*c.columns).unionByName(comp.select(*c.columns))
    out = windows.quantity_share(sel, ["p_type"], "score", PA.ORDER_SIZE, [F.desc("score"), "p_brand"])
    return out.select("p_type", "p_brand", "configuration_id", "quantity")


sql("opt_06_retail_suggestion", f"""WITH {PA.CONF_SQL.replace('cf AS (', 'cf0 AS (', 1)},
cf AS (SELECT * FROM cf0 WHERE n >= 10 AND p_type IN ('SMALL', 'LARGE', 'MEDIUM')),
ids AS (SELECT p_type, p_brand, CAST(row_number() OVER (ORDER BY p_type, p_brand) - 1 AS BIGINT) AS configuration_id FROM cf),
x AS (SELECT cf.*, 100 AS room, {PA.ORDER_SIZE} AS lft FROM cf),
s AS (SELECT *, coalesce(sum(room) OVER (PARTITION BY p_type ORDER BY score DESC, p_brand ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM x WHERE score > 0),
va AS (SELECT p_type, p_brand, score, CAST(greatest(0, least(room, lft - before)) AS BIGINT) AS quantity FROM s UNION ALL SELECT p_type, p_brand, score, 0 FROM x WHERE NOT score > 0),
ch AS (SELECT p_type, sum(CAST(quantity > 0 AS INT)) AS sel FROM va GROUP BY p_type),
z AS (SELECT va.*, row_number() OVER (PARTITION BY va.p_type ORDER BY score DESC, p_brand) AS r, ch.sel FROM va JOIN ch USING (p_type) WHERE quantity = 0),
sl AS (SELECT p_type, p_brand, score FROM va WHERE quantity > 0 UNION ALL SELECT p_type, p_brand, score FROM z WHERE r <= {MIN_CONFIGS} - sel),
q AS (SELECT *, CAST(round_even(CAST(try_divide(score, sum(score) OVER (PARTITION BY p_type)) * {PA.ORDER_SIZE} AS DECIMAL(38,10)), 0) AS DOUBLE) AS q0 FROM sl),
r AS (SELECT *, sum(q0) OVER (PARTITION BY p_type) AS tot, row_number() OVER (PARTITION BY p_type ORDER BY score DESC, p_brand) AS rn FROM q),
r2 AS (SELECT *, max(CASE WHEN q0 > 0 THEN rn END) OVER (PARTITION BY p_type) AS lastpos FROM r),
f AS (SELECT *, CAST(q0 + CASE WHEN {PA.ORDER_SIZE} - tot > 0 AND rn = 1 THEN {PA.ORDER_SIZE} - tot ELSE 0 END
  + CASE WHEN {PA.ORDER_SIZE} - tot < 0 AND rn = lastpos THEN {PA.ORDER_SIZE} - tot ELSE 0 END AS BIGINT) AS quantity FROM r2)
SELECT f.p_type, f.p_brand, ids.configuration_id, f.quantity FROM f JOIN ids USING (p_type, p_brand) WHERE f.quantity > 0""".replace("try_divide(score, sum(score) OVER (PARTITION BY p_type))", "score / NULLIF(sum(score) OVER (PARTITION BY p_type), 0)"))

# ------------------------------------------------------------------ AGG-04
PRED_MEASURES = (("average_percentage_margin", "margin_pct"), ("average_stock_days", "stock_days"),
                 ("average_score", "new_score"), ("average_score_pred", "score_class_pred"),
                 ("average_score_euros", "score_euros"))


@query("agg_04_predictions_multi_grain")
def agg04(spark, d):
    s = PR.scored(spark, d).withColumn("probability", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("margin_pct") / 10)))
    s = s.withColumn("score_class_pred", (F.col("probability") >= 0.5).cast("bigint"))
    out = aggs.multi_grain_averages(s, PR.CONFIG, [("", []), ("_local", ["place"])], PRED_MEASURES, decimals=6)
    cols = [f"{n}{t}" for t in ("", "_local") for n, _ in PRED_MEASURES]
    return out.select(*LINE_KEY, rnd("probability", 6).alias("probability"), "score_class_pred",
                      *[big(f"nr_cars_sold{t}").alias(f"nr_cars_sold{t}") for t in ("", "_local")], *cols)


def _agg04_sql():
    g = []
    for i, (tag, extra) in enumerate([("", []), ("_local", ["place"])]):
        ks = ", ".join(PR.CONFIG + extra)
        meas = ", ".join(f"{sql_rnd(f'avg({c})', 6)} AS {n}{tag}" for n, c in PRED_MEASURES)
        g.append(f"g{i} AS (SELECT {ks}, CAST(count(*) AS BIGINT) AS nr_cars_sold{tag}, {meas} FROM p GROUP BY {ks})")
    return ("WITH " + PR.SCORED_SQL.lstrip() + f""",
p AS (SELECT *, least(1.0, greatest(0.0, margin_pct / 10)) AS probability, CAST(least(1.0, greatest(0.0, margin_pct / 10)) >= 0.5 AS BIGINT) AS score_class_pred FROM scored),
{', '.join(g)}
SELECT {LK}, {sql_rnd('probability', 6)} AS probability, score_class_pred, nr_cars_sold, nr_cars_sold_local, """
            + ", ".join(f"{n}{t}" for t in ("", "_local") for n, _ in PRED_MEASURES)
            + f" FROM p JOIN g0 USING ({', '.join(PR.CONFIG)}) JOIN g1 USING ({', '.join(PR.CONFIG + ['place'])})")


sql("agg_04_predictions_multi_grain", _agg04_sql())

# ------------------------------------------------------------------ AGG-26
SCENARIO = 1040


@query("agg_26_similar_cases")
def agg26(spark, d):
    c = contracts(spark, d).withColumn("prob", ((F.col("contract_customer") * 37) % 100) / 100.0)
    c = materialize(c.select("contract_customer", "customer_group", "make", "prob", "target"), "checkpoint")  # read by every figure below
    me = c.filter(F.col("contract_customer") == SCENARIO)
    p0 = me.agg(F.max("prob")).scalar()
    grp, make = me.agg(F.max("customer_group")).scalar(), me.agg(F.max("make")).scalar()
    allc = c.filter(F.col("prob") < 0.95)
    sim = c.filter((F.col("customer_group") == grp) & (F.col("make") == make) & (F.col("target") > 0))
    cut = quantile_values(sim, "target", [0.9])[0]
    kept = sim.filter(F.col("target") <= cut)
    median = quantile_values(kept, "target", [0.5])[0]
    return allc.agg(
        rnd(F.sum((F.col("prob") < p0).cast("int")) / F.count(F.lit(1)) * 100, 4).alias("pct_all"),
        rnd(F.lit(sim.agg(F.sum((F.col("prob") < p0).cast("int")) / F.count(F.lit(1)) * 100).scalar()), 4).alias("pct_similar"),
        rnd(F.lit(kept.agg(F.avg("target")).scalar()), 2).alias("cost_mean"),
        rnd(F.max(median), 2).alias("cost_median"),
        rnd(F.lit(kept.agg(F.min("target")).scalar()), 2).alias("cost_min"),
        rnd(F.lit(kept.agg(F.max("target")).scalar()), 2).alias("cost_max"))


sql("agg_26_similar_cases", f"""WITH {CONTRACTS_SQL.strip()},
c AS (SELECT *, ((contract_customer * 37) % 100) / 100.0 AS prob FROM contracts),
me AS (SELECT * FROM c WHERE contract_customer = {SCENARIO}),
sim AS (SELECT c.* FROM c, me WHERE c.customer_group = me.customer_group AND c.make = me.make AND c.target > 0),
kept AS (SELECT * FROM sim WHERE target <= (SELECT quantile_cont(target, 0.9) FROM sim))
SELECT {sql_rnd('(SELECT sum(CAST(prob < (SELECT prob FROM me) AS INT)) / count(*) * 100 FROM c WHERE prob < 0.95)')} AS pct_all,
  {sql_rnd('(SELECT sum(CAST(prob < (SELECT prob FROM me) AS INT)) / count(*) * 100 FROM sim)')} AS pct_similar,
  {sql_rnd('(SELECT avg(target) FROM kept)', 2)} AS cost_mean, {sql_rnd('(SELECT quantile_cont(target, 0.5) FROM kept)', 2)} AS cost_median,
  {sql_rnd('(SELECT min(target) FROM kept)', 2)} AS cost_min, {sql_rnd('(SELECT max(target) FROM kept)', 2)} AS cost_max""")

# ------------------------------------------------------------------ WIN-12


@query("win_12_photo_stock")
def win12(spark, d):
    """Photo stock over the whole period, as intervals of days with one stock;
    the previous run's days (all but the last month) win over the current."""
    start, end = PP.period(spark, d)
    li = read(spark, d, "lineitem", *LINE_KEY, "l_shipdate")
    photo = li.select(F.col("l_partkey").alias("part"), F.to_date("l_shipdate").alias("day"), F.col("l_quantity").alias("qty_stock"), *LINE_KEY[2:])
    photo = clean.dedupe_first(photo, ["day", "part"], LINE_KEY[2:]).select("part", "day", "qty_stock")
    held = ledger.with_opening_row(photo, ["part"], start, ["qty_stock"], until="until", end=end).na.fill(0.0, subset=["qty_stock"])
    cut = F.add_months(end, -1)
    old = F.struct(F.col("day").alias("index"), F.least("until", F.date_sub(cut, 1)).alias("until"), (F.col("qty_stock") + 1000).alias("Stock_Qty"), F.lit("previous").alias("run"))
    new = F.struct(F.greatest("day", cut).alias("index"), F.col("until").alias("until"), F.col("qty_stock").alias("Stock_Qty"), F.lit("current").alias("run"))
    both = F.array_compact(F.array(F.when(F.col("day") < cut, old), F.when(F.col("until") >= cut, new)))
    out = held.select("part", F.explode(both).alias("x")).select("part", "x.*")
    return out.select("part", dstr("index").alias("index"), dstr("until").alias("until"), rnd("Stock_Qty", 2).alias("Stock_Qty"), "run")


sql("win_12_photo_stock", f"""WITH ph0 AS (SELECT l_partkey AS part, CAST(l_shipdate AS DATE) AS day, l_quantity AS qty_stock,
  row_number() OVER (PARTITION BY CAST(l_shipdate AS DATE), l_partkey ORDER BY l_suppkey, l_quantity, l_extendedprice) AS rn
  FROM lineitem),
ph AS (SELECT part, day, qty_stock FROM ph0 WHERE rn = 1),
period AS (SELECT min(day) AS d0, max(day) AS d1, CAST(max(day) - INTERVAL 1 MONTH AS DATE) AS cut FROM ph),
grid AS (SELECT part, CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT DISTINCT part FROM ph), period),
dn AS (SELECT g.part, g.day, p.qty_stock IS NOT NULL OR g.day = (SELECT d0 FROM period) AS photo,
  coalesce(p.qty_stock, last_value(p.qty_stock IGNORE NULLS) OVER (PARTITION BY g.part ORDER BY g.day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0) AS qty_stock
  FROM grid g LEFT JOIN ph p USING (part, day)),
old AS (SELECT part, day, photo, qty_stock + 1000 AS qty_stock, 'previous' AS run FROM dn WHERE day < (SELECT cut FROM period)),
u AS (SELECT * FROM old UNION ALL SELECT part, day, photo, qty_stock, 'current' FROM dn WHERE (part, day) NOT IN (SELECT (part, day) FROM old)),
v AS (SELECT *, sum(CAST(photo OR day = (SELECT cut FROM period) AS INT)) OVER (PARTITION BY part ORDER BY day) AS nr FROM u)
SELECT part, strftime(min(day), '%Y-%m-%d') AS "index", strftime(max(day), '%Y-%m-%d') AS until, {sql_rnd('min(qty_stock)', 2)} AS Stock_Qty, run
FROM v GROUP BY part, nr, run""")

# ------------------------------------------------------------------ WIN-20


@query("win_20_deviation_scores")
def win20(spark, d):
    o = windows.keep_group_max(odometer(spark, d), ["vehicle", "owner", "day"], "kms")
    s = windows.deviation_scores(o, ["vehicle", "owner"], "kms")
    return s.select("vehicle", "owner", "event_id", rnd("lmdd", 6).alias("lmdd"), "lmdd_outlier")


sql("win_20_deviation_scores", f"""WITH {ODOMETER_SQL.strip()},
s1 AS (SELECT * FROM (SELECT *, max(kms) OVER (PARTITION BY vehicle, owner, day) AS mx FROM odometer) WHERE kms = mx),
g AS (SELECT s1.*, count(*) OVER w AS n, sum(kms) OVER w AS s1s, sum(kms * kms) OVER w AS s2 FROM s1 WINDOW w AS (PARTITION BY vehicle, owner)),
sc AS (SELECT *, CASE WHEN n > 1 THEN (n - 1) * ((s2 / n - (s1s / n) * (s1s / n)) - ((s2 - kms * kms) / (n - 1) - ((s1s - kms) / (n - 1)) * ((s1s - kms) / (n - 1)))) END AS lmdd FROM g),
th AS (SELECT vehicle, owner, quantile_cont(lmdd, 0.9) AS t FROM sc GROUP BY ALL)
SELECT vehicle, owner, event_id, {sql_rnd('lmdd', 6)} AS lmdd, CAST({sql_rnd('lmdd', 6)} > {sql_rnd('t', 6)} AS BIGINT) AS lmdd_outlier FROM sc JOIN th USING (vehicle, owner)""")

# ------------------------------------------------------------------ RUL-08 / 09
EXCLUDED_CATEGORIES = ["src3", "src7"]


def prepared_requests(spark, d):
    r = requests(spark, d)
    r = joins.anti(r, spark.createDataFrame([(c,) for c in EXCLUDED_CATEGORIES], "category string"), "category")
    summ = read(spark, d, "conversations", "conv_id", "turn", "text").filter("turn = 0").select(F.col("conv_id").alias("request_num"), F.col("text").alias("summary"))
    r = r.join(summ, "request_num", "left")
    r = clean.lowercase(r, ["description", "summary"])
    r = clean.null_if_match(r, "description", "http")
    r = clean.fill_from(r, "description", "summary")
    r = clean.literal_removal(r, "description")
    r = clean.keep_non_null(r, ["description"])
    return r.withColumn("tokens", F.filter(T.request_text_tokens(F.col("description")), lambda x: F.length(x) >= 2))


@query("rul_08_request_preparation")
def rul08(spark, d):
    r = prepared_requests(spark, d)
    return r.select("request_num", "category", F.array_join(T.remove_words(F.col("tokens"), ["the", "of"]), " ").alias("clean_description"))


def _sql_tokens(c):
    from forecourt.plans.text import sql_request_tokens
    return sql_request_tokens(c)


sql("rul_08_request_preparation", f"""WITH {REQUESTS_SQL.strip()},
r AS (SELECT q.request_num, q.category, lower(q.description) AS description, lower(c.text) AS summary FROM requests q
  LEFT JOIN (SELECT conv_id, text FROM conversations WHERE turn = 0) c ON q.request_num = c.conv_id WHERE q.category NOT IN ('src3', 'src7')),
r2 AS (SELECT request_num, category, regexp_replace(coalesce(CASE WHEN regexp_matches(description, 'http') THEN NULL ELSE description END, summary), '\\n|\\r|\\t|\\\\u', ' ', 'g') AS description FROM r)
SELECT request_num, category, array_to_string(list_filter(list_filter({_sql_tokens('description')}, lambda x: length(x) >= 2), lambda w: w NOT IN ('the', 'of')), ' ') AS clean_description
FROM r2 WHERE description IS NOT NULL""")

# Fixed stored rules of this fixture: (rule_id, kind, word, family, cost min / max, price min / max)
STORED_RULES = [(1, "starts", "red", "F-RED", 0.0, 2000.0, 0.0, 3000.0), (2, "contains", "bolt", "F-BOLT", 0.0, 1500.0, 0.0, 2500.0),
                (3, "starts", "red", "F-RED2", 1000.0, 1200.0, 1400.0, 2000.0), (4, "contains", "ring", "F-RING", 900.0, 1100.0, 0.0, 9999.0)]


@query("rul_09_stored_rules")
def rul09(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_name", "p_retailprice").withColumn("cost", F.col("p_retailprice") * 0.7)
    r = spark.createDataFrame(STORED_RULES, "rule_id bigint, kind string, match string, value string, cmin double, cmax double, pmin double, pmax double")
    out = rules.apply_ordered_rules(p, "p_name", r, "family", extra_cond=lambda x: (
        F.col("cost").between(x.cmin, x.cmax) & F.col("p_retailprice").between(x.pmin, x.pmax)))
    return out.select("p_partkey", "family")


sql("rul_09_stored_rules", f"""WITH r AS (SELECT * FROM (VALUES {', '.join(str(x) for x in STORED_RULES)}) t(rule_id, kind, m, v, cmin, cmax, pmin, pmax)),
p AS (SELECT p_partkey, p_name, p_retailprice, p_retailprice * 0.7 AS cost FROM part),
h AS (SELECT p_partkey, arg_max(v, rule_id) AS family FROM p JOIN r ON ((kind = 'starts' AND starts_with(p_name, m)) OR (kind = 'contains' AND contains(p_name, m)))
  AND cost BETWEEN cmin AND cmax AND p_retailprice BETWEEN pmin AND pmax GROUP BY p_partkey)
SELECT p.p_partkey, h.family FROM p LEFT JOIN h USING (p_partkey)""")

# ------------------------------------------------------------------ APP-*


@query("app_01_importer_screen")
def app01(spark, d):
    s = io.scan_filter(read(spark, d, "orders"), {"o_orderstatus": ["F", "O"]}, ["o_orderkey", "o_orderpriority", "o_totalprice"])
    return clean.lowercase(s, ["o_orderpriority"]).select("o_orderkey", "o_orderpriority", rnd("o_totalprice", 2).alias("o_totalprice"))


sql("app_01_importer_screen", f"SELECT o_orderkey, lower(o_orderpriority) AS o_orderpriority, {sql_rnd('o_totalprice', 2)} AS o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O')")


@query("app_02_parts_screen")
def app02(spark, d):
    m = PP.metrics(spark, d)
    ta = ledger.part_type(PP._ta_input(spark, d), "part", "product_group", "part_desc", PP.OIL_WORDS)
    x = m.join(ta, "part", "left").filter((F.col("days_to_sell_1_part") > 0) & ~F.col("ta").isin("NO_TA", "Outros"))
    return x.select("part", "ta", rnd("days_to_sell_1_part", 6).alias("days_to_sell_1_part"), rnd("cost").alias("cost"))


@query("app_04_request_screen")
def app04(spark, d):
    r = requests(spark, d)
    manual = read(spark, d, "labels", "doc_id").filter(F.col("doc_id") % 3 == 0).select(F.col("doc_id").alias("request_num"))
    x = joins.anti(r, manual, "request_num")
    return clean.sequence_number(x.select("request_num", "category"), ["request_num"], out="position")


sql("app_04_request_screen", f"""WITH {REQUESTS_SQL.strip()} SELECT request_num, category, CAST(row_number() OVER (ORDER BY request_num) - 1 AS BIGINT) AS position
FROM requests WHERE request_num NOT IN (SELECT doc_id FROM labels WHERE doc_id % 3 = 0)""")


@query("app_05_coverage_comparison")
def app05(spark, d):
    c = contracts(spark, d).select("contract_customer", (((F.col("contract_customer") * 37) % 100 + 1) / 101.0).alias("p_qiv"),
                                   (((F.col("contract_customer") * 53) % 100 + 1) / 101.0).alias("p_dp"))
    return c.select("contract_customer", rnd(1 - F.col("p_qiv") / F.col("p_dp"), 6).alias("qiv_vs_dp"), rnd(1 - F.col("p_dp") / F.col("p_qiv"), 6).alias("dp_vs_qiv"))


sql("app_05_coverage_comparison", f"""WITH {CONTRACTS_SQL.strip()}, c AS (SELECT contract_customer, ((contract_customer * 37) % 100 + 1) / 101.0 AS p_qiv, ((contract_customer * 53) % 100 + 1) / 101.0 AS p_dp FROM contracts)
SELECT contract_customer, {sql_rnd('1 - p_qiv / p_dp', 6)} AS qiv_vs_dp, {sql_rnd('1 - p_dp / p_qiv', 6)} AS dp_vs_qiv FROM c""")

# ------------------------------------------------------------------ JOB-*


@query("job_03_importer_sales")
def job03(spark, d):
    from forecourt.plans.jobs_importer import collapsed
    c = collapsed(spark, d)
    c = M.importer_measures(c, PM.MEASURE_MAP)
    p = read(spark, d, "part", "p_partkey", "p_brand", "p_type")
    c = c.join(p, F.col("l_partkey") == F.col("p_partkey")).withColumn("reg_ts", F.col("invoice_date"))
    c = c.filter(F.col("reg_ts").isNotNull())
    c = windows.month_window_counts(c, ["p_brand", "p_type"], "reg_ts", ["reg_ts", "l_orderkey", "l_linenumber"], months=6)
    c = aggs.group_number(c, ["p_brand", "p_type"], out="configuration_group")
    out = io.stored(c.select("l_orderkey", "l_linenumber", "configuration_group", "sales_month-1", "sales_month-1_cum",
                             rnd("Fixed_Margin_I", 4).alias("Fixed_Margin_I")), "job03")
    if io.volume_gate(out, "l_orderkey").first()["status"] == "error":
        raise ValueError("fewer vehicles than a run needs")
    return out


@query("job_04_parts_metrics_and_allocation")
def job04(spark, d):
    """Stops when the last movement day is processed already; metrics and groups are
    stored, the allocation reads them."""
    moved = read(spark, d, "lineitem", "l_shipdate")
    if io.watermark(moved, "l_shipdate", "2100-01-01").first()["already_processed"]:
        raise ValueError("the last day is processed already")
    m = PP.metrics(spark, d)
    ta = ledger.part_type(PP._ta_input(spark, d), "part", "product_group", "part_desc", PP.OIL_WORDS)
    x = io.stored(m.join(ta, "part", "left").withColumn("pse_code", F.lit("P0")), "job04_metrics")
    a = alloc.parts_allocation(x.filter(F.col("days_to_sell_1_part").isNotNull()), ["pse_code", "ta"], ["part"], "cost",
                               "days_to_sell_1_part", 30.0, max_parts=F.lit(200))
    return a.select("part", "ta", "quantity")


@query("job_10_odometer_repair")
def job10(spark, d):
    o = odometer(spark, d)
    o = windows.keep_group_max(o, ["vehicle", "owner", "day"], "kms")
    o = windows.mileage_repair_between(o, ["vehicle", "owner"], ["day", "event_id"])
    o = windows.mileage_repair_last_pair(o, ["vehicle", "owner"], ["day", "event_id"])
    o = windows.diff_prev(o, ["vehicle", "owner"], ["day", "event_id"], "kms", "kms_diff")
    return o.select("vehicle", "owner", "event_id", dstr("day").alias("day"), "kms", big("kms_diff").alias("kms_diff"))


@query("job_03a_importer_inputs")
def job03a(spark, d):
    """Current and historic movements in one, one row a product code of an order,
    with dealer and customer group."""
    from forecourt.plans.joins import jon20, set01
    li = clean.dedupe_first(set01(spark, d), ["l_orderkey", "l_partkey"], ["l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "src"])
    dealers = jon20(spark, d)
    return li.join(dealers, li["l_orderkey"] == dealers["o_orderkey"], "left").select(
        "l_orderkey", "l_partkey", "l_linenumber", "src", "c_mktsegment", "place", "place_v2")


sql("job_03a_importer_inputs", """WITH u AS (SELECT *, CASE WHEN l_shipdate >= TIMESTAMP '1999-01-01' THEN 'current' ELSE 'history' END AS src FROM lineitem),
k AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber, l_suppkey, l_quantity, l_extendedprice, src) AS rn FROM u)
SELECT k.l_orderkey, k.l_partkey, k.l_linenumber, k.src, c.c_mktsegment, n.n_name AS place, r.r_name AS place_v2 FROM k
LEFT JOIN orders o ON k.l_orderkey = o.o_orderkey LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey WHERE k.rn = 1""")
