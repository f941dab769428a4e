"""AGG-* registered queries (the simpler aggregations; the jobs-level ones
live next to their jobs)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from forecourt.functions.fmt import big, dstr, rnd, sql_rnd
from forecourt.operators.quantiles import quantile_values
from forecourt.operators import aggs
from forecourt.plans.registry import query
from forecourt.sources.fixtures import (EVENTS_GAPS_SQL, IMPORTER_SQL, LANG_PRED_SQL, events_gaps,
                                        importer_sales, lang_predictions)
from forecourt.sources.tables import LINE_KEY, read

LK = ", ".join(LINE_KEY)
ORACLE: dict[str, str] = {}
TOK = "list_filter(regexp_split_to_array(lower({c}), '[^a-z0-9]+'), lambda t: t <> '')"


def sql(name, text):
    ORACLE[name] = text.strip()


@query("agg_01_total_price")
def agg01(spark, d):
    li = read(spark, d, "lineitem", *LINE_KEY)
    return aggs.total_price(li, "l_orderkey", "l_extendedprice").select(*LINE_KEY, rnd("price_total", 2).alias("price_total"))


sql("agg_01_total_price", f"SELECT {LK}, {sql_rnd('sum(l_extendedprice) OVER (PARTITION BY l_orderkey)', 2)} AS price_total FROM lineitem")


def _agg05_input(spark, d):
    li = read(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    o = read(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = read(spark, d, "customer", "c_custkey", F.length("c_name").alias("name_len"), "c_mktsegment")
    o = o.join(c, F.col("o_custkey") == F.col("c_custkey"))  # lines are joined once
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))


@query("agg_05_part_group_rules")
def agg05(spark, d):
    x = _agg05_input(spark, d)
    g = x.groupBy("l_partkey").agg(
        F.concat_ws(" ", F.array_sort(F.collect_set("c_mktsegment"))).alias("descriptions"),
        aggs.mode_value("o_orderpriority").alias("family"),
        F.min_by("o_custkey", F.struct("o_orderdate", "o_orderkey", "l_extendedprice")).alias("first_client"),
        F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("avg_unit_cost"),
        F.avg("name_len").alias("avg_name_len"))
    return g.select("l_partkey", "descriptions", "family", "first_client",
                    rnd("avg_unit_cost").alias("avg_unit_cost"), rnd("avg_name_len").alias("avg_name_len"))


sql("agg_05_part_group_rules", f"""WITH x AS (SELECT l.l_partkey, l.l_quantity, l.l_extendedprice, o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_orderpriority, c.c_name, c.c_mktsegment
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey),
fam AS (SELECT l_partkey, o_orderpriority AS family FROM (SELECT l_partkey, o_orderpriority, row_number() OVER (PARTITION BY l_partkey ORDER BY count(*) DESC, o_orderpriority) AS rn
  FROM x GROUP BY l_partkey, o_orderpriority) WHERE rn = 1),
g AS (SELECT l_partkey, array_to_string(list_sort(list_distinct(list(c_mktsegment))), ' ') AS descriptions,
  arg_min(o_custkey, (o_orderdate, o_orderkey, l_extendedprice)) AS first_client,
  avg(l_extendedprice / l_quantity) AS u, avg(length(c_name)) AS nl FROM x GROUP BY l_partkey)
SELECT g.l_partkey, descriptions, family, first_client, {sql_rnd('u')} AS avg_unit_cost, {sql_rnd('nl')} AS avg_name_len FROM g JOIN fam USING (l_partkey)""")


@query("agg_06_value_counts")
def agg06(spark, d):
    return read(spark, d, "part", "p_name").groupBy("p_name").agg(F.count(F.lit(1)).alias("count"))


sql("agg_06_value_counts", "SELECT p_name, count(*) AS count FROM part GROUP BY p_name")


def _profile_input(spark, d):
    e = events_gaps(spark, d)
    return e.select("event_id", "event_type", "value", "value2",
                    F.when(F.col("event_id") % 11 == 0, F.lit(float("inf")))
                     .when(F.col("event_id") % 13 == 0, F.lit(float("-inf"))).otherwise(F.col("value")).alias("ratio"),
                    (F.col("event_id") % 4).alias("bucket"))


_PROFILE_SQL = EVENTS_GAPS_SQL.strip() + """,
prof AS (SELECT event_id, event_type, value, value2,
  CASE WHEN event_id % 11 = 0 THEN 'inf'::DOUBLE WHEN event_id % 13 = 0 THEN '-inf'::DOUBLE ELSE value END AS ratio,
  event_id % 4 AS bucket FROM events_gaps)"""
_PROF_COLS = [("event_id", "bigint"), ("event_type", "string"), ("value", "double"), ("value2", "double"),
              ("ratio", "double"), ("bucket", "bigint")]


def _profile_sql(pred):
    parts = []
    for c, t in _PROF_COLS:
        cond = pred(c, t)
        parts.append(f"SELECT '{c}' AS column_name, '{t}' AS column_type, CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT) AS n, "
                     f"{sql_rnd(f'sum(CASE WHEN {cond} THEN 1 ELSE 0 END) / count(*) * 100')} AS pct FROM prof")
    return f"WITH {_PROFILE_SQL} " + " UNION ALL ".join(parts)


for _kind, _pred in (("null", lambda c, t: f"{c} IS NULL"),
                     ("pos_inf", lambda c, t: f"{c} = 'inf'::DOUBLE" if t == "double" else "false"),
                     ("neg_inf", lambda c, t: f"{c} = '-inf'::DOUBLE" if t == "double" else "false"),
                     ("zero", lambda c, t: f"{c} = 0" if t != "string" else "false")):
    _id = {"null": "agg_10_null_profile", "pos_inf": "agg_11_inf_profile", "neg_inf": "agg_11_neg_inf_profile",
           "zero": "agg_12_zero_profile"}[_kind]

    def _mk(kind):
        def f(spark, d):
            p = aggs.column_profile(_profile_input(spark, d), kind)
            return p.select("column_name", "column_type", "n", rnd("pct").alias("pct"))
        return f
    query(_id)(_mk(_kind))
    sql(_id, _profile_sql(_pred))


@query("agg_13_histogram")
def agg13(spark, d):
    v = read(spark, d, "events", "value")
    h = aggs.relative_histogram(v, "value", 10)
    return h.select("bin", rnd("bin_center").alias("bin_center"), rnd("rel_freq").alias("rel_freq"))


sql("agg_13_histogram", f"""WITH s AS (SELECT min(value) AS lo, max(value) AS hi, count(value) AS n FROM events),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((value - lo) / (hi - lo) * 10), 9) END AS BIGINT) AS bin, lo, hi, n FROM events, s WHERE value IS NOT NULL)
SELECT bin, {sql_rnd('any_value(lo) + (bin + 0.5) * ((any_value(hi) - any_value(lo)) / 10)')} AS bin_center, {sql_rnd('count(*) * 100.0 / any_value(n)')} AS rel_freq FROM b GROUP BY bin""")


@query("agg_13_empirical_cdf")
def agg13c(spark, d):
    v = read(spark, d, "events", "event_id", "value")
    c = aggs.empirical_cdf(v, "value", ["event_id"])
    return c.select(rnd("value").alias("value"), "position", rnd("cdf", 6).alias("cdf"))


sql("agg_13_empirical_cdf", f"""SELECT {sql_rnd('value')} AS value, CAST(row_number() OVER (ORDER BY value, event_id) - 1 AS BIGINT) AS position,
  {sql_rnd('(row_number() OVER (ORDER BY value, event_id) - 1) / (count(*) OVER () - 1)', 6)} AS cdf FROM events""")


@query("agg_14_duplicated_keys")
def agg14(spark, d):
    li = read(spark, d, "lineitem", *LINE_KEY)
    return aggs.duplicated_key_rows(li, ["l_orderkey", "l_linenumber"])


sql("agg_14_duplicated_keys", f"SELECT {LK} FROM lineitem WHERE (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY ALL HAVING count(*) > 1)")


@query("agg_16_group_number")
def agg16(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_brand", "p_type")
    p = p.withColumn("p_brand", F.when(F.col("p_partkey") % 17 == 0, F.lit(None)).otherwise(F.col("p_brand")))
    return aggs.group_number(p, ["p_brand", "p_type"]).select("p_partkey", "group_id")


sql("agg_16_group_number", """WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_brand END AS p_brand, p_type FROM part),
k AS (SELECT p_brand, p_type, CAST(row_number() OVER (ORDER BY p_brand, p_type) - 1 AS BIGINT) AS gid FROM (SELECT DISTINCT p_brand, p_type FROM p WHERE p_brand IS NOT NULL AND p_type IS NOT NULL))
SELECT p.p_partkey, CAST(coalesce(k.gid, -1) AS BIGINT) AS group_id FROM p LEFT JOIN k ON p.p_brand = k.p_brand AND p.p_type = k.p_type""")


@query("agg_17_configuration_ids")
def agg17(spark, d):
    s = importer_sales(spark, d).withColumn("score", F.col("l_quantity") - 25)
    pos = s.filter(F.col("score") > 0).select("p_brand", "p_type").distinct()
    return aggs.group_number(pos, ["p_brand", "p_type"], out="configuration_id")


sql("agg_17_configuration_ids", f"""WITH {IMPORTER_SQL.strip()}
SELECT p_brand, p_type, CAST(row_number() OVER (ORDER BY p_brand, p_type) - 1 AS BIGINT) AS configuration_id
FROM (SELECT DISTINCT p_brand, p_type FROM importer_sales WHERE l_quantity - 25 > 0)""")


@query("agg_18_word_frequency")
def agg18(spark, d):
    doc = read(spark, d, "documents", "doc_id", "text")
    return aggs.word_unit_frequency(doc, "doc_id", "text", threshold=5)


sql("agg_18_word_frequency", f"""SELECT word, count(DISTINCT doc_id) AS n_units FROM (SELECT doc_id, unnest({TOK.format(c='text')}) AS word FROM documents)
GROUP BY word HAVING count(DISTINCT doc_id) > 5""")


def _ngram_sql(group, src, where=""):
    return f"""WITH t AS (SELECT {group} AS g, doc_id, {TOK.format(c='text')} AS tk FROM {src} {where}),
t2 AS (SELECT * FROM t WHERE len(tk) > 0),
uni AS (SELECT g, 1 AS n, unnest(tk) AS ngram FROM t2),
inner_bi AS (SELECT g, 2 AS n, tk[i] || ' ' || tk[i + 1] AS ngram FROM (SELECT g, tk, unnest(generate_series(1, len(tk) - 1)) AS i FROM t2 WHERE len(tk) > 1)),
border AS (SELECT g, 2 AS n, tk[len(tk)] || ' ' || nx AS ngram FROM (SELECT g, tk, lead(tk[1]) OVER (PARTITION BY g ORDER BY doc_id) AS nx FROM t2) WHERE nx IS NOT NULL),
c AS (SELECT g, n, ngram, count(*) AS cnt FROM (SELECT * FROM uni UNION ALL SELECT * FROM inner_bi UNION ALL SELECT * FROM border) GROUP BY g, n, ngram),
r AS (SELECT *, row_number() OVER (PARTITION BY g, n ORDER BY cnt DESC, ngram) AS rank FROM c)
SELECT g AS {group}, n, ngram, cnt, rank FROM r WHERE rank <= 3"""


@query("agg_19_top_ngrams")
def agg19(spark, d):
    doc = read(spark, d, "documents", "doc_id", "source", "text")
    return aggs.top_ngrams(doc, "source", "doc_id", "text", 3).select("source", F.col("n").cast("int").alias("n"), "ngram", "cnt", F.col("rank").cast("bigint").alias("rank"))


sql("agg_19_top_ngrams", _ngram_sql("source", "documents"))


@query("agg_20_family_keywords")
def agg20(spark, d):
    doc = read(spark, d, "documents", "doc_id", "lang", "text").filter(F.col("lang") != "en")
    return aggs.top_ngrams(doc, "lang", "doc_id", "text", 3).select("lang", F.col("n").cast("int").alias("n"), "ngram", "cnt", F.col("rank").cast("bigint").alias("rank"))


sql("agg_20_family_keywords", _ngram_sql("lang", "documents", "WHERE lang <> 'en'"))

# Fixed stop-word list of this fixture (small, invented-text words).
STOP = ["the", "of", "and", "le", "la", "de", "der", "und", "el", "en"]


@query("agg_21_common_keywords")
def agg21(spark, d):
    doc = read(spark, d, "documents", "source", "text")
    w = doc.select("source", F.explode(aggs.tokens(F.col("text"))).alias("word"))
    w = w.filter((F.length("word") > 1) & ~F.col("word").isin(STOP))
    a = w.filter(F.col("source") == "src0").groupBy("word").agg(F.count(F.lit(1)).alias("ca"))
    b = w.filter(F.col("source") == "src1").groupBy("word").agg(F.count(F.lit(1)).alias("cb"))
    return a.join(b, "word").select("word", (F.col("ca") + F.col("cb")).alias("total"))


sql("agg_21_common_keywords", f"""WITH w AS (SELECT source, unnest({TOK.format(c='text')}) AS word FROM documents),
f AS (SELECT * FROM w WHERE length(word) > 1 AND word NOT IN ({', '.join(repr(s) for s in STOP)}))
SELECT a.word, a.ca + b.cb AS total FROM (SELECT word, count(*) AS ca FROM f WHERE source = 'src0' GROUP BY word) a
JOIN (SELECT word, count(*) AS cb FROM f WHERE source = 'src1' GROUP BY word) b USING (word)""")


@query("agg_22_price_limits")
def agg22(spark, d):
    p = read(spark, d, "part", "p_type", "p_retailprice").filter(F.col("p_type").isin("SMALL", "LARGE"))
    p = p.withColumn("cost", F.col("p_retailprice") * 0.6)
    limits = [quantile_values(p, c, [0.95])[0] for c in ("cost", "p_retailprice")]
    return p.agg(rnd(F.min("cost")).alias("cost_min"), rnd(F.max(limits[0])).alias("cost_p95"),
                 rnd(F.min("p_retailprice")).alias("pvp_min"), rnd(F.max(limits[1])).alias("pvp_p95"))


sql("agg_22_price_limits", f"""SELECT {sql_rnd('min(p_retailprice * 0.6)')} AS cost_min, {sql_rnd('quantile_cont(p_retailprice * 0.6, 0.95)')} AS cost_p95,
  {sql_rnd('min(p_retailprice)')} AS pvp_min, {sql_rnd('quantile_cont(p_retailprice, 0.95)')} AS pvp_p95 FROM part WHERE p_type IN ('SMALL', 'LARGE')""")


@query("agg_23_confusion_replacements")
def agg23(spark, d):
    lp = lang_predictions(spark, d)
    cells = lp.groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("cnt"))
    tot = cells.groupBy("actual").agg(F.sum("cnt").alias("row_total"),
                                      F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("cnt")).otherwise(0)).alias("diag"))
    acc = tot.select("actual", (F.col("diag") / F.col("row_total")).alias("accuracy"))
    off = cells.filter(F.col("actual") != F.col("predicted"))
    w = Window.partitionBy("actual").orderBy(F.desc("cnt"), "predicted")
    top = off.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= 2)
    return (acc.filter(F.col("accuracy") < 0.9).join(top, "actual")
               .select("actual", rnd("accuracy").alias("accuracy"), big("rank").alias("rank"), "predicted", "cnt"))


sql("agg_23_confusion_replacements", f"""WITH {LANG_PRED_SQL.strip()},
cells AS (SELECT actual, predicted, count(*) AS cnt FROM lang_pred GROUP BY ALL),
acc AS (SELECT actual, sum(CASE WHEN actual = predicted THEN cnt ELSE 0 END) / sum(cnt) AS accuracy FROM cells GROUP BY actual),
top AS (SELECT *, row_number() OVER (PARTITION BY actual ORDER BY cnt DESC, predicted) AS rank FROM cells WHERE actual <> predicted)
SELECT a.actual, {sql_rnd('a.accuracy')} AS accuracy, CAST(t.rank AS BIGINT) AS rank, t.predicted, t.cnt FROM acc a JOIN top t USING (actual)
WHERE a.accuracy < 0.9 AND t.rank <= 2""")

MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
RUN_YEAR, RUN_MONTH = 2000, 6


@query("agg_24_co2_totals")
def agg24(spark, d):
    s = importer_sales(spark, d).filter(F.year("l_shipdate") == RUN_YEAR)
    plan = (s.withColumn("m", F.month("l_shipdate")).groupBy("p_brand")
              .pivot("m", list(range(1, 13))).agg(F.sum("l_quantity")))
    plan = plan.select("p_brand", *[F.coalesce(F.col(str(i + 1)), F.lit(0.0)).alias(MONTHS[i]) for i in range(12)])
    last = max(RUN_MONTH - 1, 1)
    long = plan.unpivot("p_brand", MONTHS[:last], "month", "qty")
    co2 = read(spark, d, "part", "p_brand", "p_size").groupBy("p_brand").agg(F.avg("p_size").alias("wltp"))
    j = long.groupBy("p_brand").agg(F.sum("qty").alias("plan_qty")).join(co2, "p_brand")
    return j.select("p_brand", rnd("plan_qty", 2).alias("plan_qty"), rnd(F.col("plan_qty") * F.col("wltp")).alias("wltp_total"),
                    rnd(F.col("plan_qty") * F.col("wltp") * 0.8).alias("nedc_total"))


sql("agg_24_co2_totals", f"""WITH {IMPORTER_SQL.strip()},
q AS (SELECT p_brand, sum(l_quantity) AS plan_qty FROM importer_sales WHERE year(l_shipdate) = {RUN_YEAR} AND month(l_shipdate) <= {max(RUN_MONTH - 1, 1)} GROUP BY p_brand),
c AS (SELECT p_brand, avg(p_size) AS wltp FROM part GROUP BY p_brand)
SELECT p_brand, {sql_rnd('plan_qty', 2)} AS plan_qty, {sql_rnd('plan_qty * wltp')} AS wltp_total, {sql_rnd('plan_qty * wltp * 0.8')} AS nedc_total FROM q JOIN c USING (p_brand)""")


@query("agg_27_weighted_sums_union")
def agg27(spark, d):
    li = read(spark, d, "lineitem", "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
    cur = li.filter(F.col("l_shipdate") >= "1999-01-01")
    hist = li.filter(F.col("l_shipdate") < "1999-01-01")
    u = cur.unionByName(hist).withColumn("year", F.year("l_shipdate"))
    disc = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return (u.groupBy("l_returnflag", "l_linestatus", "year")
             .agg(rnd(F.sum("l_quantity"), 2).alias("sum_qty"), rnd(F.sum("l_extendedprice"), 2).alias("sum_base_price"),
                  rnd(F.sum(disc), 2).alias("sum_disc_price"), rnd(F.sum(disc * (1 + F.col("l_tax"))), 2).alias("sum_charge"),
                  rnd(F.sum(F.col("l_extendedprice") * F.col("l_discount")), 2).alias("sum_discount"),
                  F.count(F.lit(1)).alias("count_order")))


sql("agg_27_weighted_sums_union", f"""WITH u AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01' UNION ALL SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01')
SELECT l_returnflag, l_linestatus, year(l_shipdate) AS year, {sql_rnd('sum(l_quantity)', 2)} AS sum_qty, {sql_rnd('sum(l_extendedprice)', 2)} AS sum_base_price,
  {sql_rnd('sum(l_extendedprice * (1 - l_discount))', 2)} AS sum_disc_price, {sql_rnd('sum(l_extendedprice * (1 - l_discount) * (1 + l_tax))', 2)} AS sum_charge,
  {sql_rnd('sum(l_extendedprice * l_discount)', 2)} AS sum_discount, count(*) AS count_order FROM u GROUP BY ALL""")


@query("agg_28_description_counts")
def agg28(spark, d):
    li = read(spark, d, "lineitem", "l_partkey", "l_extendedprice", "l_returnflag").filter(F.col("l_returnflag") == "R")
    p = read(spark, d, "part", "p_partkey", "p_name", "p_type")
    claims = li.join(p, F.col("l_partkey") == F.col("p_partkey"))
    g = claims.groupBy("p_name").agg(F.count(F.lit(1)).alias("n_claims"), F.avg("l_extendedprice").alias("avg_amount"))
    veh = p.groupBy("p_name").agg(F.min("p_type").alias("vehicle_type"))
    return g.join(veh, "p_name", "left").select("p_name", "n_claims", rnd("avg_amount", 2).alias("avg_amount"), "vehicle_type")


sql("agg_28_description_counts", f"""WITH g AS (SELECT p.p_name, count(*) AS n_claims, avg(l.l_extendedprice) AS a FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  WHERE l.l_returnflag = 'R' GROUP BY p.p_name), v AS (SELECT p_name, min(p_type) AS vehicle_type FROM part GROUP BY p_name)
SELECT g.p_name, n_claims, {sql_rnd('a', 2)} AS avg_amount, vehicle_type FROM g LEFT JOIN v USING (p_name)""")


@query("agg_29_latest_date_per_brand")
def agg29(spark, d):
    o = read(spark, d, "orders", "o_orderpriority", "o_orderdate")
    return o.groupBy("o_orderpriority").agg(dstr(F.max("o_orderdate")).alias("max_date"))


sql("agg_29_latest_date_per_brand", "SELECT o_orderpriority, strftime(max(o_orderdate), '%Y-%m-%d') AS max_date FROM orders GROUP BY ALL")


@query("agg_30_group_ordered_set")
def agg30(spark, d):
    c = read(spark, d, "customer", "c_nationkey", "c_mktsegment")
    g = aggs.group_ordered_set(c, "c_nationkey", "c_mktsegment")
    return g.select("c_nationkey", F.concat_ws("|", "members").alias("members"), F.size("members").alias("n_members"))


sql("agg_30_group_ordered_set", "SELECT c_nationkey, array_to_string(list_sort(list_distinct(list(c_mktsegment))), '|') AS members, CAST(count(DISTINCT c_mktsegment) AS INT) AS n_members FROM customer GROUP BY c_nationkey")


@query("agg_31_drop_rows_lacking_dates")
def agg31(spark, d):
    c = read(spark, d, "conversations", "conv_id", "turn")
    c = c.select("conv_id", "turn",
                 F.when(F.col("turn") % 3 == 0, F.lit(None)).otherwise(F.col("turn")).alias("close_date"),
                 F.when(F.col("turn") % 2 == 1, F.lit(None)).otherwise(F.col("turn")).alias("resolve_date"),
                 F.when(F.col("conv_id") % 5 == 0, F.lit(None)).otherwise(F.col("turn")).alias("assign_date"))
    return aggs.drop_rows_lacking(c, "conv_id", ["close_date", "resolve_date", "assign_date"]).select("conv_id", "turn")


sql("agg_31_drop_rows_lacking_dates", """WITH c AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN NULL ELSE turn END AS d1,
  CASE WHEN turn % 2 = 1 THEN NULL ELSE turn END AS d2, CASE WHEN conv_id % 5 = 0 THEN NULL ELSE turn END AS d3 FROM conversations),
s1 AS (SELECT conv_id, turn, d1, d2, d3 FROM (SELECT *, count(d1) OVER (PARTITION BY conv_id) AS h FROM c) WHERE d1 IS NOT NULL OR h = 0),
s2 AS (SELECT conv_id, turn, d1, d2, d3 FROM (SELECT *, count(d2) OVER (PARTITION BY conv_id) AS h FROM s1) WHERE d2 IS NOT NULL OR h = 0),
s3 AS (SELECT conv_id, turn FROM (SELECT *, count(d3) OVER (PARTITION BY conv_id) AS h FROM s2) WHERE d3 IS NOT NULL OR h = 0)
SELECT * FROM s3""")


@query("agg_33_correlation")
def agg33(spark, d):
    li = read(spark, d, "lineitem", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    c = aggs.correlation_long(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return c.select("col_a", "col_b", rnd("corr", 6).alias("corr"))


sql("agg_33_correlation", " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {sql_rnd(f'corr({a}, {b})', 6)} AS corr FROM lineitem"
    for a in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"] for b in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


@query("agg_34_mean_std")
def agg34(spark, d):
    li = read(spark, d, "lineitem", "l_extendedprice")
    return li.agg(rnd(F.avg("l_extendedprice")).alias("mean_total_price"), rnd(F.stddev_pop("l_extendedprice")).alias("std_total_price"))


sql("agg_34_mean_std", f"SELECT {sql_rnd('avg(l_extendedprice)')} AS mean_total_price, {sql_rnd('stddev_pop(l_extendedprice)')} AS std_total_price FROM lineitem")


@query("agg_37_distinct_suggestions")
def agg37(spark, d):
    c = read(spark, d, "customer", "c_nationkey", "c_mktsegment")
    g = c.distinct().groupBy("c_nationkey").agg(F.sort_array(F.collect_list("c_mktsegment")).alias("s"))
    return g.select("c_nationkey", F.concat_ws("|", "s").alias("suggestions"))


sql("agg_37_distinct_suggestions", "SELECT c_nationkey, array_to_string(list_sort(list(c_mktsegment)), '|') AS suggestions FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer) GROUP BY c_nationkey")


@query("agg_38_distinct_profiles")
def agg38(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return (c.filter(F.col("c_nationkey").isin(1, 2, 3, 5, 8) & F.col("c_acctbal").between(0, 5000) & (F.col("c_custkey") > 100))
             .select("c_mktsegment", "c_nationkey").distinct())


sql("agg_38_distinct_profiles", "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer WHERE c_nationkey IN (1, 2, 3, 5, 8) AND c_acctbal BETWEEN 0 AND 5000 AND c_custkey > 100")
