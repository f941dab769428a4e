"""JON-* and SET-* registered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from forecourt.functions.fmt import big, dstr, rnd, sql_rnd
from forecourt.operators import joins, ml, sets
from forecourt.plans.registry import query
from forecourt.session import small
from forecourt.sources.fixtures import places
from forecourt.sources.tables import LINE_KEY, read

LK = ", ".join(LINE_KEY)
ORACLE: dict[str, str] = {}


def sql(name, text):
    ORACLE[name] = text.strip()


# ----------------------------------------------------------------- JON-01..03

@query("jon_01_left_join")
def jon01(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_custkey", "o_totalprice").withColumnRenamed("o_custkey", "custkey") \
        .withColumn("balance", F.col("o_totalprice"))
    c = read(spark, d, "customer", "c_custkey", "c_name", "c_acctbal").withColumnRenamed("c_custkey", "custkey") \
        .withColumn("balance", F.col("c_acctbal")).filter(F.col("custkey") % 10 != 3)
    return joins.left_join(o, c, "custkey").select("o_orderkey", "custkey", "c_name", "balance_x", "balance_y")


sql("jon_01_left_join", """SELECT o.o_orderkey, o.o_custkey AS custkey, c.c_name, o.o_totalprice AS balance_x, c.c_acctbal AS balance_y
FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 10 <> 3) c ON o.o_custkey = c.c_custkey""")


def _place_map(spark, d):
    pl = places(spark, d)
    return pl.filter(F.col("place_v2") != "ASIA").select(F.col("place").alias("Original_Value"),
                                                          F.col("place_v2").alias("Mapped_Value"))


def _jon02(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    n = read(spark, d, "nation", "n_nationkey", "n_name")
    seg = (read(spark, d, "customer", "c_mktsegment").distinct()
           .select(F.col("c_mktsegment").alias("Original_Value"),
                   F.substring("c_mktsegment", 1, 3).alias("Mapped_Value")))
    out = c.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"), "left").withColumnRenamed("n_name", "place")
    out = joins.map_values(out, "place", small(_place_map(spark, d)), "place_v2")
    out = joins.map_values(out, "c_mktsegment", seg, "segment_group")
    return out.select("c_custkey", "place", "place_v2", "segment_group")


@query("jon_02_mapping_joins")
def jon02(spark, d):
    return _jon02(spark, d)


_JON02_SQL = """WITH pm AS (SELECT n.n_name AS o, r.r_name AS m FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE r.r_name <> 'ASIA'),
sg AS (SELECT DISTINCT c_mktsegment AS o, substr(c_mktsegment, 1, 3) AS m FROM customer),
j AS (SELECT c.c_custkey, n.n_name AS place, pm.m AS place_v2, sg.m AS segment_group
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN pm ON n.n_name = pm.o LEFT JOIN sg ON c.c_mktsegment = sg.o)"""
sql("jon_02_mapping_joins", _JON02_SQL + " SELECT * FROM j")


@query("prj_27_unmapped_report")
def prj27(spark, d):
    return _jon02(spark, d).filter(F.col("place_v2").isNull()).select("place", "c_custkey").distinct()


sql("prj_27_unmapped_report", _JON02_SQL + " SELECT DISTINCT place, c_custkey FROM j WHERE place_v2 IS NULL")


def _stock(spark, d):
    li = read(spark, d, "lineitem", *LINE_KEY)
    k = F.col("l_partkey").cast("string")
    ref = (F.when(F.col("l_partkey") % 4 == 0, F.concat(F.lit("00"), k))
            .when(F.col("l_partkey") % 4 == 1, F.concat(F.lit("BM"), k))
            .when(F.col("l_partkey") % 4 == 2, F.concat(k, F.lit("AT")))
            .otherwise(F.concat(k, F.lit("-X"))))
    return li.withColumn("ref", ref)


STOCK_SQL = f"""stock AS (SELECT {LK}, CASE WHEN l_partkey % 4 = 0 THEN concat('00', CAST(l_partkey AS VARCHAR))
  WHEN l_partkey % 4 = 1 THEN concat('BM', CAST(l_partkey AS VARCHAR))
  WHEN l_partkey % 4 = 2 THEN concat(CAST(l_partkey AS VARCHAR), 'AT')
  ELSE concat(CAST(l_partkey AS VARCHAR), '-X') END AS ref FROM lineitem),
master AS (SELECT CAST(p_partkey AS VARCHAR) AS mref, p_name AS d FROM part WHERE p_partkey % 5 <> 0)"""


def _master(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_name").filter(F.col("p_partkey") % 5 != 0)
    return p.select(F.col("p_partkey").cast("string").alias("mref"), F.col("p_name").alias("description"))


@query("jon_03_references_merge")
def jon03(spark, d):
    s = _stock(spark, d).withColumn("description", F.lit(None).cast("string"))
    s = s.withColumn("plain", F.regexp_replace("ref", "^(BM|VW)|^0+|AT$|-X$", ""))
    allrows, _m, _u = joins.references_merge(s, _master(spark, d), "plain", "mref")
    return allrows.select(*LINE_KEY, "ref", "description")


sql("jon_03_references_merge", f"""WITH {STOCK_SQL}
SELECT s.{LK.replace(', ', ', s.')}, s.ref, m.d AS description
FROM (SELECT *, regexp_replace(ref, '^(BM|VW)|^0+|AT$|-X$', '', 'g') AS plain FROM stock) s LEFT JOIN master m ON s.plain = m.mref""")

# Cascade passes (fixed values of this fixture): plain; brand code + leading
# zeros removed; hyphen suffix removed; trailing letters removed.
PASSES = [
    lambda c: c,
    lambda c: F.regexp_replace(F.regexp_replace(c, "^(BM|VW)", ""), "^0+", ""),
    lambda c: F.regexp_replace(c, "-[A-Z0-9]*$", ""),
    lambda c: F.regexp_replace(c, "[A-Z]+$", ""),
]
PASSES_SQL = [
    "{c}",
    "regexp_replace(regexp_replace({c}, '^(BM|VW)', ''), '^0+', '')",
    "regexp_replace({c}, '-[A-Z0-9]*$', '')",
    "regexp_replace({c}, '[A-Z]+$', '')",
]


@query("jon_04_cascade_match")
def jon04(spark, d):
    out = joins.cascade_match(_stock(spark, d), _master(spark, d), PASSES, "ref", "mref", "description")
    return out.select(*LINE_KEY, "ref", "matched_desc", "match_pass")


def _cascade_sql():
    sc = " UNION ALL ".join(f"SELECT ref, {i} AS pass, {p.format(c='ref')} AS key FROM refs" for i, p in enumerate(PASSES_SQL))
    mc = " UNION ALL ".join(f"SELECT {i} AS pass, {p.format(c='mref')} AS key, d FROM master" for i, p in enumerate(PASSES_SQL))
    return f"""WITH {STOCK_SQL},
refs AS (SELECT DISTINCT ref FROM stock WHERE ref IS NOT NULL),
sc AS (SELECT * FROM ({sc}) WHERE key IS NOT NULL AND key <> ''),
mc AS (SELECT pass, key, min(d) AS d FROM ({mc}) WHERE key IS NOT NULL AND key <> '' GROUP BY pass, key),
best AS (SELECT ref, arg_min(d, pass) AS matched_desc, min(pass) AS match_pass FROM sc JOIN mc USING (pass, key) GROUP BY ref)
SELECT {LK}, ref, matched_desc, CAST(match_pass AS BIGINT) AS match_pass FROM stock LEFT JOIN best USING (ref)"""


sql("jon_04_cascade_match", _cascade_sql())


@query("jon_05_inner_join")
def jon05(spark, d):
    doc = read(spark, d, "documents", "doc_id", "source", "n_chars")
    lab = read(spark, d, "labels", "doc_id", "quality", "toxic")
    return doc.join(lab, "doc_id", "inner").select("doc_id", "source", "n_chars", big("quality").alias("quality"), big("toxic").alias("toxic"))


sql("jon_05_inner_join", "SELECT doc_id, source, n_chars, CAST(quality AS BIGINT) AS quality, CAST(toxic AS BIGINT) AS toxic FROM documents JOIN labels USING (doc_id)")


def _families(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_type", "p_size")
    return p.select("p_partkey", F.col("p_type").alias("family"),
                    (F.col("p_size") / 50.0).alias("probability"))


def _corrections(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_brand")
    return p.filter(F.col("p_partkey") % 11 == 0).select("p_partkey", F.concat(F.lit("FAM-"), F.col("p_brand")).alias("family_corr"))


@query("jon_06_override_start")
def jon06(spark, d):
    out = joins.override(_families(spark, d), _corrections(spark, d), "p_partkey", "family", "family_corr")
    return out.select("p_partkey", "family")


_CORR_SQL = "corr AS (SELECT p_partkey, min(concat('FAM-', p_brand)) AS fc FROM part WHERE p_partkey % 11 = 0 GROUP BY p_partkey)"
sql("jon_06_override_start", f"WITH {_CORR_SQL} SELECT p.p_partkey, coalesce(c.fc, p.p_type) AS family FROM part p LEFT JOIN corr c USING (p_partkey)")


@query("jon_07_override_end")
def jon07(spark, d):
    out = joins.override(_families(spark, d), _corrections(spark, d), "p_partkey", "family", "family_corr", prob_col="probability")
    return out.select("p_partkey", "family", rnd("probability").alias("probability"))


sql("jon_07_override_end", f"""WITH {_CORR_SQL} SELECT p.p_partkey, coalesce(c.fc, p.p_type) AS family,
  {sql_rnd('CASE WHEN c.fc IS NOT NULL THEN 1.0 ELSE p.p_size / 50.0 END')} AS probability FROM part p LEFT JOIN corr c USING (p_partkey)""")


@query("jon_08_dimension_fallback")
def jon08(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_size")
    types = read(spark, d, "part", "p_size", "p_type").groupBy("p_size").agg(F.min("p_type").alias("t"))
    dim = types.filter(F.col("p_size") % 3 != 0).select("p_size", F.col("t").alias("group_desc"))
    alt = types.filter(F.col("p_size") % 2 == 0).select(F.col("p_size").alias("alt_code"),
                                                       F.concat(F.lit("ALT "), "t").alias("alt_desc"))
    return (p.join(dim, "p_size", "left").join(alt, F.col("p_size") == F.col("alt_code"), "left")
             .select("p_partkey", F.coalesce("group_desc", "alt_desc", F.col("p_size").cast("string")).alias("group_label")))


sql("jon_08_dimension_fallback", """WITH t AS (SELECT p_size, min(p_type) AS t FROM part GROUP BY p_size)
SELECT p.p_partkey, coalesce(d.t, 'ALT ' || a.t, CAST(p.p_size AS VARCHAR)) AS group_label
FROM part p LEFT JOIN (SELECT * FROM t WHERE p_size % 3 <> 0) d ON p.p_size = d.p_size
LEFT JOIN (SELECT * FROM t WHERE p_size % 2 = 0) a ON p.p_size = a.p_size""")


@query("jon_09_keyed_update")
def jon09(spark, d):
    doc = read(spark, d, "documents", "doc_id", "lang").withColumnRenamed("lang", "label")
    new = read(spark, d, "labels", "doc_id", "quality").select("doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("prediction"))
    return joins.keyed_update(doc, new, "doc_id", "label")


sql("jon_09_keyed_update", """SELECT d.doc_id, coalesce('q' || CAST(l.quality AS VARCHAR), d.lang) AS label,
  CAST(l.quality IS NOT NULL AS BIGINT) AS Classification_Flag FROM documents d LEFT JOIN labels l USING (doc_id)""")


@query("jon_10_update_versions")
def jon10(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_name", "p_type")
    newv = (read(spark, d, "part", "p_partkey", "p_brand").filter(F.col("p_partkey") % 6 == 1)
            .select("p_partkey", F.concat(F.lit("v2 "), "p_brand").alias("name_new"), F.lit("NEW").alias("type_new")))
    return (p.join(newv, "p_partkey", "left")
             .select("p_partkey", F.coalesce("name_new", "p_name").alias("p_name"), F.coalesce("type_new", "p_type").alias("p_type")))


sql("jon_10_update_versions", """SELECT p.p_partkey, coalesce(n.nn, p.p_name) AS p_name, coalesce(n.nt, p.p_type) AS p_type FROM part p
LEFT JOIN (SELECT p_partkey, concat('v2 ', p_brand) AS nn, 'NEW' AS nt FROM part WHERE p_partkey % 6 = 1) n USING (p_partkey)""")


@query("jon_11_manual_labels")
def jon11(spark, d):
    doc = read(spark, d, "documents", "doc_id", "source").withColumnRenamed("source", "label")
    manual = read(spark, d, "conversations", "conv_id", "role").select(F.col("conv_id").alias("doc_id"), F.col("role").alias("manual"))
    return joins.override(doc, manual, "doc_id", "label", "manual")


sql("jon_11_manual_labels", """SELECT d.doc_id, coalesce(m.manual, d.source) AS label FROM documents d
LEFT JOIN (SELECT conv_id AS doc_id, min(role) AS manual FROM conversations GROUP BY conv_id) m USING (doc_id)""")

GRID = {"liability": ["LL1", "LL2"], "own_damage": ["FI0", "FI1", "FI2"], "glass": ["AR"]}


@query("jon_12_scenario_grid")
def jon12(spark, d):
    seg = read(spark, d, "customer", "c_mktsegment").distinct()
    return joins.value_grid(seg, GRID)


sql("jon_12_scenario_grid", "SELECT c_mktsegment, liability, own_damage, glass FROM (SELECT DISTINCT c_mktsegment FROM customer), "
    + ", ".join(f"(SELECT unnest([{', '.join(repr(v) for v in vals)}]) AS {k})" for k, vals in GRID.items()))


@query("jon_13_profile_means")
def jon13(spark, d):
    grid = joins.value_grid(read(spark, d, "customer", "c_mktsegment").distinct()
                            .withColumn("seg", F.upper("c_mktsegment")).drop("c_mktsegment"), {"prio": ["1-urgent", "2-high"]})
    prof = (read(spark, d, "orders", "o_custkey", "o_orderpriority", "o_totalprice", "o_orderstatus")
            .join(read(spark, d, "customer", "c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
            .withColumn("status", F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderstatus"))))
    j = grid.join(prof, (F.lower("seg") == F.lower("c_mktsegment")) & (F.lower("prio") == F.lower("o_orderpriority")))
    return j.groupBy("seg", "prio", "status").agg(rnd(F.avg("o_totalprice"), 4).alias("avg_total"))


sql("jon_13_profile_means", f"""WITH grid AS (SELECT upper(c_mktsegment) AS seg, prio FROM (SELECT DISTINCT c_mktsegment FROM customer), (SELECT unnest(['1-urgent', '2-high']) AS prio)),
prof AS (SELECT o.o_orderpriority, o.o_totalprice, CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE o.o_orderstatus END AS status, c.c_mktsegment
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT seg, prio, status, {sql_rnd('avg(o_totalprice)')} AS avg_total FROM grid JOIN prof ON lower(seg) = lower(c_mktsegment) AND lower(prio) = lower(o_orderpriority)
GROUP BY seg, prio, status""")


@query("jon_15_latest_rows")
def jon15(spark, d):
    li = read(spark, d, "lineitem", *LINE_KEY, "l_shipdate")
    last = joins.latest_rows(li, ["l_partkey"], "l_shipdate")
    return last.groupBy("l_partkey").agg(dstr(F.max("l_shipdate")).alias("last_sell_date"),
                                         rnd(F.avg(F.col("l_extendedprice") / F.col("l_quantity"))).alias("avg_unit_price"),
                                         F.count(F.lit(1)).alias("n_rows"))


sql("jon_15_latest_rows", f"""SELECT l_partkey, strftime(max(l_shipdate), '%Y-%m-%d') AS last_sell_date, {sql_rnd('avg(l_extendedprice / l_quantity)')} AS avg_unit_price,
  count(*) AS n_rows FROM lineitem l WHERE l_shipdate = (SELECT max(l_shipdate) FROM lineitem x WHERE x.l_partkey = l.l_partkey) GROUP BY l_partkey""")


@query("jon_16_case_condition_join")
def jon16(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    c = read(spark, d, "customer", "c_custkey", "c_mktsegment")
    cond = (F.col("o_custkey") == F.col("c_custkey")) & (
        F.col("c_mktsegment") == F.when(F.col("o_orderpriority").startswith("1"), F.lit("AUTOMOBILE")).otherwise(F.col("c_mktsegment")))
    j = o.join(c, cond, "left").select("o_orderkey", "o_orderpriority", "c_mktsegment", "o_totalprice").distinct()
    return j.groupBy("o_orderpriority", "c_mktsegment").agg(rnd(F.coalesce(F.sum("o_totalprice"), F.lit(0.0)), 2).alias("total"))


sql("jon_16_case_condition_join", f"""SELECT o_orderpriority, c_mktsegment, {sql_rnd('coalesce(sum(o_totalprice), 0.0)', 2)} AS total FROM (
  SELECT DISTINCT o.o_orderkey, o.o_orderpriority, c.c_mktsegment, o.o_totalprice FROM orders o LEFT JOIN customer c
  ON o.o_custkey = c.c_custkey AND c.c_mktsegment = CASE WHEN starts_with(o.o_orderpriority, '1') THEN 'AUTOMOBILE' ELSE c.c_mktsegment END)
GROUP BY o_orderpriority, c_mktsegment""")


@query("jon_17_left_join_filters")
def jon17(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment")
    o = read(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderpriority")
    j = c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
    return (j.filter(F.col("o_orderpriority").isNotNull() & (F.substring("o_orderpriority", 1, 1) != "5")
                     & (F.length("c_name") > 0) & ~F.col("c_mktsegment").startswith("HOUSE"))
             .select("c_custkey", "o_orderkey", "o_orderpriority"))


sql("jon_17_left_join_filters", """SELECT c.c_custkey, o.o_orderkey, o.o_orderpriority FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
WHERE o.o_orderpriority IS NOT NULL AND left(o.o_orderpriority, 1) <> '5' AND length(c.c_name) > 0 AND NOT starts_with(c.c_mktsegment, 'HOUSE')""")


@query("jon_18_semi_join")
def jon18s(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_custkey")
    keep = read(spark, d, "customer", "c_custkey", "c_mktsegment").filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    return joins.semi(o, keep, "o_custkey")


sql("jon_18_semi_join", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")


@query("jon_18_anti_join")
def jon18a(spark, d):
    doc = read(spark, d, "documents", "doc_id", "source")
    done = read(spark, d, "labels", "doc_id")
    return joins.anti(doc, done, "doc_id")


sql("jon_18_anti_join", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")


@query("jon_19_one_to_one_check")
def jon19(spark, d):
    a = read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity")
    b = read(spark, d, "orders", "o_orderkey").withColumnRenamed("o_orderkey", "l_orderkey").withColumn("l_linenumber", F.lit(1))
    _j, dup = joins.one_to_one(a, b, ["l_orderkey", "l_linenumber"])
    return dup


sql("jon_19_one_to_one_check", """SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION SELECT o_orderkey, 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1""")


@query("jon_20_dimension_enrichment")
def jon20(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_custkey")
    c = read(spark, d, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    return (o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
             .join(F.broadcast(places(spark, d)), F.col("c_nationkey") == F.col("n_nationkey"), "left")
             .select("o_orderkey", "c_mktsegment", "place", "place_v2"))


sql("jon_20_dimension_enrichment", """SELECT o.o_orderkey, c.c_mktsegment, n.n_name AS place, r.r_name AS place_v2 FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")


@query("jon_21_struct_semi_join")
def jon21(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_brand", "p_type", "p_size")
    li = read(spark, d, "lineitem", *LINE_KEY).join(p, F.col("l_partkey") == F.col("p_partkey"))
    cfg = F.struct("p_brand", "p_type", (F.col("p_size") % 5).alias("sc"))
    sel = (li.groupBy(cfg.alias("cfg")).count().filter(F.col("count") >= 100).select("cfg"))
    return li.withColumn("cfg", cfg).join(sel, "cfg", "left_semi").select(*LINE_KEY, "p_brand", "p_type")


sql("jon_21_struct_semi_join", f"""WITH li AS (SELECT l.*, p.p_brand, p.p_type, p.p_size % 5 AS sc FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
SELECT {LK}, p_brand, p_type FROM li WHERE (p_brand, p_type, sc) IN (SELECT (p_brand, p_type, sc) FROM li GROUP BY p_brand, p_type, sc HAVING count(*) >= 100)""")


@query("jon_23_membership_flags")
def jon23(spark, d):
    mv = read(spark, d, "lineitem", *LINE_KEY, "l_returnflag")
    purchases = read(spark, d, "orders", "o_orderkey", "o_orderstatus").filter(F.col("o_orderstatus") == "P").select(F.col("o_orderkey").alias("l_orderkey"))
    adjust = read(spark, d, "supplier", "s_suppkey", "s_nationkey").filter(F.col("s_nationkey") < 5)
    return joins.membership_flags(mv, purchases, "l_orderkey", adjust, "l_suppkey",
                                  flag_keys_col="s_suppkey").select(*LINE_KEY, "regulation_flag")


sql("jon_23_membership_flags", f"""SELECT {LK}, CAST(l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 5) AS BIGINT) AS regulation_flag
FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""")

# ----------------------------------------------------------------- SET-01..06


@query("set_01_union_all")
def set01(spark, d):
    li = read(spark, d, "lineitem", *LINE_KEY, "l_shipdate")
    cur = li.filter(F.col("l_shipdate") >= "1999-01-01").withColumn("src", F.lit("current"))
    hist = li.filter(F.col("l_shipdate") < "1999-01-01").withColumn("src", F.lit("history"))
    return sets.union_all([cur, hist]).select(*LINE_KEY, "src")


sql("set_01_union_all", f"""SELECT {LK}, 'current' AS src FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01'
UNION ALL SELECT {LK}, 'history' AS src FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01'""")


@query("set_02_union_per_platform")
def set02(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    frames = [c.filter(F.col("c_mktsegment") == s).select(F.lit(s).alias("platform"), F.col("c_nationkey").alias("code"))
              for s in ml.all_values(c, "c_mktsegment")]
    return sets.union_all(frames).distinct()


sql("set_02_union_per_platform", "SELECT DISTINCT c_mktsegment AS platform, c_nationkey AS code FROM customer")


def _snap(spark, d, lo, hi):
    p = read(spark, d, "part", "p_partkey", "p_brand", "p_retailprice")
    return p.filter((F.col("p_partkey") % 10 >= lo) & (F.col("p_partkey") % 10 < hi))


@query("set_03_union_distinct")
def set03(spark, d):
    new = _snap(spark, d, 0, 7).withColumn("run", F.lit("new"))
    prev = _snap(spark, d, 3, 10).withColumn("run", F.lit("prev"))
    return sets.union_distinct(new, prev, ["run"])


sql("set_03_union_distinct", """SELECT DISTINCT p_partkey, p_brand, p_retailprice FROM (
SELECT p_partkey, p_brand, p_retailprice FROM part WHERE p_partkey % 10 < 7 UNION ALL SELECT p_partkey, p_brand, p_retailprice FROM part WHERE p_partkey % 10 >= 3)""")


@query("set_04_union_keep_old")
def set04(spark, d):
    li = read(spark, d, "lineitem", "l_partkey", "l_shipdate", "l_quantity")
    day = F.to_date("l_shipdate").alias("day")
    old = li.filter(F.col("l_shipdate") < "2000-01-01").groupBy("l_partkey", day).agg(F.sum("l_quantity").alias("qty")).withColumn("src", F.lit("old"))
    new = li.filter(F.col("l_shipdate") >= "1999-07-01").groupBy("l_partkey", day).agg(F.sum("l_quantity").alias("qty")).withColumn("src", F.lit("new"))
    out = sets.union_keep_old(old, new, ["l_partkey", "day"])
    return out.select("l_partkey", dstr("day").alias("day"), rnd("qty", 2).alias("qty"), "src")


sql("set_04_union_keep_old", f"""WITH old AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS qty, 'old' AS src FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01' GROUP BY 1, 2),
new AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS qty, 'new' AS src FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-07-01' GROUP BY 1, 2),
u AS (SELECT * FROM old UNION ALL SELECT * FROM new WHERE (l_partkey, day) NOT IN (SELECT (l_partkey, day) FROM old))
SELECT l_partkey, strftime(day, '%Y-%m-%d') AS day, {sql_rnd('qty', 2)} AS qty, src FROM u""")


def _as_text(df):
    return df.select(F.col("p_partkey").cast("string").alias("p_partkey"), F.coalesce("p_brand", F.lit("")).alias("p_brand"),
                     rnd("p_retailprice", 4).cast("string").alias("price"))


@query("set_05_symmetric_difference")
def set05(spark, d):
    new = _snap(spark, d, 0, 7).withColumn("p_retailprice", F.when(F.col("p_partkey") % 13 == 0, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice")))
    prev = _snap(spark, d, 3, 10)
    return sets.symmetric_difference(_as_text(new), _as_text(prev), ["p_partkey", "p_brand", "price"])


sql("set_05_symmetric_difference", f"""WITH n AS (SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS p_partkey, coalesce(p_brand, '') AS p_brand,
   CAST({sql_rnd('CASE WHEN p_partkey % 13 = 0 THEN p_retailprice + 1 ELSE p_retailprice END')} AS VARCHAR) AS price FROM part WHERE p_partkey % 10 < 7),
p AS (SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS p_partkey, coalesce(p_brand, '') AS p_brand, CAST({sql_rnd('p_retailprice')} AS VARCHAR) AS price FROM part WHERE p_partkey % 10 >= 3)
SELECT p_partkey, p_brand, price FROM (SELECT * FROM n UNION ALL SELECT * FROM p) GROUP BY ALL HAVING count(*) = 1""")


@query("set_06_word_intersection")
def set06(spark, d):
    p = read(spark, d, "part", "p_name", "p_type")
    words = p.select("p_type", F.explode(F.split("p_name", " ")).alias("word"))
    a = words.filter(F.col("p_type") == "SMALL")
    b = words.filter(F.col("p_type") == "LARGE")
    return sets.intersect_values(a, b, "word")


sql("set_06_word_intersection", """SELECT DISTINCT word FROM (SELECT p_type, unnest(string_split(p_name, ' ')) AS word FROM part) WHERE p_type = 'SMALL'
INTERSECT SELECT DISTINCT word FROM (SELECT p_type, unnest(string_split(p_name, ' ')) AS word FROM part) WHERE p_type = 'LARGE'""")
