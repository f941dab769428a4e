"""Remaining PRJ rows, AGG-15 feature contribution, WIN-15 movement
cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from forecourt.functions.fmt import big, dstr, rnd, sql_rnd
from forecourt.operators import aggs, clean
from forecourt.plans.classify import FLAG_NAMES, _cls07_sql, _colour_sql, vehicle_features
from forecourt.plans.registry import query
from forecourt.sources.tables import LINE_KEY, read

LK = ", ".join(LINE_KEY)
ORACLE: dict[str, str] = {}


def sql(name, text):
    ORACLE[name] = text.strip()


# Fixed colour recoding of this fixture ('0' = drop).
COLOUR_MAP = {"red": "vermelho", "blue": "azul", "green": "0", "black": "preto"}


@query("prj_17_colour_recode")
def prj17(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_name").withColumn("colour", F.split("p_name", " ").getItem(0))
    m = F.create_map(*[x for kv in COLOUR_MAP.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    p = p.withColumn("colour", F.coalesce(F.element_at(m, F.col("colour")), F.col("colour")))
    return p.filter(F.col("colour") != "0").select("p_partkey", "colour")


sql("prj_17_colour_recode", "SELECT p_partkey, colour FROM (SELECT p_partkey, CASE split_part(p_name, ' ', 1) " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in COLOUR_MAP.items()) + " ELSE split_part(p_name, ' ', 1) END AS colour FROM part) WHERE colour <> '0'")


def _prj19(spark, d):
    li = read(spark, d, "lineitem", *LINE_KEY, "l_tax")
    li = li.withColumn("cost", F.col("l_extendedprice") * F.col("l_tax"))
    return aggs.total_price(li, "l_orderkey", "cost")


@query("prj_19_zero_total_removal")
def prj19(spark, d):
    return _prj19(spark, d).filter(F.col("price_total") != 0).select(*LINE_KEY)


sql("prj_19_zero_total_removal", f"SELECT {LK} FROM (SELECT *, sum(l_extendedprice * l_tax) OVER (PARTITION BY l_orderkey) AS t FROM lineitem) WHERE t <> 0")


@query("prj_19_removed_vehicles")
def prj19c(spark, d):
    x = _prj19(spark, d)
    return x.agg((F.count_distinct("l_orderkey") - F.count_distinct(F.when(F.col("price_total") != 0, F.col("l_orderkey")))).alias("removed_vehicles"))


sql("prj_19_removed_vehicles", "SELECT count(DISTINCT l_orderkey) - count(DISTINCT CASE WHEN t <> 0 THEN l_orderkey END) AS removed_vehicles FROM (SELECT *, sum(l_extendedprice * l_tax) OVER (PARTITION BY l_orderkey) AS t FROM lineitem)")


@query("prj_20_constant_columns")
def prj20(spark, d):
    li = read(spark, d, "lineitem", "l_returnflag", "l_linestatus", "l_discount", "l_tax").filter(F.col("l_returnflag") == "R")
    return aggs.distinct_profile(li)


sql("prj_20_constant_columns", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct, CAST(count(DISTINCT {c}) = 1 AS BIGINT) AS is_constant FROM lineitem WHERE l_returnflag = 'R'"
    for c in ["l_returnflag", "l_linestatus", "l_discount", "l_tax"]))


@query("prj_28_filter_cascade_audit")
def prj28(spark, d):
    li = read(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_shipdate", "l_returnflag", "l_discount")
    o = read(spark, d, "orders", "o_orderkey", "o_orderdate")
    p = read(spark, d, "part", "p_partkey", "p_type")
    x = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(p, F.col("l_partkey") == F.col("p_partkey"))
    steps = [("negative_days", F.col("l_shipdate") >= F.col("o_orderdate")), ("demo", F.col("l_returnflag") != "R"),
             ("taxi", F.col("p_type") != "PROMO"), ("undefined_model", F.col("l_discount") != 0)]
    passed, aggs_ = F.lit(True), [F.count_distinct("l_orderkey").alias("initial")]
    for name, cond in steps:
        passed = passed & cond
        aggs_.append(F.count_distinct(F.when(passed, F.col("l_orderkey"))).alias(name))
    r = x.agg(*aggs_)
    names = ["initial"] + [n for n, _ in steps]
    return r.select(F.explode(F.array(*[F.struct(F.lit(i).alias("step_no"), F.lit(n).alias("step"), F.col(n).alias("units"))
                                        for i, n in enumerate(names)])).alias("s")).select("s.*")


sql("prj_28_filter_cascade_audit", """WITH x AS (SELECT l.l_orderkey, l.l_shipdate >= o.o_orderdate AS c1, l.l_returnflag <> 'R' AS c2, p.p_type <> 'PROMO' AS c3, l.l_discount <> 0 AS c4
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey)
SELECT 0 AS step_no, 'initial' AS step, count(DISTINCT l_orderkey) AS units FROM x
UNION ALL SELECT 1, 'negative_days', count(DISTINCT CASE WHEN c1 THEN l_orderkey END) FROM x
UNION ALL SELECT 2, 'demo', count(DISTINCT CASE WHEN c1 AND c2 THEN l_orderkey END) FROM x
UNION ALL SELECT 3, 'taxi', count(DISTINCT CASE WHEN c1 AND c2 AND c3 THEN l_orderkey END) FROM x
UNION ALL SELECT 4, 'undefined_model', count(DISTINCT CASE WHEN c1 AND c2 AND c3 AND c4 THEN l_orderkey END) FROM x""")


@query("prj_29_duration_bounds")
def prj29(spark, d):
    doc = read(spark, d, "documents", "doc_id", "n_chars", "source")
    x = doc.withColumn("d1", F.when(F.col("doc_id") % 9 == 0, F.lit(None)).otherwise(F.col("n_chars") / 10.0)) \
           .withColumn("d2", (F.col("doc_id") % 50).cast("double")) \
           .withColumn("label", F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("Draw: "), F.col("source"))).otherwise(F.col("source")))
    x = x.withColumn("label", F.regexp_replace("label", "^Draw: .+", "Não Definido"))
    ok = (F.col("d1").between(5, 1000)) & (F.col("d2") < 45)
    return x.filter(F.coalesce(ok, F.lit(False))).select("doc_id", rnd("d1").alias("d1"), rnd("d2").alias("d2"), "label")


sql("prj_29_duration_bounds", f"""WITH x AS (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE n_chars / 10.0 END AS d1, CAST(doc_id % 50 AS DOUBLE) AS d2,
  regexp_replace(CASE WHEN doc_id % 4 = 0 THEN 'Draw: ' || source ELSE source END, '^Draw: .+', 'Não Definido') AS label FROM documents)
SELECT doc_id, {sql_rnd('d1')} AS d1, {sql_rnd('d2')} AS d2, label FROM x WHERE coalesce(d1 BETWEEN 5 AND 1000 AND d2 < 45, false)""")


def _classified(spark, d):
    doc = read(spark, d, "documents", "doc_id", "source")
    lab = read(spark, d, "labels", "doc_id", "quality")
    return doc.join(lab, "doc_id", "left").withColumn(
        "label", F.when(F.col("quality").isNull(), F.lit("Não Definido")).otherwise(F.concat(F.lit("Q"), F.col("quality").cast("string"))))


@query("prj_30_classified_split")
def prj30(spark, d):
    x = _classified(spark, d)
    return x.withColumn("classified", (F.col("label") != "Não Definido").cast("bigint")).select("doc_id", "label", "classified")


sql("prj_30_classified_split", """SELECT d.doc_id, CASE WHEN l.quality IS NULL THEN 'Não Definido' ELSE 'Q' || CAST(l.quality AS VARCHAR) END AS label,
  CAST(l.quality IS NOT NULL AS BIGINT) AS classified FROM documents d LEFT JOIN labels l USING (doc_id)""")

OTHER_FAMILIES = ["PROMO", "ECONOMY"]


@query("prj_31_three_way_split")
def prj31(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_type", "p_size")
    fam = F.when(F.col("p_size") % 10 == 1, F.lit("1")).otherwise(F.col("p_type"))
    p = p.withColumn("family", fam)
    bucket = F.when(F.col("family") == "1", "unclassified").when(F.col("family").isin(OTHER_FAMILIES), "other").otherwise("main")
    return p.select("p_partkey", "family", bucket.alias("bucket"))


sql("prj_31_three_way_split", """SELECT p_partkey, family, CASE WHEN family = '1' THEN 'unclassified' WHEN family IN ('PROMO', 'ECONOMY') THEN 'other' ELSE 'main' END AS bucket
FROM (SELECT p_partkey, CASE WHEN p_size % 10 = 1 THEN '1' ELSE p_type END AS family FROM part)""")


def _refs_at(spark, d):
    p = read(spark, d, "part", "p_partkey")
    return p.select("p_partkey", F.when(F.col("p_partkey") % 4 == 2, F.concat(F.col("p_partkey").cast("string"), F.lit("AT")))
                    .otherwise(F.concat(F.lit("BM"), F.col("p_partkey").cast("string"))).alias("ref"))


@query("prj_32_lookbehind_exclusion")
def prj32(spark, d):
    # Java regex look-behind: 'AT' at the end, preceded by exactly 3 to 4 digits
    return _refs_at(spark, d).filter(~F.col("ref").rlike(r"(?<=^[0-9]{3,4})AT$"))


sql("prj_32_lookbehind_exclusion", r"""SELECT p_partkey, ref FROM (SELECT p_partkey, CASE WHEN p_partkey % 4 = 2 THEN CAST(p_partkey AS VARCHAR) || 'AT' ELSE 'BM' || CAST(p_partkey AS VARCHAR) END AS ref FROM part)
WHERE NOT regexp_matches(ref, '^[0-9]{3,4}AT$')""")


@query("prj_33_recent_distinct_parts")
def prj33(spark, d):
    li = read(spark, d, "lineitem", "l_partkey", "l_shipdate")
    refs = _refs_at(spark, d)
    mx = li.agg(F.max("l_shipdate")).scalar()
    x = li.filter((F.col("l_shipdate") > F.add_months(mx, -12)) & (F.col("l_shipdate") <= mx)) \
          .join(refs, F.col("l_partkey") == F.col("p_partkey")).select("ref").distinct()
    x = x.filter(~F.col("ref").endswith("AT"))
    return x.withColumn("odd_ref", (F.col("ref").rlike("^[A-Z]{2}") & (F.length("ref") > 5)).cast("bigint"))


sql("prj_33_recent_distinct_parts", """WITH refs AS (SELECT p_partkey, CASE WHEN p_partkey % 4 = 2 THEN CAST(p_partkey AS VARCHAR) || 'AT' ELSE 'BM' || CAST(p_partkey AS VARCHAR) END AS ref FROM part),
mx AS (SELECT max(l_shipdate) AS m FROM lineitem),
x AS (SELECT DISTINCT r.ref FROM lineitem l JOIN refs r ON l.l_partkey = r.p_partkey, mx WHERE l.l_shipdate > mx.m - INTERVAL 12 MONTH AND l.l_shipdate <= mx.m)
SELECT ref, CAST(regexp_matches(ref, '^[A-Z]{2}') AND length(ref) > 5 AS BIGINT) AS odd_ref FROM x WHERE NOT ends_with(ref, 'AT')""")

TODAY = "2000-06-01"


@query("prj_34_live_ranges")
def prj34(spark, d):
    li = read(spark, d, "lineitem", "l_partkey", "l_shipdate")
    pdb = li.groupBy("l_partkey").agg(F.min("l_shipdate").alias("start"), F.max("l_shipdate").alias("end_raw"))
    pdb = pdb.withColumn("end", F.when(F.col("l_partkey") % 5 == 0, F.lit(None)).otherwise(F.col("end_raw")))
    live = pdb.filter(F.col("start").isNotNull() & ((F.col("end") >= F.lit(TODAY).cast("timestamp")) | F.col("end").isNull())).select("l_partkey")
    matched = read(spark, d, "part", "p_partkey", "p_size").filter(F.col("p_size") % 10 == 0).select(F.col("p_partkey").alias("l_partkey"))
    return live.unionByName(matched).distinct()


sql("prj_34_live_ranges", f"""WITH pdb AS (SELECT l_partkey, min(l_shipdate) AS st, CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE max(l_shipdate) END AS en FROM lineitem GROUP BY l_partkey)
SELECT l_partkey FROM pdb WHERE st IS NOT NULL AND (en >= TIMESTAMP '{TODAY}' OR en IS NULL) UNION SELECT p_partkey FROM part WHERE p_size % 10 = 0""")


@query("prj_35_duplicate_column_names")
def prj35(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_totalprice").toDF("key", "value")
    c = read(spark, d, "orders", "o_orderkey", "o_custkey").toDF("key2", "value")
    j = o.join(c, F.col("key") == F.col("key2")).drop("key2")
    seen, names = {}, []
    for n in j.columns:
        if n in seen:
            seen[n] += 1
            names.append(f"{n}_{seen[n]}")
        else:
            seen[n] = 0
            names.append(n)
    return j.toDF(*names).select("key", rnd("value", 2).alias("value"), F.col("value_1").cast("bigint").alias("value_1"))


sql("prj_35_duplicate_column_names", f"SELECT o_orderkey AS key, {sql_rnd('o_totalprice', 2)} AS value, o_custkey AS value_1 FROM orders")


@query("prj_40_prepare_and_aggregate")
def prj40(spark, d):
    li = read(spark, d, "lineitem", "l_partkey", "l_extendedprice", "l_quantity", "l_returnflag")
    x = li.withColumn("grp", F.when(F.col("l_partkey") % 13 == 0, F.lit(None)).otherwise(F.col("l_returnflag")))
    x = x.na.drop(subset=["grp"]).withColumn("desc", F.when(F.col("l_quantity") > 45, F.lit(None)).otherwise(F.lit("x")))
    x = x.na.fill({"desc": ""})
    return x.groupBy("l_partkey").agg(F.concat_ws(" ", F.array_sort(F.collect_set("desc"))).alias("descs"),
                                      aggs.mode_value("grp").alias("family"), rnd(F.avg("l_extendedprice"), 4).alias("avg_cost"))


sql("prj_40_prepare_and_aggregate", f"""WITH x AS (SELECT l_partkey, l_extendedprice, l_returnflag AS grp, coalesce(CASE WHEN l_quantity > 45 THEN NULL ELSE 'x' END, '') AS "desc" FROM lineitem WHERE l_partkey % 13 <> 0),
fam AS (SELECT l_partkey, grp AS family FROM (SELECT l_partkey, grp, row_number() OVER (PARTITION BY l_partkey ORDER BY count(*) DESC, grp) AS rn FROM x GROUP BY l_partkey, grp) WHERE rn = 1)
SELECT x.l_partkey, array_to_string(list_sort(list_distinct(list("desc"))), ' ') AS descs, any_value(fam.family) AS family, {sql_rnd('avg(l_extendedprice)')} AS avg_cost
FROM x JOIN fam USING (l_partkey) GROUP BY x.l_partkey""")


@query("prj_42_retail_app_dataset")
def prj42(spark, d):
    f = vehicle_features(spark, d)
    f = f.withColumnRenamed("version", "Versao").filter(F.col("Versao").isNotNull() & (F.col("colour") != "undefined"))
    return clean.boolean_text(f.select("l_orderkey", "navigation", "alarm", "Versao", "colour"), ["navigation", "alarm"], to_text=True)


sql("prj_42_retail_app_dataset", f"""WITH {_cls07_sql().replace('WITH ', '', 1).rsplit('SELECT l_orderkey, ', 1)[0].strip()},
feat AS (SELECT l_orderkey, navigation, alarm, version, coalesce({_colour_sql()}, 'undefined') AS colour FROM g)
SELECT l_orderkey, CASE WHEN navigation = 1 THEN 'Sim' ELSE 'Não' END AS navigation, CASE WHEN alarm = 1 THEN 'Sim' ELSE 'Não' END AS alarm, version AS Versao, colour
FROM feat WHERE version IS NOT NULL AND colour <> 'undefined'""")


@query("prj_43_version_match_dataset")
def prj43(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_name", "p_type", "p_brand")
    x = p.withColumn("model", F.lower("p_type")).withColumn("p_name", F.when(F.col("p_partkey") % 29 == 0, F.lit(None)).otherwise(F.col("p_name")))
    x = x.na.drop(subset=["model"])
    x = clean.dedupe_first(x, ["model", "p_brand", "p_name"], ["p_partkey"])
    return x.na.fill({"p_name": ""}).select("p_partkey", "model", "p_brand", "p_name")


sql("prj_43_version_match_dataset", """SELECT p_partkey, model, p_brand, coalesce(p_name, '') AS p_name FROM (SELECT *, row_number() OVER (PARTITION BY model, p_brand, p_name ORDER BY p_partkey) AS rn
FROM (SELECT p_partkey, lower(p_type) AS model, p_brand, CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE p_name END AS p_name FROM part) WHERE model IS NOT NULL) WHERE rn = 1""")


@query("agg_15_feature_contribution")
def agg15(spark, d):
    f = vehicle_features(spark, d)
    o = read(spark, d, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    x = f.join(o, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("score_class_gt", (F.col("o_orderstatus") == "F").cast("int"))
    x = x.withColumn("Versao", F.coalesce("version", F.lit("outros")))
    r = aggs.feature_contribution(x, "o_orderpriority", "score_class_gt", ["navigation", "alarm", "led"], ["Versao", "colour"])
    return r.select("o_orderpriority", "features", rnd("difference", 6).alias("difference"), rnd("difference_normalized", 6).alias("difference_normalized"))


def _agg15_sql():
    base = _cls07_sql().replace("WITH ", "", 1).rsplit("SELECT l_orderkey, ", 1)[0].strip()
    feats = [("navigation", True), ("alarm", True), ("led", True), ("Versao", False), ("colour", False)]
    longs = " UNION ALL ".join(
        f"SELECT o_orderpriority, c, '{n}' AS feature, CAST({n} AS VARCHAR) AS value, {str(b).upper()} AS is_bool FROM x" for n, b in feats)
    return f"""WITH {base},
feat AS (SELECT l_orderkey, navigation, alarm, led, coalesce(version, 'outros') AS Versao, coalesce({_colour_sql()}, 'undefined') AS colour FROM g),
x AS (SELECT feat.*, o.o_orderpriority, CAST(o.o_orderstatus = 'F' AS INT) AS c FROM feat JOIN orders o ON feat.l_orderkey = o.o_orderkey),
tot AS (SELECT o_orderpriority, count(*) AS n, sum(CASE WHEN c = 1 THEN 1 ELSE 0 END) AS n1 FROM x GROUP BY ALL),
lg AS ({longs}),
cells AS (SELECT o_orderpriority, feature, value, is_bool, count(*) AS f1, sum(CASE WHEN c = 1 THEN 1 ELSE 0 END) AS c1f1 FROM lg GROUP BY ALL),
df AS (SELECT cells.o_orderpriority, CASE WHEN is_bool THEN feature || '_sim' ELSE feature || '_' || value END AS features,
  c1f1 / f1 - (n1 - c1f1) / (n - f1) AS difference FROM cells JOIN tot USING (o_orderpriority)
  WHERE (NOT is_bool OR value = '1') AND (is_bool OR value <> 'outros') AND f1 > 0 AND n - f1 > 0),
rg AS (SELECT o_orderpriority, greatest(abs(min(difference)), max(difference)) AS m FROM df GROUP BY ALL)
SELECT o_orderpriority, features, {sql_rnd('difference', 6)} AS difference, {sql_rnd('difference / m', 6)} AS difference_normalized FROM df JOIN rg USING (o_orderpriority)"""


sql("agg_15_feature_contribution", _agg15_sql())


def _movements_al(spark, d):
    li = read(spark, d, "lineitem", *LINE_KEY, "l_shipdate", "l_returnflag")
    return li.select(*LINE_KEY, F.to_date("l_shipdate").alias("day"), (F.col("l_partkey") % 50).alias("part"),
                     (F.col("l_orderkey") % 500).alias("wip"), (F.col("l_linenumber") % 3).alias("audit"),
                     F.col("l_suppkey").alias("document"), "l_returnflag")


@query("win_15_duplicate_movement_cleaning")
def win15(spark, d):
    al = _movements_al(spark, d)
    sales = al.filter(F.col("l_returnflag") == "N").select("day", "part", "wip", "document")
    out = aggs.duplicate_movement_cleaning(al, sales, ["day", "part", "wip"], "audit", "document", LINE_KEY)
    return out.select(*LINE_KEY)


sql("win_15_duplicate_movement_cleaning", f"""WITH al AS (SELECT {LK}, CAST(l_shipdate AS DATE) AS day, l_partkey % 50 AS part, l_orderkey % 500 AS wip, l_linenumber % 3 AS audit,
  l_suppkey AS document, l_returnflag FROM lineitem),
sales AS (SELECT day, part, wip, document FROM al WHERE l_returnflag = 'N'),
g AS (SELECT day, part, wip, count(*) AS size, count(DISTINCT audit) AS na FROM al GROUP BY ALL),
s AS (SELECT day, part, wip, count(*) AS ns FROM sales GROUP BY ALL),
docs AS (SELECT DISTINCT day, part, wip, document, 1 AS i FROM sales),
x AS (SELECT al.*, g.size, g.na, coalesce(s.ns, 0) AS ns, docs.i,
  row_number() OVER (PARTITION BY al.day, al.part, al.wip ORDER BY {', '.join(f'al.{c} DESC' for c in LINE_KEY)}) = 1 AS is_last
  FROM al JOIN g USING (day, part, wip) LEFT JOIN s USING (day, part, wip) LEFT JOIN docs ON al.day = docs.day AND al.part = docs.part AND al.wip = docs.wip AND al.document = docs.document)
SELECT {LK} FROM x WHERE NOT (size > 1 AND na < size) OR ns > size OR (ns > 0 AND ns <= size AND i IS NOT NULL) OR (ns = 0 AND is_last)""")
