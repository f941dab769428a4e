"""PRJ-* registered queries on driver-table analogues."""

from __future__ import annotations

from pyspark.sql import functions as F

from forecourt.functions.fmt import big, dstr, rnd, sql_rnd
from forecourt.operators import clean
from forecourt.plans.registry import query
from forecourt.sources.fixtures import EVENTS_GAPS_SQL, events_gaps
from forecourt.sources.tables import LINE_KEY, read

LK = ", ".join(LINE_KEY)
ORACLE: dict[str, str] = {}


def sql(name, text):
    ORACLE[name] = text.strip()


@query("prj_01_lowercase")
def prj01(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_name", "p_type", "p_brand")
    return clean.lowercase(p, ["p_name", "p_type", "p_brand"])


sql("prj_01_lowercase", "SELECT p_partkey, lower(p_name) AS p_name, lower(p_type) AS p_type, lower(p_brand) AS p_brand FROM part")


@query("prj_02_strip")
def prj02(spark, d):
    c = read(spark, d, "conversations", "conv_id", "turn", "text")
    return clean.strip(c.withColumn("text", F.concat(F.lit("  "), "text", F.lit(" \n"))), ["text"])


sql("prj_02_strip", r"SELECT conv_id, turn, regexp_replace(concat('  ', text, ' ' || chr(10)), '^[\s]+|[\s]+$', '', 'g') AS text FROM conversations")


@query("prj_03_remove_columns")
def prj03(spark, d):
    df, _missing = clean.remove_columns(read(spark, d, "orders"), ["o_orderdate", "o_orderpriority", "o_not_there"])
    return df


sql("prj_03_remove_columns", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")


def _prj04(spark, d):
    li = read(spark, d, "lineitem", *LINE_KEY, "l_discount", "l_tax")
    return clean.remove_rows(li, [F.col("l_discount") == 0, F.col("l_tax") > 0.07], "l_orderkey")


@query("prj_04_remove_rows")
def prj04(spark, d):
    return _prj04(spark, d)[0]


sql("prj_04_remove_rows", f"SELECT {LK}, l_discount, l_tax FROM lineitem WHERE NOT (l_discount = 0 OR l_tax > 0.07)")


@query("prj_04_removed_units")
def prj04b(spark, d):
    return _prj04(spark, d)[1]


sql("prj_04_removed_units", "SELECT DISTINCT l_orderkey FROM lineitem WHERE l_discount = 0 OR l_tax > 0.07")

REWRITES = [("p_name", "red", "crimson"), ("p_name", "crimson w", "cw"), ("p_type", "ECO", "eco"),
            ("p_name", "bolt", "fastener")]


@query("prj_05_ordered_rewrites")
def prj05(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_name", "p_type")
    return clean.ordered_rewrites(p, REWRITES)


def _rw_sql():
    cols = {"p_name": "p_name", "p_type": "p_type"}
    for col, pat, rep in REWRITES:
        cols[col] = f"regexp_replace({cols[col]}, '\\b{pat}\\b|\\b{pat}', '{rep}', 'g')"
    return f"SELECT p_partkey, {cols['p_name']} AS p_name, {cols['p_type']} AS p_type FROM part"


sql("prj_05_ordered_rewrites", _rw_sql())


@query("prj_06_date_parts")
def prj06(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_orderdate")
    out = clean.date_parts(o, {"order_": "o_orderdate"})
    return out.select("o_orderkey", *[big(c).alias(c) for c in ("order_day", "order_month", "order_year")])


sql("prj_06_date_parts", """SELECT o_orderkey, CAST(day(o_orderdate) AS BIGINT) AS order_day,
  CAST(month(o_orderdate) AS BIGINT) AS order_month, CAST(year(o_orderdate) AS BIGINT) AS order_year FROM orders""")


@query("prj_07_rename")
def prj07(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_name", "c_acctbal")
    return clean.rename(c, ["c_name", "c_acctbal"], ["customer_name", "balance"])


sql("prj_07_rename", "SELECT c_custkey, c_name AS customer_name, c_acctbal AS balance FROM customer")


@query("prj_08_constant_columns")
def prj08(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_orderstatus")
    return clean.constants(clean.constants(o, ["nlr_code"], "701"), ["flag_a", "flag_b"], 0).withColumns(
        {"flag_a": big("flag_a"), "flag_b": big("flag_b")})


sql("prj_08_constant_columns", "SELECT o_orderkey, o_orderstatus, '701' AS nlr_code, CAST(0 AS BIGINT) AS flag_a, CAST(0 AS BIGINT) AS flag_b FROM orders")


@query("prj_09_cast_all")
def prj09(spark, d):
    return clean.cast_all(read(spark, d, "customer", "c_custkey", "c_nationkey", "c_mktsegment"), "string")


sql("prj_09_cast_all", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer")


@query("prj_11_fill_from")
def prj11(spark, d):
    e = events_gaps(spark, d)
    return clean.fill_from(e, "value", "value2").select("event_id", rnd("value", 4).alias("value"))


sql("prj_11_fill_from", f"WITH {EVENTS_GAPS_SQL.strip()} SELECT event_id, {sql_rnd('coalesce(value, value2)')} AS value FROM events_gaps")


@query("prj_12_fill_const")
def prj12(spark, d):
    e = events_gaps(spark, d)
    return clean.fill_const(e, {"value": 0.0, "value2": -1.0}).select(
        "event_id", rnd("value").alias("value"), rnd("value2").alias("value2"))


sql("prj_12_fill_const", f"WITH {EVENTS_GAPS_SQL.strip()} SELECT event_id, {sql_rnd('coalesce(value, 0.0)')} AS value, {sql_rnd('coalesce(value2, -1.0)')} AS value2 FROM events_gaps")


@query("prj_13_literal_removal")
def prj13(spark, d):
    return clean.literal_removal(read(spark, d, "documents", "doc_id", "text"), "text")


sql("prj_13_literal_removal", r"SELECT doc_id, regexp_replace(text, '\n|\r|\t|\\u', ' ', 'g') AS text FROM documents")


@query("prj_14_null_if_match")
def prj14(spark, d):
    p = read(spark, d, "pages", "page_id", "url")
    return clean.null_if_match(p, "url", r"[?#]")


sql("prj_14_null_if_match", r"SELECT page_id, CASE WHEN regexp_matches(url, '[?#]') THEN NULL ELSE url END AS url FROM pages")

PAIRS = [("Brand#1", "PROMO"), ("Brand#7", "STANDARD"), ("Brand#13", "LARGE")]


@query("prj_14_paired_replacement")
def prj14b(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_brand", "p_type")
    pairs = spark.createDataFrame(PAIRS, "value string, repl string")
    return clean.paired_replacement(p, "p_brand", "p_type", F.broadcast(pairs))


sql("prj_14_paired_replacement", """SELECT p_partkey, p_brand, CASE p_brand """ + " ".join(
    f"WHEN '{a}' THEN '{b}'" for a, b in PAIRS) + " ELSE p_type END AS p_type FROM part")


@query("prj_15_keep_non_null")
def prj15(spark, d):
    e = events_gaps(spark, d).select("event_id", "value", "value2")
    return clean.keep_non_null(e, ["value", "value2"]).select("event_id", rnd("value").alias("value"), rnd("value2").alias("value2"))


sql("prj_15_keep_non_null", f"WITH {EVENTS_GAPS_SQL.strip()} SELECT event_id, {sql_rnd('value')} AS value, {sql_rnd('value2')} AS value2 FROM events_gaps WHERE value IS NOT NULL AND value2 IS NOT NULL")


@query("prj_16_recode")
def prj16(spark, d):
    return clean.recode(read(spark, d, "orders", "o_orderkey", "o_orderpriority"), "o_orderpriority", "5-LOW", "4-NOT SPECIFIED")


sql("prj_16_recode", "SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN '4-NOT SPECIFIED' ELSE o_orderpriority END AS o_orderpriority FROM orders")


@query("prj_18_boolean_text")
def prj18(spark, d):
    li = read(spark, d, *(["lineitem"] + LINE_KEY + ["l_returnflag"]))
    li = li.withColumn("returned", (F.col("l_returnflag") == "R").cast("int")).drop("l_returnflag")
    return clean.boolean_text(li, ["returned"], to_text=True)


sql("prj_18_boolean_text", f"SELECT {LK}, CASE WHEN l_returnflag = 'R' THEN 'Sim' ELSE 'Não' END AS returned FROM lineitem")


@query("prj_21_numeric_split")
def prj21(spark, d):
    num, _other = clean.split_by_type(events_gaps(spark, d).select("event_id", "event_type", "value", "value2"))
    return num.select("event_id", rnd("value").alias("value"), rnd("value2").alias("value2"))


sql("prj_21_numeric_split", f"WITH {EVENTS_GAPS_SQL.strip()} SELECT event_id, {sql_rnd('value')} AS value, {sql_rnd('value2')} AS value2 FROM events_gaps WHERE value IS NOT NULL AND value2 IS NOT NULL")


@query("prj_24_round")
def prj24(spark, d):
    li = read(spark, d, *(["lineitem"] + LINE_KEY + ["l_discount"]))
    return li.select(*LINE_KEY, rnd(F.col("l_extendedprice") * (1 - F.col("l_discount")), 1).alias("net_1"),
                     rnd(F.col("l_extendedprice") / 7, 3).alias("seventh_3"))


sql("prj_24_round", f"SELECT {LK}, {sql_rnd('l_extendedprice * (1 - l_discount)', 1)} AS net_1, {sql_rnd('l_extendedprice / 7', 3)} AS seventh_3 FROM lineitem")


@query("prj_25_generic_filter")
def prj25(spark, d):
    li = read(spark, d, *(["lineitem"] + LINE_KEY + ["l_returnflag", "l_linestatus"]))
    return clean.generic_filter(li, [10, ["R", "A"], "F", []], ["l_quantity", "l_returnflag", "l_linestatus", "l_suppkey"],
                                ["ge", "in", None, "in"])


sql("prj_25_generic_filter", f"SELECT {LK}, l_returnflag, l_linestatus FROM lineitem WHERE l_quantity >= 10 AND l_returnflag IN ('R', 'A') AND l_linestatus = 'F'")


@query("prj_26_dash_filter_dedupe")
def prj26(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    f = clean.dash_filter(p, ["-", ["SMALL", "LARGE"], 20], ["p_brand", "p_type", "p_size"], qty_col="p_size")
    return clean.dedupe_first(f, ["p_brand", "p_type"], [F.desc("p_retailprice"), "p_partkey"])


sql("prj_26_dash_filter_dedupe", """SELECT p_partkey, p_brand, p_type, p_size, p_retailprice FROM (
  SELECT *, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_retailprice DESC, p_partkey) AS rn
  FROM part WHERE p_type IN ('SMALL', 'LARGE') AND p_size >= 20) WHERE rn = 1""")


@query("prj_36_first_token")
def prj36(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_name")
    return p.select("p_partkey", clean.first_token("p_name").alias("first_word"))


sql("prj_36_first_token", "SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word FROM part")


@query("prj_37_threshold_grouping")
def prj37(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    c = c.withColumn("segment_nation", F.concat_ws("/", "c_mktsegment", F.col("c_nationkey").cast("string")))
    return clean.threshold_grouping(c, "segment_nation", "segment_nation", "other", 12).select("c_custkey", "segment_nation")


sql("prj_37_threshold_grouping", """SELECT c_custkey, CASE WHEN count(*) OVER (PARTITION BY sn) < 12 THEN 'other' ELSE sn END AS segment_nation
FROM (SELECT c_custkey, concat_ws('/', c_mktsegment, CAST(c_nationkey AS VARCHAR)) AS sn FROM customer)""")


@query("prj_38_keep_repeated")
def prj38(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_custkey")
    return clean.keep_frequent(o, "o_custkey", 2)


sql("prj_38_keep_repeated", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) >= 2)")


@query("prj_39_keep_min_family")
def prj39(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_brand", "p_type")
    p = p.withColumn("family", F.concat_ws("-", "p_brand", "p_type"))
    return clean.keep_frequent(p, "family", 16).select("p_partkey", "family")


sql("prj_39_keep_min_family", """SELECT p_partkey, family FROM (SELECT p_partkey, concat_ws('-', p_brand, p_type) AS family FROM part)
WHERE family IN (SELECT concat_ws('-', p_brand, p_type) FROM part GROUP BY 1 HAVING count(*) >= 16)""")


@query("prj_41_null_coverage")
def prj41(spark, d):
    e = events_gaps(spark, d)
    e = e.withColumn("value3", F.when(F.col("event_id") % 3 == 0, F.lit(None)).otherwise(F.col("value")))
    return e.filter(clean.null_coverage_count(["value", "value2", "value3"]) < 2).select("event_id")


sql("prj_41_null_coverage", f"""WITH {EVENTS_GAPS_SQL.strip()}
SELECT event_id FROM events_gaps
WHERE CAST(value IS NULL AS INT) + CAST(value2 IS NULL AS INT) + CAST((CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END) IS NULL AS INT) < 2""")


@query("prj_44_dedupe_first")
def prj44(spark, d):
    li = read(spark, d, *(["lineitem"] + LINE_KEY))
    return clean.dedupe_first(li, ["l_orderkey", "l_linenumber"], LINE_KEY[2:])


sql("prj_44_dedupe_first", f"""SELECT {LK} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""")


@query("prj_45_sequence_number")
def prj45(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_retailprice")
    return clean.sequence_number(p, ["p_retailprice", "p_partkey"])


sql("prj_45_sequence_number", "SELECT p_partkey, p_retailprice, CAST(row_number() OVER (ORDER BY p_retailprice, p_partkey) - 1 AS BIGINT) AS idx FROM part")


@query("prj_06b_order_dates_text")
def prj06b(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_orderdate")
    return o.select("o_orderkey", dstr("o_orderdate").alias("order_date"))


sql("prj_06b_order_dates_text", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM orders")
