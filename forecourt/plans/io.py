"""SRC-* / GAT-* / SNK-* registered queries.  Readers that need files read
data Spark first derives from the driver tables and writes to the shared
checkpoint folder; sinks return the table state they would write."""

from __future__ import annotations

import uuid
import zlib

from pyspark.sql import functions as F

from forecourt.functions.fmt import big, dstr, rnd, sql_rnd
from forecourt.operators import ml
from forecourt.plans.registry import query
from forecourt.session import scratch_table_path
from forecourt.sources import io
from forecourt.sources.fixtures import LANG_PRED_SQL, lang_predictions
from forecourt.sources.tables import LINE_KEY, TABLES, read

LK = ", ".join(LINE_KEY)
ORACLE: dict[str, str] = {}


def sql(name, text):
    ORACLE[name] = text.strip()


@query("src_01_read_delimited")
def src01(spark, d):
    li = read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    li = li.withColumn("note", F.concat(F.lit("peça "), F.col("l_returnflag")))
    path = scratch_table_path(spark, f"src01_{uuid.uuid4().hex[:8]}")
    li.write.option("sep", ";").option("header", True).option("encoding", "iso-8859-1").csv(path)
    schema = "l_orderkey bigint, l_linenumber int, l_quantity double, l_returnflag string, note string"
    return io.read_delimited_retry(spark, path, schema, sep=";", columns=["l_orderkey", "l_linenumber", "l_quantity", "note"])


sql("src_01_read_delimited", "SELECT l_orderkey, l_linenumber, l_quantity, 'peça ' || l_returnflag AS note FROM lineitem")


@query("src_02_scan_filter")
def src02(spark, d):
    li = read(spark, d, "lineitem")
    return io.scan_filter(li, {"l_returnflag": ["R", "A"], "l_linestatus": "F"}, LINE_KEY + ["l_tax"], {"l_tax": "tax"})


sql("src_02_scan_filter", f"SELECT {LK}, l_tax AS tax FROM lineitem WHERE l_returnflag IN ('R', 'A') AND l_linestatus = 'F'")


@query("src_03_free_query")
def src03(spark, d):
    for t in ("orders", "customer"):
        read(spark, d, t).createOrReplaceTempView(f"fc_{t}")
    return io.run_query(spark, "SELECT c.c_mktsegment, count(*) AS n_orders FROM fc_orders o JOIN fc_customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_mktsegment")


sql("src_03_free_query", "SELECT c.c_mktsegment, count(*) AS n_orders FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_mktsegment")


@query("src_04_mapping_long")
def src04(spark, d):
    p = read(spark, d, "part", "p_type", "p_brand", "p_name")
    return io.mapping_long(p, "p_type", ["p_brand", "p_name"])


sql("src_04_mapping_long", "SELECT DISTINCT p_type, value FROM (SELECT p_type, p_brand AS value FROM part UNION ALL SELECT p_type, p_name FROM part) WHERE value IS NOT NULL")


@query("src_05_history_union")
def src05(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_orderdate")
    txt = o.select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("Data"))
    cur, hist = txt.filter(F.col("o_orderkey") % 2 == 0), txt.filter(F.col("o_orderkey") % 2 == 1)
    u = io.union_frames([cur, hist], "source", ["current", "history"]).withColumnRenamed("Data", "movement_date")
    return u.select("o_orderkey", dstr(F.to_date("movement_date", "dd/MM/yyyy")).alias("movement_date"), "source")


sql("src_05_history_union", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS movement_date, CASE WHEN o_orderkey % 2 = 0 THEN 'current' ELSE 'history' END AS source FROM orders")


@query("src_06_dw_retrieval")
def src06(spark, d):
    li = read(spark, d, "lineitem", *LINE_KEY, "l_shipdate")
    li = li.withColumn("ship_int", (F.year("l_shipdate") * 10000 + F.month("l_shipdate") * 100 + F.dayofmonth("l_shipdate")))
    x = li.filter(F.col("l_suppkey").isin(1, 2, 3, 5, 8, 13) & (F.col("ship_int") >= 19980101))
    return x.select(*LINE_KEY, dstr(io.yyyymmdd("ship_int")).alias("ship_date"))


sql("src_06_dw_retrieval", f"SELECT {LK}, strftime(l_shipdate, '%Y-%m-%d') AS ship_date FROM lineitem WHERE l_suppkey IN (1, 2, 3, 5, 8, 13) AND l_shipdate >= TIMESTAMP '1998-01-01'")

FW_POS, FW_NAMES, FW_FILES = [0, 8, 32, 44], ["part_ref", "part_desc", "brand"], 4


@query("src_07_fixed_width")
def src07(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_name", "p_brand")
    pid = F.pmod(F.hash("p_partkey"), F.lit(FW_FILES))
    line = F.concat(F.rpad(F.col("p_partkey").cast("string"), 8, " "), F.rpad("p_name", 24, " "), F.rpad("p_brand", 12, " "))
    data = p.select(pid.alias("pid"), F.lit(1).alias("kind"), F.col("p_partkey").alias("k"), line.alias("value"))
    ends = spark.range(FW_FILES).select(F.col("id").cast("int").alias("pid"))
    head = ends.select("pid", F.lit(0).alias("kind"), F.lit(-1).cast("bigint").alias("k"), F.lit("HDR master file").alias("value"))
    tail = ends.select("pid", F.lit(2).alias("kind"), F.lit(-1).cast("bigint").alias("k"), F.lit("TRL end of file").alias("value"))
    path = scratch_table_path(spark, f"src07_{uuid.uuid4().hex[:8]}")
    (data.unionByName(head).unionByName(tail).repartition(FW_FILES, "pid").sortWithinPartitions("pid", "kind", "k")
         .select("pid", "value").write.mode("overwrite").partitionBy("pid").text(path))
    return io.read_fixed_width(spark, path + "/*", FW_POS, FW_NAMES, skip_header=True, skip_tail=True)


sql("src_07_fixed_width", "SELECT CAST(p_partkey AS VARCHAR) AS part_ref, trim(substr(p_name, 1, 24)) AS part_desc, trim(substr(p_brand, 1, 12)) AS brand FROM part")


@query("src_09_platform_union")
def src09(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    platforms = ml.all_values(c, "c_mktsegment")
    frames = [c.filter(F.col("c_mktsegment") == s).select("c_custkey", "c_nationkey") for s in platforms]
    u = io.union_frames(frames, "platform", platforms)
    n = F.broadcast(read(spark, d, "nation", "n_nationkey", "n_name"))
    return u.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "platform", "n_name")


sql("src_09_platform_union", "SELECT c.c_custkey, c.c_mktsegment AS platform, n.n_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey")


@query("src_12_fill_missing_key")
def src12(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_custkey")
    sales = o.select("o_orderkey", F.when(F.col("o_orderkey") % 10 == 0, F.lit(None)).otherwise(F.col("o_custkey").cast("string")).alias("account"))
    return io.fill_missing_key(sales, o, "o_orderkey", "account", "o_custkey", "702_")


sql("src_12_fill_missing_key", "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN '702_' || CAST(o_custkey AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) END AS account FROM orders")


@query("src_13_cached_table")
def src13(spark, d):
    def build():
        return read(spark, d, "orders", "o_orderstatus", "o_totalprice").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    tag = f"{zlib.crc32(d.encode()):08x}"
    return io.cached(spark, f"src13_{tag}", "2000-01-01", build)


sql("src_13_cached_table", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")


@query("gat_01_volume_gate")
def gat01(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_orderdate")
    last = o.filter(F.col("o_orderdate") < "2000-01-01").agg(F.count_distinct("o_orderkey")).scalar()
    a = io.volume_gate(o, "o_orderkey", 100).withColumn("check", F.lit("minimum"))
    b = io.volume_gate(o, "o_orderkey", last_count=last).select("units", "status").withColumn("check", F.lit("history"))
    return a.unionByName(b)


sql("gat_01_volume_gate", """SELECT count(DISTINCT o_orderkey) AS units, CASE WHEN count(DISTINCT o_orderkey) < 100 THEN 'error' ELSE 'ok' END AS status, 'minimum' AS "check" FROM orders
UNION ALL SELECT count(DISTINCT o_orderkey), CASE WHEN count(DISTINCT o_orderkey) < (SELECT count(DISTINCT o_orderkey) FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01') THEN 'error'
  WHEN count(DISTINCT o_orderkey) = (SELECT count(DISTINCT o_orderkey) FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01') THEN 'warning' ELSE 'append' END, 'history' FROM orders""")


@query("gat_02_freshness_gate")
def gat02(spark, d):
    o = read(spark, d, "orders", "o_orderdate")
    return io.freshness_gate(o, "o_orderdate", "2002-01-01", 30).select(dstr("last_date").alias("last_date"), "stale")


sql("gat_02_freshness_gate", "SELECT strftime(max(o_orderdate), '%Y-%m-%d') AS last_date, CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2002-01-01') >= 30 AS BIGINT) AS stale FROM orders")


@query("gat_03_max_date_default")
def gat03(spark, d):
    li = read(spark, d, "lineitem", "l_shipdate", "l_returnflag")
    a = io.max_date_or_default(li.filter(F.col("l_returnflag") == "X"), "l_shipdate").withColumn("case", F.lit("empty"))
    b = io.max_date_or_default(li, "l_shipdate").withColumn("case", F.lit("all"))
    return a.unionByName(b).select("case", dstr("max_date").alias("max_date"))


sql("gat_03_max_date_default", """SELECT 'empty' AS "case", strftime(coalesce(max(CAST(l_shipdate AS DATE)), DATE '1960-01-01'), '%Y-%m-%d') AS max_date FROM lineitem WHERE l_returnflag = 'X'
UNION ALL SELECT 'all', strftime(coalesce(max(CAST(l_shipdate AS DATE)), DATE '1960-01-01'), '%Y-%m-%d') FROM lineitem""")


@query("gat_04_latest_run_rows")
def gat04(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_orderdate")
    return io.latest_run_before(o, "o_orderdate", "1998-06-01").select("o_orderkey", dstr("o_orderdate").alias("run_date"))


sql("gat_04_latest_run_rows", """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS run_date FROM orders
WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '1998-06-01')""")


@query("gat_05_last_history_row")
def gat05(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    r = io.last_row(o, "o_orderdate", ["o_orderkey"])
    return r.select("o_orderkey", "o_custkey", dstr("o_orderdate").alias("o_orderdate"))


sql("gat_05_last_history_row", "SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")


@query("gat_06_watermark")
def gat06(spark, d):
    li = read(spark, d, "lineitem", "l_shipdate")
    w = io.watermark(li, "l_shipdate", "2001-06-01")
    return w.select(dstr("last_date").alias("last_date"), dstr("second_last_date").alias("second_last_date"), "already_processed")


sql("gat_06_watermark", """WITH ds AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)
SELECT strftime(max(d), '%Y-%m-%d') AS last_date, strftime(max(d) FILTER (WHERE d < (SELECT max(d) FROM ds)), '%Y-%m-%d') AS second_last_date,
  CAST(max(d) >= DATE '2001-06-01' AS BIGINT) AS already_processed FROM ds""")


@query("snk_02_stamped_append")
def snk02(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_mktsegment")
    c = c.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 9 == 0, F.lit("NULL")).otherwise(F.col("c_mktsegment")))
    path = scratch_table_path(spark, f"snk02_{uuid.uuid4().hex[:8]}")
    even, odd = c.filter("c_custkey % 2 = 0"), c.filter("c_custkey % 2 = 1")
    io.append_rows(even, path, "2000-12-31", check_days=1)
    io.append_rows(odd, path, "2001-01-01", check_days=1)
    io.append_rows(odd, path, "2001-01-01", check_days=1)   # fresh: nothing is written
    return spark.read.parquet(path)


sql("snk_02_stamped_append", "SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment, CASE WHEN c_custkey % 2 = 0 THEN '2000-12-31' ELSE '2001-01-01' END AS Date FROM customer")


@query("snk_05_delete_where", stored=True)
def snk05(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    return io.delete_where(o, {"o_orderstatus": ["F", "P"], "o_orderpriority": "1-URGENT"})


sql("snk_05_delete_where", "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE NOT coalesce(o_orderstatus IN ('F', 'P') AND o_orderpriority = '1-URGENT', false)")


@query("snk_07_keyed_update", stored=True)
def snk07(spark, d):
    doc = read(spark, d, "documents", "doc_id", "lang", "source")
    upd = read(spark, d, "labels", "doc_id", "quality", "toxic").select(
        "doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("source"), F.when(F.col("toxic") == 1, F.lit("xx")).alias("lang"))
    return io.keyed_update(doc, upd, ["doc_id"], ["source", "lang"])


sql("snk_07_keyed_update", """SELECT d.doc_id, coalesce(u.lang, d.lang) AS lang, coalesce(u.source, d.source) AS source FROM documents d
LEFT JOIN (SELECT doc_id, min('q' || CAST(quality AS VARCHAR)) AS source, min(CASE WHEN toxic = 1 THEN 'xx' END) AS lang FROM labels GROUP BY doc_id) u USING (doc_id)""")


@query("snk_11_mapping_rows", stored=True)
def snk11(spark, d):
    r = read(spark, d, "region", "r_regionkey", "r_name")
    n = read(spark, d, "nation", "n_name", "n_regionkey")
    dl = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.collect_list("n_name").alias("originals"))
    return io.mapping_rows(dl, "r_name", "originals")


sql("snk_11_mapping_rows", "SELECT n.n_name AS Original_Value, r.r_name AS Mapped_Value FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey")

CLASSES = ["de", "en", "es", "fr"]


@query("snk_12_confusion_table")
def snk12(spark, d):
    return io.confusion_table(lang_predictions(spark, d), "actual", "predicted", CLASSES).select(
        "Actual", *[big(c).alias(c) for c in CLASSES], big("Totals").alias("Totals"))


sql("snk_12_confusion_table", f"""WITH {LANG_PRED_SQL.strip()} SELECT actual AS Actual, {', '.join(f"CAST(count(*) FILTER (WHERE predicted = '{c}') AS BIGINT) AS {c}" for c in CLASSES)},
  CAST(count(*) FILTER (WHERE predicted IN ({', '.join(repr(c) for c in CLASSES)})) AS BIGINT) AS Totals FROM lang_pred GROUP BY actual""")


@query("snk_13_text_output", stored=True)
def snk13(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_totalprice", "o_orderstatus")
    return io.cast_output(o.withColumn("o_totalprice", rnd("o_totalprice", 2)), {"o_orderkey": "VHE_Number", "o_totalprice": "Price"},
                          extra={"NLR_Code": "701"})


sql("snk_13_text_output", f"SELECT CAST(o_orderkey AS VARCHAR) AS VHE_Number, CAST({sql_rnd('o_totalprice', 2)} AS VARCHAR) AS Price, o_orderstatus, '701' AS NLR_Code FROM orders")


@query("snk_16_parts_output", stored=True)
def snk16(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_type", "p_retailprice")
    x = p.select(F.col("p_partkey").alias("Part_Ref"), F.when(F.col("p_partkey") % 8 == 0, F.lit(None)).otherwise(F.col("p_type")).alias("Part_Ref_Group_Desc"),
                 F.when(F.col("p_partkey") % 5 == 0, F.lit("n/a")).otherwise(F.col("p_retailprice").cast("string")).alias("Cost"))
    x = x.na.drop(subset=["Part_Ref_Group_Desc"]).withColumn("Cost", F.expr("try_cast(Cost AS double)")).na.drop(subset=["Cost"])
    return x.select("Part_Ref", "Part_Ref_Group_Desc", rnd("Cost", 2).alias("Cost"))


sql("snk_16_parts_output", f"""SELECT p_partkey AS Part_Ref, p_type AS Part_Ref_Group_Desc, {sql_rnd('p_retailprice', 2)} AS Cost FROM part WHERE p_partkey % 8 <> 0 AND p_partkey % 5 <> 0""")


@query("snk_26_upsert", stored=True)
def snk26(spark, d):
    base = read(spark, d, "documents", "doc_id", "source").withColumnRenamed("source", "label")
    upd = read(spark, d, "labels", "doc_id", "quality").filter(F.col("quality") == 1).select("doc_id", F.lit("manual").alias("label"))
    return io.upsert(base, upd, ["doc_id"])


sql("snk_26_upsert", "SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN 'manual' ELSE source END AS label FROM documents")
