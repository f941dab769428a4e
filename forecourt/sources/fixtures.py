"""Reference-shaped views over the driver tables (FIXTURES.md section C).

Each view exists twice: as a Spark plan (``vehicle_sales(spark, d)``) and as a
SQL common-table expression (``VEHICLE_SALES_SQL``) used by the oracle text of
the registered queries, so both sides start from the same definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.functions.fmt import mean_money, sql_mean_money
from forecourt.sources.tables import LINE_KEY, read


def places(spark: SparkSession, d: str) -> DataFrame:
    """nation x region: 25 rows at every scale factor (fixed by the schema),
    so it is the one side that is always safe to broadcast."""
    r = read(spark, d, "region", "r_regionkey", "r_name")
    n = read(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey")
    return (n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
             .select("n_nationkey", F.col("n_name").alias("place"),
                     F.col("r_name").alias("place_v2")))


def vehicle_lines(spark: SparkSession, d: str) -> DataFrame:
    """One row per sold vehicle (= line): configuration (brand, type, size
    class), sale place and region, purchase / sale dates, what its values are made of.

    Join order is chosen by hand (CBO is off by default): orders are enriched
    with customer + place first (order-sized shuffle), then the line table is
    joined once on the order key and once on the part key."""
    pl = F.broadcast(places(spark, d))
    cust = (read(spark, d, "customer", "c_custkey", "c_nationkey")
            .join(pl, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "place", "place_v2"))
    orders = (read(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate")
              .join(cust, F.col("o_custkey") == F.col("c_custkey"))
              .select("o_orderkey", "o_orderdate", "place", "place_v2"))
    part = read(spark, d, "part", "p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    li = read(spark, d, "lineitem", *LINE_KEY, "l_discount", "l_shipdate")
    v = (li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
           .join(part, F.col("l_partkey") == F.col("p_partkey")))
    return v.select(
        *LINE_KEY,
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("ptype"),
        F.pmod(F.col("p_size"), F.lit(5)).cast("bigint").alias("size_class"),
        "place", "place_v2",
        F.col("o_orderdate").alias("purchase_date"),
        F.col("l_shipdate").alias("sale_date"),
        "p_retailprice", "l_discount",
    )


def sale_values(v: DataFrame) -> DataFrame:
    """Cost and margin of ``vehicle_lines``."""
    return (v.withColumn("price_total", F.col("p_retailprice") * F.col("l_quantity"))
             .withColumn("margin", F.col("l_extendedprice") * (1 - F.col("l_discount")) - F.col("p_retailprice") * F.col("l_quantity"))
             .drop("p_retailprice", "l_discount"))


def vehicle_sales(spark: SparkSession, d: str) -> DataFrame:
    """``vehicle_lines`` with cost and margin."""
    return sale_values(vehicle_lines(spark, d))


VEHICLE_SALES_SQL = """
vehicle_sales AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice,
         p.p_brand AS brand, p.p_type AS ptype, CAST(p.p_size % 5 AS BIGINT) AS size_class,
         n.n_name AS place, r.r_name AS place_v2,
         o.o_orderdate AS purchase_date, l.l_shipdate AS sale_date,
         p.p_retailprice * l.l_quantity AS price_total,
         l.l_extendedprice * (1 - l.l_discount) - p.p_retailprice * l.l_quantity AS margin
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

LINE_KEY_SQL = ", ".join(LINE_KEY)


def events_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Duration-like columns with gaps: value is null where event_id % 7 = 0;
    a second duration ``value2`` is null where event_id % 5 = 0."""
    e = read(spark, d, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    return (e.withColumn("value", F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("value")))
             .withColumn("value2", F.when(F.col("event_id") % 5 == 0, F.lit(None))
                         .otherwise(F.col("value") * 2)))


EVENTS_GAPS_SQL = """
events_gaps AS (
  SELECT event_id, ts, user_id, event_type,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value,
         CASE WHEN event_id % 5 = 0 THEN NULL ELSE (CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END) * 2 END AS value2,
         props
  FROM events
)"""


def importer_sales(spark: SparkSession, d: str) -> DataFrame:
    """Importer sales: one row per line, configuration = (brand, type),
    registration time = ship date."""
    p = read(spark, d, "part", "p_partkey", "p_brand", "p_type")
    li = read(spark, d, "lineitem", *LINE_KEY, "l_shipdate")
    return li.join(p, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")


IMPORTER_SQL = """
importer_sales AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice, l.l_shipdate, p.p_brand, p.p_type
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
)"""


def part_movements(spark: SparkSession, d: str, dealt_by: str | None = None) -> DataFrame:
    """Part sale movements with reversed copies: every returned line of a
    part key divisible by 3 gets a negated copy (copy 1), even line numbers a
    second one (copy 2: two negatives against one positive), and line 1 of
    part keys = 1 mod 3 gets an unmatched negative (copy 3).  The lines are read
    once and, with ``dealt_by``, partitioned by that column before they are copied."""
    li = read(spark, d, "lineitem", *LINE_KEY, "l_discount", "l_returnflag", "l_shipdate")
    li = li.withColumn("day", F.to_date("l_shipdate")).drop("l_shipdate")
    if dealt_by:
        li = li.repartition(dealt_by)
    returned = F.col("l_returnflag") == "R"
    r3 = returned & (F.col("l_partkey") % 3 == 0)
    copies = F.array(F.lit(0), F.when(r3, 1), F.when(r3 & (F.col("l_linenumber") % 2 == 0), 2),
                     F.when(returned & (F.col("l_partkey") % 3 == 1) & (F.col("l_linenumber") == 1), 3))
    x = li.withColumn("copy", F.explode(F.array_compact(copies)))

    def signed(c):
        return F.when(F.col("copy") == 0, c).otherwise(-c)
    price = F.col("l_extendedprice")
    return x.select(*LINE_KEY, "day", signed(F.col("l_quantity") + F.when(F.col("copy") == 3, 0.5).otherwise(0.0)).alias("qty"),
                    signed(price).alias("sale_value"), signed(price * (1 - F.col("l_discount"))).alias("cost"),
                    signed(price * F.col("l_discount")).alias("margin"), "copy")


MOVEMENTS_SQL = """
mv_base AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, CAST(l_shipdate AS DATE) AS day,
         l_quantity AS qty, l_extendedprice AS sale_value, l_extendedprice * (1 - l_discount) AS cost,
         l_extendedprice * l_discount AS margin, l_returnflag
  FROM lineitem),
movements AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, day, qty, sale_value, cost, margin, 0 AS copy FROM mv_base
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, day, -qty, -sale_value, -cost, -margin, 1
    FROM mv_base WHERE l_returnflag = 'R' AND l_partkey % 3 = 0
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, day, -qty, -sale_value, -cost, -margin, 2
    FROM mv_base WHERE l_returnflag = 'R' AND l_partkey % 3 = 0 AND l_linenumber % 2 = 0
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, day, -(qty + 0.5), -sale_value, -cost, -margin, 3
    FROM mv_base WHERE l_returnflag = 'R' AND l_partkey % 3 = 1 AND l_linenumber = 1
)"""


def odometer(spark: SparkSession, d: str) -> DataFrame:
    """Odometer visits: vehicle = user, owner = event type, visit day, work
    order = event id, mileage = floor(value / 20)."""
    e = read(spark, d, "events", "event_id", "ts", "user_id", "event_type", "value")
    return e.select(F.col("user_id").alias("vehicle"), F.col("event_type").alias("owner"),
                    F.to_date("ts").alias("day"), "event_id",
                    F.floor(F.col("value") / 20).cast("bigint").alias("kms"))


ODOMETER_SQL = """
odometer AS (
  SELECT user_id AS vehicle, event_type AS owner, CAST(ts AS DATE) AS day, event_id,
         CAST(floor(value / 20) AS BIGINT) AS kms
  FROM events
)"""


def lang_predictions(spark: SparkSession, d: str) -> DataFrame:
    """Confusion-matrix input: actual = documents.lang, predicted = a word
    rule on the text."""
    doc = read(spark, d, "documents", "doc_id", "text", "lang")
    t = F.col("text")
    pred = (F.when(t.contains(" the "), "en")
             .when(t.contains(" le ") | t.contains(" la "), "fr")
             .when(t.contains(" der ") | t.contains(" und "), "de").otherwise("es"))
    return doc.select("doc_id", F.col("lang").alias("actual"), pred.alias("predicted"))


LANG_PRED_SQL = """
lang_pred AS (
  SELECT doc_id, lang AS actual,
         CASE WHEN contains(text, ' the ') THEN 'en'
              WHEN contains(text, ' le ') OR contains(text, ' la ') THEN 'fr'
              WHEN contains(text, ' der ') OR contains(text, ' und ') THEN 'de' ELSE 'es' END AS predicted
  FROM documents
)"""


def collapse_input(spark: SparkSession, d: str) -> DataFrame:
    """Vehicle-collapse input: chassis = order, plate = line number (real
    duplicate groups), invoice date null for open lines, quantity = part key
    parity, measures from price / discount / tax / quantity."""
    li = read(spark, d, "lineitem", *LINE_KEY, "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    return li.select(
        *LINE_KEY,
        F.when(F.col("l_linestatus") == "O", F.lit(None)).otherwise(F.col("l_shipdate")).alias("invoice_date"),
        F.date_add(F.col("l_shipdate"), 3).alias("registration_date"),
        (F.col("l_partkey") % 2).cast("bigint").alias("quantity"),
        F.col("l_extendedprice").alias("measure_2"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("measure_3"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("measure_4"),
        F.when(F.col("l_returnflag") == "A", 0.0).otherwise(F.col("l_quantity")).alias("measure_5"),
        F.col("l_discount").alias("measure_13"), F.col("l_tax").alias("measure_14"),
        F.col("l_linenumber").cast("string").alias("registration_number"),
        F.concat(F.lit("C"), F.col("l_suppkey").cast("string")).alias("doc_chs"),
        F.when(F.col("l_returnflag") == "N", F.lit(None)).otherwise(F.concat(F.lit("R"), F.col("l_partkey").cast("string"))).alias("doc_rgn"))


COLLAPSE_SQL = """
collapse_input AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
         CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_shipdate END AS invoice_date,
         CAST(l_shipdate AS DATE) + 3 AS registration_date,
         CAST(l_partkey % 2 AS BIGINT) AS quantity,
         l_extendedprice AS measure_2, l_extendedprice * l_discount AS measure_3, l_extendedprice * l_tax AS measure_4,
         CASE WHEN l_returnflag = 'A' THEN 0.0 ELSE l_quantity END AS measure_5,
         l_discount AS measure_13, l_tax AS measure_14,
         CAST(l_linenumber AS VARCHAR) AS registration_number, 'C' || CAST(l_suppkey AS VARCHAR) AS doc_chs,
         CASE WHEN l_returnflag = 'N' THEN NULL ELSE 'R' || CAST(l_partkey AS VARCHAR) END AS doc_rgn
  FROM lineitem
)"""


def parts_movements(spark: SparkSession, d: str) -> DataFrame:
    """Part movements for the ledger: lines of orders with status F are
    purchases, P regulations, O sales; urgent = priority 1 or 2."""
    li = read(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")
    o = read(spark, d, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    x = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return x.select(
        F.col("l_partkey").alias("part"), F.to_date("l_shipdate").alias("day"),
        F.when(F.col("o_orderstatus") == "F", "purchase").when(F.col("o_orderstatus") == "P", "regulation")
         .otherwise("sale").alias("kind"),
        F.col("l_quantity").alias("qty"),
        (F.col("l_extendedprice") / F.col("l_quantity") * 0.7).alias("unit_cost"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("urgent"))


def opening_stock(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part", "p_partkey", "p_size")
    return p.select(F.col("p_partkey").alias("part"), (F.col("p_size") + 100).cast("double").alias("stock_qty"))


PARTS_MV_SQL = """
pmv AS (
  SELECT l.l_partkey AS part, CAST(l.l_shipdate AS DATE) AS day,
         CASE WHEN o.o_orderstatus = 'F' THEN 'purchase' WHEN o.o_orderstatus = 'P' THEN 'regulation' ELSE 'sale' END AS kind,
         l.l_quantity AS qty, l.l_extendedprice / l.l_quantity * 0.7 AS unit_cost, l.l_extendedprice / l.l_quantity AS unit_price,
         o.o_orderpriority IN ('1-URGENT', '2-HIGH') AS urgent
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
opening AS (SELECT p_partkey AS part, CAST(p_size + 100 AS DOUBLE) AS stock_qty FROM part)"""


def requests(spark: SparkSession, d: str) -> DataFrame:
    """Service-desk requests: request = document, description = its text,
    customer = doc_id mod 97, category = source, language = lang."""
    doc = read(spark, d, "documents", "doc_id", "text", "lang", "source")
    return doc.select(F.col("doc_id").alias("request_num"), F.col("text").alias("description"),
                      (F.col("doc_id") % 97).alias("customer_id"), F.col("source").alias("category"),
                      F.col("lang").alias("language"))


REQUESTS_SQL = """
requests AS (SELECT doc_id AS request_num, text AS description, doc_id % 97 AS customer_id, source AS category, lang AS language FROM documents)"""


def contracts(spark: SparkSession, d: str) -> DataFrame:
    """Fleet contracts: one per customer, start = first order date, km from
    quantities, power / weight from balance and order count, coverage texts
    from segment and key, three nullable targets (returned / accepted /
    returned-and-final line value)."""
    li = read(spark, d, "lineitem", "l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus")
    o = read(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = read(spark, d, "customer", "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    o = o.join(c, F.col("o_custkey") == F.col("c_custkey"))  # lines are joined once
    x = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    g = x.groupBy("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment").agg(
        F.min("o_orderdate").alias("contract_start_date"),
        (F.sum("l_quantity") * 1000).alias("contract_km"),
        F.count_distinct("l_orderkey").alias("n_orders"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice"))).alias("target"),
        F.sum(F.when(F.col("l_returnflag") == "A", F.col("l_extendedprice"))).alias("target_QIV"),
        F.sum(F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), F.col("l_extendedprice"))).alias("target_DP"),
        mean_money("o_totalprice", 4).alias("mean_repair_value_cust_full"))
    k = F.col("c_custkey")
    return g.select(
        k.alias("contract_customer"), F.col("c_mktsegment").alias("customer_group"),
        F.col("c_nationkey").cast("string").alias("make"),
        F.when(k % 3 == 0, "Diesel").when(k % 3 == 1, "Gasolina").otherwise(F.lit(None)).alias("fuel"),
        "contract_start_date", "contract_km",
        (F.abs(F.col("c_acctbal")) + 50).alias("power_kw"), (F.col("n_orders") * 100 + 800).cast("double").alias("weight_empty"),
        F.when(k % 4 == 0, F.concat(F.lit("€50.000.000 "), F.col("c_mktsegment"))).when(k % 4 == 1, F.lit("€10.000.000")).alias("LL"),
        F.when(k % 5 != 0, F.concat(((k % 5) * 10).cast("string"), F.lit("% franquia "), F.col("c_mktsegment"))).alias("AR"),
        F.when(k % 3 == 0, F.lit("Até €1.000/Ano extra")).when(k % 3 == 1, F.lit("Sem")).alias("FI"),
        F.when(F.col("n_orders") > 10, F.col("mean_repair_value_cust_full")).alias("mean_repair_value_cust_full"),
        "target", "target_QIV", "target_DP")


CONTRACTS_SQL = """
contracts AS (
  SELECT c_custkey AS contract_customer, c_mktsegment AS customer_group, CAST(c_nationkey AS VARCHAR) AS make,
    CASE WHEN c_custkey % 3 = 0 THEN 'Diesel' WHEN c_custkey % 3 = 1 THEN 'Gasolina' END AS fuel,
    min(o_orderdate) AS contract_start_date, sum(l_quantity) * 1000 AS contract_km,
    abs(c_acctbal) + 50 AS power_kw, CAST(count(DISTINCT l_orderkey) * 100 + 800 AS DOUBLE) AS weight_empty,
    CASE WHEN c_custkey % 4 = 0 THEN '€50.000.000 ' || c_mktsegment WHEN c_custkey % 4 = 1 THEN '€10.000.000' END AS LL,
    CASE WHEN c_custkey % 5 <> 0 THEN CAST((c_custkey % 5) * 10 AS VARCHAR) || '% franquia ' || c_mktsegment END AS AR,
    CASE WHEN c_custkey % 3 = 0 THEN 'Até €1.000/Ano extra' WHEN c_custkey % 3 = 1 THEN 'Sem' END AS FI,
    CASE WHEN count(DISTINCT l_orderkey) > 10 THEN {mean_repair} END AS mean_repair_value_cust_full,
    sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS target,
    sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END) AS target_QIV,
    sum(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN l_extendedprice END) AS target_DP
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  GROUP BY c_custkey, c_nationkey, c_acctbal, c_mktsegment
)""".replace("{mean_repair}", sql_mean_money("o_totalprice", 4))
