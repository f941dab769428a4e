"""STM-* registered queries: the stream input is data Spark derives from the
driver tables, staged once with the number of their arrival."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from forecourt.functions.fmt import dstr, rnd, sql_rnd
from forecourt.plans.parts import _LEDGER_SQL, _daily
from forecourt.plans.registry import query
from forecourt.sources.fixtures import opening_stock
from forecourt.sources.tables import read
from forecourt.streaming import streams

ORACLE: dict[str, str] = {}


def sql(name, text):
    ORACLE[name] = text.strip()


def _name(query_name):
    return f"{query_name}_{uuid.uuid4().hex[:8]}"


@query("stm_01_ledger_stream")
def stm01(spark, d):
    """An arrival a calendar year of the movements."""
    daily = _daily(spark, d)
    first = read(spark, d, "lineitem", "l_shipdate").agg(F.min(F.to_date("l_shipdate"))).first()[0]
    x = (daily.join(opening_stock(spark, d), "part", "left").na.fill({"stock_qty": 0.0})
              .select(F.col("part").cast("long").alias("part"), "day", "qty_sold", "qty_purchased", "qty_regulated", "stock_qty",
                      F.year("day").alias("arrival")))
    name = _name("stm01")
    out = streams.ledger_stream(streams.staged(x, "arrival", ["part"], name), "arrival", first, name)
    return out.select("part", dstr("day").alias("day"), rnd("sales_evolution").alias("sales_evolution"),
                      rnd("purchases_evolution").alias("purchases_evolution"), rnd("stock_qty_al").alias("stock_qty_al"))


sql("stm_01_ledger_stream", f"""WITH {_LEDGER_SQL}
SELECT part, strftime(day, '%Y-%m-%d') AS day, {sql_rnd('sales_evolution')} AS sales_evolution, {sql_rnd('purchases_evolution')} AS purchases_evolution,
  {sql_rnd('stock_qty_al')} AS stock_qty_al FROM led WHERE (part, day) IN (SELECT (part, day) FROM daily)""")


@query("stm_02_dedupe_stream")
def stm02(spark, d):
    li = read(spark, d, "lineitem", "l_partkey", "l_shipdate", "l_quantity")
    day = F.to_date("l_shipdate").alias("day")
    old = li.filter(F.col("l_shipdate") < "2000-01-01").groupBy("l_partkey", day).agg(F.sum("l_quantity").alias("qty")).withColumn("src", F.lit("old")).withColumn("arrival", F.lit(0))
    new = li.filter(F.col("l_shipdate") >= "1999-07-01").groupBy("l_partkey", day).agg(F.sum("l_quantity").alias("qty")).withColumn("src", F.lit("new")).withColumn("arrival", F.lit(1))
    x = old.unionByName(new).withColumn("ts", F.col("day").cast("timestamp"))
    name = _name("stm02")
    out = streams.dedupe_stream(streams.staged(x, "arrival", ["l_partkey"], name), "arrival", ["l_partkey", "day"], "ts", "36500 days", name)
    return out.select("l_partkey", dstr("day").alias("day"), rnd("qty", 2).alias("qty"), "src")


sql("stm_02_dedupe_stream", f"""WITH old AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS qty, 'old' AS src FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01' GROUP BY 1, 2),
new AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS qty, 'new' AS src FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-07-01' GROUP BY 1, 2),
u AS (SELECT * FROM old UNION ALL SELECT * FROM new WHERE (l_partkey, day) NOT IN (SELECT (l_partkey, day) FROM old))
SELECT l_partkey, strftime(day, '%Y-%m-%d') AS day, {sql_rnd('qty', 2)} AS qty, src FROM u""")


@query("stm_03_daily_warning_counts")
def stm03(spark, d):
    e = read(spark, d, "events", "event_id", "ts", "event_type")
    # arrivals in time order (8-day slices), as a live stream delivers them;
    # the 1-day watermark then never has late rows to drop
    first = e.agg(F.min("ts")).scalar()
    x = e.select(F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") == "error").alias("is_warning"),
                 F.floor(F.datediff(F.col("ts"), first) / 8).cast("int").alias("arrival"))
    name = _name("stm03")
    r = streams.daily_counts_stream(streams.staged(x, "arrival", ["ts"], name), "arrival", "ts", "is_warning", name)
    return r.select(dstr("day_start").alias("day"), F.col("warnings").cast("bigint").alias("warnings"))


sql("stm_03_daily_warning_counts", "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS warnings FROM events WHERE event_type = 'error' GROUP BY 1")
