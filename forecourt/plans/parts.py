"""After-sales parts: stock ledger, part metrics, part type (JOB-04 pieces)."""

from __future__ import annotations

from pyspark.sql import functions as F

from forecourt.functions.fmt import big, dstr, rnd, sql_rnd
from forecourt.operators import ledger
from forecourt.plans.registry import query
from forecourt.sources.fixtures import PARTS_MV_SQL, opening_stock, parts_movements
from forecourt.sources.tables import read

ORACLE: dict[str, str] = {}
DTS_GOAL = 30
# Fixed fixture value: words that mark an oil-type part description.
OIL_WORDS = ["ring", "seal"]


def sql(name, text):
    ORACLE[name] = text.strip()


AVG_COLS = ["cost_sale_avg", "pvp_avg", "cost_purchase_avg", "cost_reg_avg"]


def _daily(spark, d):
    # daily averages are normalised to 10 decimals: their last bits depend on
    # the summation order (partitioning), and products built on them must not
    daily = ledger.daily_movements(parts_movements(spark, d), "part", "day", "kind", "qty", "unit_cost",
                                   "unit_price", F.col("urgent"))
    return daily.withColumns({c: rnd(c, 10) for c in AVG_COLS})


def period(spark, d):
    """First and last calendar day of the movements, as scalar subqueries."""
    day = read(spark, d, "lineitem", "l_shipdate").select(F.to_date("l_shipdate").alias("day"))
    return day.agg(F.min("day")).scalar(), day.agg(F.max("day")).scalar()


def the_ledger(spark, d):
    return ledger.stock_ledger(_daily(spark, d), opening_stock(spark, d), "part", *period(spark, d))


LEDGER_COLS = ["qty_sold", "cost_sale_avg", "pvp_avg", "qty_purchased", "qty_purchased_urgent",
               "qty_purchased_non_urgent", "cost_purchase_avg", "qty_regulated", "cost_reg_avg", "stock_qty",
               "sales_evolution", "purchases_evolution", "purchases_urgent_evolution",
               "purchases_non_urgent_evolution", "regulated_evolution", "stock_qty_al", "stock_end", "offset"]


@query("agg_35_stock_ledger")
def agg35(spark, d):
    x = the_ledger(spark, d)
    return x.select("part", dstr("day").alias("day"), dstr("valid_to").alias("valid_to"), *[rnd(c).alias(c) for c in LEDGER_COLS],
                    "stock_evolution_correct_flag")


# The twin lists every calendar day of every part and sums over all of them.
_LEDGER_SQL = f"""{PARTS_MV_SQL.strip()},
daily AS (SELECT part, day,
  sum(CASE WHEN kind = 'sale' THEN qty ELSE 0 END) AS qty_sold, {sql_rnd("avg(CASE WHEN kind = 'sale' THEN unit_cost END)", 10)} AS cost_sale_avg,
  {sql_rnd("avg(CASE WHEN kind = 'sale' THEN unit_price END)", 10)} AS pvp_avg, sum(CASE WHEN kind = 'purchase' THEN qty ELSE 0 END) AS qty_purchased,
  sum(CASE WHEN kind = 'purchase' AND urgent THEN qty ELSE 0 END) AS qty_purchased_urgent,
  sum(CASE WHEN kind = 'purchase' AND NOT urgent THEN qty ELSE 0 END) AS qty_purchased_non_urgent,
  {sql_rnd("avg(CASE WHEN kind = 'purchase' THEN unit_cost END)", 10)} AS cost_purchase_avg, sum(CASE WHEN kind = 'regulation' THEN qty ELSE 0 END) AS qty_regulated,
  {sql_rnd("sum(CASE WHEN kind = 'regulation' THEN unit_cost * qty END)", 10)} AS cost_reg_avg
  FROM pmv GROUP BY part, day),
period AS (SELECT min(CAST(l_shipdate AS DATE)) AS d0, max(CAST(l_shipdate AS DATE)) AS d1,
  CAST(max(CAST(l_shipdate AS DATE)) + INTERVAL 1 DAY AS DATE) AS cur FROM lineitem),
grid AS (SELECT part, CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS day, d0 FROM (SELECT DISTINCT part FROM daily), period),
x AS (SELECT g.part, g.day, g.day > g.d0 AS later, i.part IS NOT NULL OR g.day = g.d0 AS moved,
  coalesce(i.qty_sold, 0.0) AS qty_sold, coalesce(i.cost_sale_avg, 0.0) AS cost_sale_avg, coalesce(i.pvp_avg, 0.0) AS pvp_avg,
  coalesce(i.qty_purchased, 0.0) AS qty_purchased, coalesce(i.qty_purchased_urgent, 0.0) AS qty_purchased_urgent,
  coalesce(i.qty_purchased_non_urgent, 0.0) AS qty_purchased_non_urgent, coalesce(i.cost_purchase_avg, 0.0) AS cost_purchase_avg,
  coalesce(i.qty_regulated, 0.0) AS qty_regulated, coalesce(i.cost_reg_avg, 0.0) AS cost_reg_avg, coalesce(o.stock_qty, 0.0) AS stock_qty
  FROM grid g LEFT JOIN daily i USING (part, day) LEFT JOIN opening o USING (part)),
e AS (SELECT *, {', '.join(f"sum(CASE WHEN later THEN {src} ELSE 0.0 END) OVER w AS {out}" for out, src in ledger.EVOLUTIONS.items())}
  FROM x WINDOW w AS (PARTITION BY part ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
s AS (SELECT *, stock_qty - sales_evolution + purchases_evolution - regulated_evolution AS stock_qty_al FROM e),
t AS (SELECT part, sum(qty_purchased - qty_sold - qty_regulated) AS net_all, arg_max(stock_qty_al, day) AS al_end FROM s GROUP BY part),
led AS (SELECT s.*, stock_qty + net_all AS stock_end, stock_qty + net_all - al_end AS "offset",
  CAST(stock_qty + net_all - al_end = 0 AS BIGINT) AS stock_evolution_correct_flag FROM s JOIN t USING (part)),
sparse AS (SELECT *, coalesce(lead(day) OVER (PARTITION BY part ORDER BY day) - 1, (SELECT d1 FROM period)) AS valid_to FROM led WHERE moved)"""

sql("agg_35_stock_ledger", f"""WITH {_LEDGER_SQL}
SELECT part, strftime(day, '%Y-%m-%d') AS day, strftime(valid_to, '%Y-%m-%d') AS valid_to,
  {', '.join(f'{sql_rnd(chr(34) + c + chr(34))} AS "{c}"' for c in LEDGER_COLS)}, stock_evolution_correct_flag FROM sparse""")


@query("win_11_dense_calendar")
def win11(spark, d):
    """Every calendar day of every part, a month to a row: the day's sold
    quantity and the stock photo at its end."""
    x = the_ledger(spark, d).select("part", "day", "valid_to", *[F.col(c).cast("long").alias(c) for c in ("qty_sold", "stock_qty_al")])
    months = ledger.list_months(x, ["part"], {"qty_sold": F.lit(0).cast("long")}, ["stock_qty_al"])
    return months.select("part", F.date_format("month", "yyyy-MM").alias("month"), F.col("n_days").cast("long").alias("n_days"),
                         *[F.array_join(F.col(c).cast("array<string>"), " ").alias(c) for c in ("qty_sold", "stock_qty_al")])


sql("win_11_dense_calendar", f"""WITH {_LEDGER_SQL} SELECT part, strftime(day, '%Y-%m') AS month, count(*) AS n_days,
  string_agg(CAST(CAST(qty_sold AS BIGINT) AS VARCHAR), ' ' ORDER BY day) AS qty_sold,
  string_agg(CAST(CAST(stock_qty_al AS BIGINT) AS VARCHAR), ' ' ORDER BY day) AS stock_qty_al FROM led GROUP BY part, strftime(day, '%Y-%m')""")


@query("win_13_cumulative_evolutions")
def win13(spark, d):
    x = the_ledger(spark, d)
    return x.select("part", dstr("day").alias("day"), dstr("valid_to").alias("valid_to"), rnd("sales_evolution").alias("sales_evolution"),
                    rnd("purchases_evolution").alias("purchases_evolution"), rnd("stock_qty_al").alias("stock_qty_al"))


sql("win_13_cumulative_evolutions", f"""WITH {_LEDGER_SQL} SELECT part, strftime(day, '%Y-%m-%d') AS day, strftime(valid_to, '%Y-%m-%d') AS valid_to,
  {sql_rnd('sales_evolution')} AS sales_evolution, {sql_rnd('purchases_evolution')} AS purchases_evolution, {sql_rnd('stock_qty_al')} AS stock_qty_al FROM sparse""")

METRIC_COLS = ["cost", "pvp", "margin", "last_stock", "last_stock_value", "last_year_sales", "last_year_sales_mean",
               "last_year_cogs", "dii_year", "dii_year_weekdays", "dii_year_weekdays_v2", "days_to_sell_1_part",
               "dts_total_qty_sold", "dts_min_total_qty_sold", "dts_max_total_qty_sold", "dts_ratio_mean", "dts_ratio_median"]


def metrics(spark, d):
    return ledger.part_metrics(the_ledger(spark, d), "part", *period(spark, d), DTS_GOAL)


@query("agg_08_part_metrics")
def agg08(spark, d):
    m = metrics(spark, d)
    return m.select("part", dstr("last_sale_date").alias("last_sale_date"), *[rnd(c).alias(c) for c in METRIC_COLS])


_YEAR_AGO = "(SELECT cur - INTERVAL 1 YEAR FROM period)"
_BDAYS = """(SELECT count(*) FROM (SELECT unnest(generate_series(cur - INTERVAL 1 YEAR, cur - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS x FROM period) WHERE isodow(x) <= 5)"""
_METRICS_SQL = f"""{_LEDGER_SQL},
ds AS (SELECT part, max(day) - {DTS_GOAL - 1} AS dts_start FROM led GROUP BY part),
s2 AS (SELECT led.*, ds.dts_start FROM led JOIN ds USING (part) WHERE isodow(day) <= 5),
gp AS (SELECT part, (day - lag(day) OVER (PARTITION BY part ORDER BY day)) / qty_sold AS gap FROM s2 WHERE qty_sold > 0),
gs AS (SELECT part, avg(gap) AS dts_ratio_mean, quantile_cont(gap, 0.5) AS dts_ratio_median FROM gp GROUP BY part),
a AS (SELECT part, sum(qty_sold) AS tot, sum(CAST(qty_sold > 0 AS INT)) AS sale_days,
  max(CASE WHEN qty_sold > 0 THEN day END) AS last_sale_date,
  arg_max(cost_sale_avg, CASE WHEN qty_sold > 0 THEN day END) AS cost, arg_max(pvp_avg, CASE WHEN qty_sold > 0 THEN day END) AS pvp,
  arg_max(stock_qty_al, day) AS last_stock,
  sum(CASE WHEN day >= dts_start THEN qty_sold END) AS dts_total_qty_sold,
  min(CASE WHEN day >= dts_start AND qty_sold >= 0 THEN qty_sold END) AS dts_min_total_qty_sold,
  max(CASE WHEN day >= dts_start THEN qty_sold END) AS dts_max_total_qty_sold,
  sum(CASE WHEN day >= {_YEAR_AGO} THEN qty_sold END) AS last_year_sales,
  avg(CASE WHEN day >= {_YEAR_AGO} THEN qty_sold END) AS last_year_sales_mean
  FROM s2 GROUP BY part),
m AS (SELECT part, last_sale_date, cost, pvp, pvp - cost AS margin, last_stock, last_stock * cost AS last_stock_value, last_year_sales, last_year_sales_mean,
  last_year_sales * cost AS last_year_cogs, (last_stock * cost) / NULLIF(last_year_sales * cost, 0) * 365 AS dii_year,
  last_stock / NULLIF(last_year_sales_mean, 0) AS dii_year_weekdays, last_year_sales / NULLIF({_BDAYS}, 0) AS dii_year_weekdays_v2,
  1.0 / NULLIF(last_year_sales_mean, 0) AS days_to_sell_1_part, dts_total_qty_sold, dts_min_total_qty_sold, dts_max_total_qty_sold
  FROM a WHERE tot >= 0 AND sale_days > 1 AND last_sale_date >= {_YEAR_AGO} AND last_stock >= 0 AND last_year_sales <> 0),
mm AS (SELECT m.*, gs.dts_ratio_mean, gs.dts_ratio_median FROM m LEFT JOIN gs USING (part))"""

sql("agg_08_part_metrics", f"""WITH {_METRICS_SQL}
SELECT part, strftime(last_sale_date, '%Y-%m-%d') AS last_sale_date, {', '.join(f'{sql_rnd(c)} AS {c}' for c in METRIC_COLS)} FROM mm""")


@query("win_14_sale_gap_ratios")
def win14(spark, d):
    m = metrics(spark, d)
    return m.select("part", rnd("dts_ratio_mean").alias("dts_ratio_mean"), rnd("dts_ratio_median").alias("dts_ratio_median"))


sql("win_14_sale_gap_ratios", f"WITH {_METRICS_SQL} SELECT part, {sql_rnd('dts_ratio_mean')} AS dts_ratio_mean, {sql_rnd('dts_ratio_median')} AS dts_ratio_median FROM mm")


def _ta_input(spark, d):
    li = read(spark, d, "lineitem", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus")
    p = read(spark, d, "part", "p_partkey", "p_name")
    x = li.join(p, F.col("l_partkey") == F.col("p_partkey"))
    grp = F.when(F.col("l_linestatus") == "O", F.col("l_returnflag")).otherwise(
        F.concat(F.col("l_returnflag"), F.col("l_linenumber").cast("string")))
    return x.select(F.col("l_partkey").alias("part"), grp.alias("product_group"), F.col("p_name").alias("part_desc"))


@query("agg_07_part_type")
def agg07(spark, d):
    return ledger.part_type(_ta_input(spark, d), "part", "product_group", "part_desc", OIL_WORDS)


sql("agg_07_part_type", f"""WITH x AS (SELECT l.l_partkey AS part, CASE WHEN l.l_linestatus = 'O' THEN l.l_returnflag ELSE l.l_returnflag || CAST(l.l_linenumber AS VARCHAR) END AS g,
  p.p_name AS dsc FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
mg AS (SELECT part, g FROM (SELECT part, g, row_number() OVER (PARTITION BY part ORDER BY count(*) DESC, g) AS rn FROM x WHERE g IS NOT NULL GROUP BY part, g) WHERE rn = 1),
md AS (SELECT part, dsc FROM (SELECT part, dsc, row_number() OVER (PARTITION BY part ORDER BY count(*) DESC, dsc) AS rn FROM x WHERE g IS NOT NULL GROUP BY part, dsc) WHERE rn = 1)
SELECT part, CASE WHEN length(g) >= 2 THEN substr(g, 2, 1) WHEN {' OR '.join(f"contains(lower(dsc), '{w}')" for w in OIL_WORDS)} THEN '1' ELSE 'NO_TA' END AS ta
FROM mg JOIN md USING (part)""")


@query("dat_03_business_days")
def dat03(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_orderdate")
    start = F.to_date("o_orderdate")
    end = F.date_add(start, (F.col("o_orderkey") % 40).cast("int"))
    return o.select("o_orderkey", big(ledger.business_days(start, end)).alias("business_days"))


sql("dat_03_business_days", """SELECT o_orderkey, CAST((SELECT count(*) FROM (SELECT unnest(generate_series(CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INT) - 1, INTERVAL 1 DAY)) AS x) WHERE isodow(x) <= 5) AS BIGINT) AS business_days FROM orders""")
