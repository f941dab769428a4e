"""OPT-* allocation queries and SRT-* top-k helpers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from forecourt.functions.fmt import big, dstr, rnd, sql_rnd
from forecourt.operators import alloc, windows
from forecourt.plans.registry import query
from forecourt.sources.tables import read

ORACLE: dict[str, str] = {}
DTS_GOAL, MAX_PARTS, GOAL_VALUE = 30.0, 150, 20000.0


def sql(name, text):
    ORACLE[name] = text.strip()


def parts_to_allocate(spark, d):
    li = read(spark, d, "lineitem", "l_partkey", "l_quantity", "l_extendedprice")
    p = read(spark, d, "part", "p_partkey", "p_type")
    g = li.groupBy("l_partkey").agg(F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("pvp"),
                                    F.count(F.lit(1)).alias("n_lines"))
    x = g.join(p, F.col("l_partkey") == F.col("p_partkey"))
    return x.select(F.col("p_partkey").alias("part"), F.concat(F.lit("P"), (F.col("p_partkey") % 3).cast("string")).alias("pse_code"),
                    F.col("p_type").alias("parts_group"), (F.col("pvp") * 0.7).alias("cost"), "pvp",
                    (F.lit(365.0) / F.col("n_lines")).alias("days_to_sell"))


PARTS_SQL = """pa AS (SELECT p.p_partkey AS part, 'P' || CAST(p.p_partkey % 3 AS VARCHAR) AS pse_code, p.p_type AS parts_group,
  avg(l.l_extendedprice / l.l_quantity) * 0.7 AS cost, avg(l.l_extendedprice / l.l_quantity) AS pvp, 365.0 / count(*) AS days_to_sell
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY p.p_partkey, p.p_type)"""


def allocated_parts(spark, d):
    return alloc.parts_allocation(parts_to_allocate(spark, d), ["pse_code", "parts_group"], ["part"], "cost",
                                  "days_to_sell", DTS_GOAL, max_parts=F.lit(MAX_PARTS))


@query("opt_01_parts_allocation")
def opt01(spark, d):
    a = allocated_parts(spark, d)
    return a.select("pse_code", "parts_group", "part", "quantity")


_ALLOC_SQL = f"""{PARTS_SQL},
f AS (SELECT *, CAST(CASE WHEN days_to_sell <= 0 THEN 100 ELSE least(100, floor({DTS_GOAL} / days_to_sell)) END AS BIGINT) AS cap FROM pa WHERE days_to_sell <= {DTS_GOAL}),
s AS (SELECT *, coalesce(sum(cap) OVER (PARTITION BY pse_code, parts_group ORDER BY cost DESC, part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM f WHERE cost > 0 AND cap > 0),
al AS (SELECT pse_code, parts_group, part, cost, pvp, days_to_sell, CAST(greatest(0, least(cap, {MAX_PARTS} - before)) AS BIGINT) AS quantity FROM s
  UNION ALL SELECT pse_code, parts_group, part, cost, pvp, days_to_sell, 0 FROM f WHERE NOT (cost > 0 AND cap > 0))"""

sql("opt_01_parts_allocation", f"WITH {_ALLOC_SQL} SELECT pse_code, parts_group, part, quantity FROM al")


@query("opt_03_solution_table")
def opt03(spark, d):
    a = allocated_parts(spark, d).filter(F.col("quantity") > 0)
    tot = a.groupBy("pse_code", "parts_group").agg(F.sum(F.col("quantity") * F.col("cost")).alias("_v"))
    a = a.join(tot, ["pse_code", "parts_group"])
    return a.select("pse_code", "parts_group", "part", "quantity", rnd(F.col("days_to_sell") * F.col("quantity")).alias("dts_x_qty"),
                    (F.col("_v") >= GOAL_VALUE).cast("bigint").alias("above_goal_flag"))


sql("opt_03_solution_table", f"""WITH {_ALLOC_SQL},
pos AS (SELECT * FROM al WHERE quantity > 0), tot AS (SELECT pse_code, parts_group, sum(quantity * cost) AS v FROM pos GROUP BY ALL)
SELECT pse_code, parts_group, part, quantity, {sql_rnd('days_to_sell * quantity')} AS dts_x_qty, CAST(v >= {GOAL_VALUE} AS BIGINT) AS above_goal_flag
FROM pos JOIN tot USING (pse_code, parts_group)""")


@query("opt_04_goal_attainment")
def opt04(spark, d):
    a = allocated_parts(spark, d).filter(F.col("quantity") > 0)
    goals = (parts_to_allocate(spark, d).groupBy("pse_code", "parts_group")
             .agg((F.sum("cost") * 2).alias("goal")))
    r = a.groupBy("pse_code", "parts_group").agg(
        F.sum(F.col("quantity") * F.col("cost")).alias("value"), F.sum("quantity").alias("total_quantity"),
        F.count_distinct("part").alias("distinct_parts"), F.min("pvp").alias("pvp_min"), F.max("pvp").alias("pvp_max"))
    r = r.join(goals, ["pse_code", "parts_group"], "left")
    return r.select("pse_code", "parts_group", rnd(F.col("value") / F.col("goal") * 100, 4).alias("goal_pct"),
                    "total_quantity", "distinct_parts", rnd("pvp_min").alias("pvp_min"), rnd("pvp_max").alias("pvp_max"))


sql("opt_04_goal_attainment", f"""WITH {_ALLOC_SQL},
g AS (SELECT pse_code, parts_group, sum(cost) * 2 AS goal FROM pa GROUP BY ALL),
r AS (SELECT pse_code, parts_group, sum(quantity * cost) AS value, sum(quantity) AS total_quantity, count(DISTINCT part) AS distinct_parts,
  min(pvp) AS pvp_min, max(pvp) AS pvp_max FROM al WHERE quantity > 0 GROUP BY ALL)
SELECT pse_code, parts_group, {sql_rnd('value / goal * 100')} AS goal_pct, CAST(total_quantity AS BIGINT) AS total_quantity, distinct_parts,
  {sql_rnd('pvp_min')} AS pvp_min, {sql_rnd('pvp_max')} AS pvp_max FROM r LEFT JOIN g USING (pse_code, parts_group)""")


def configurations(spark, d):
    li = read(spark, d, "lineitem", "l_partkey", "l_quantity", "l_discount", "l_extendedprice")
    p = read(spark, d, "part", "p_partkey", "p_brand", "p_type", "p_size")
    x = li.join(p, F.col("l_partkey") == F.col("p_partkey"))
    g = x.groupBy("p_type", "p_brand").agg(F.avg(F.col("l_extendedprice") * (0.06 - F.col("l_discount"))).alias("score"),
                                           F.count(F.lit(1)).alias("n"))
    return g.withColumn("lower_bound", F.when(F.col("n") % 10 == 0, F.lit(2)).otherwise(F.lit(0)))


CONF_SQL = """cf AS (SELECT p.p_type, p.p_brand, avg(l.l_extendedprice * (0.06 - l.l_discount)) AS score, count(*) AS n,
  CASE WHEN count(*) % 10 = 0 THEN 2 ELSE 0 END AS lower_bound FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY p.p_type, p.p_brand)"""
ORDER_SIZE = 150


@query("opt_02_vehicle_allocation")
def opt02(spark, d):
    c = configurations(spark, d)
    a = alloc.vehicles_allocation(c, ["p_type"], ["p_brand"], "score", F.lit(ORDER_SIZE), lower="lower_bound")
    return a.select("p_type", "p_brand", "quantity", "feasible")


_VEH_SQL = f"""{CONF_SQL},
u AS (SELECT p_type, sum(lower_bound) AS lbsum FROM cf GROUP BY p_type),
x AS (SELECT cf.*, u.lbsum, 100 - lower_bound AS room, {ORDER_SIZE} - u.lbsum AS lft FROM cf JOIN u USING (p_type)),
s AS (SELECT *, coalesce(sum(room) OVER (PARTITION BY p_type ORDER BY score DESC, p_brand ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM x WHERE score > 0 AND room > 0),
va AS (SELECT p_type, p_brand, CAST(lower_bound + greatest(0, least(room, greatest(lft, 0) - before)) AS BIGINT) AS quantity, CAST(lft >= 0 AS BIGINT) AS feasible, score FROM s
  UNION ALL SELECT p_type, p_brand, CAST(lower_bound AS BIGINT), CAST(lft >= 0 AS BIGINT), score FROM x WHERE NOT (score > 0 AND room > 0))"""

sql("opt_02_vehicle_allocation", f"WITH {_VEH_SQL} SELECT p_type, p_brand, quantity, feasible FROM va")

MIN_CONFIGS = 8


@query("srt_04_complement_to_minimum")
def srt04(spark, d):
    a = alloc.vehicles_allocation(configurations(spark, d), ["p_type"], ["p_brand"], "score", F.lit(ORDER_SIZE), lower="lower_bound")
    chosen = a.groupBy("p_type").agg(F.sum((F.col("quantity") > 0).cast("int")).alias("_sel"))
    x = a.join(chosen, "p_type")
    w = Window.partitionBy("p_type").orderBy(F.desc("score"), "p_brand")
    zero = x.filter(F.col("quantity") == 0).withColumn("_r", F.row_number().over(w))
    add = zero.filter(F.col("_r") <= F.lit(MIN_CONFIGS) - F.col("_sel")).select("p_type", "p_brand")
    keep = x.filter(F.col("quantity") > 0).select("p_type", "p_brand")
    return keep.unionByName(add)


sql("srt_04_complement_to_minimum", f"""WITH {_VEH_SQL},
ch AS (SELECT p_type, sum(CAST(quantity > 0 AS INT)) AS sel FROM va GROUP BY p_type),
z AS (SELECT va.*, ch.sel, row_number() OVER (PARTITION BY va.p_type ORDER BY score DESC, p_brand) AS r FROM va JOIN ch USING (p_type) WHERE quantity = 0)
SELECT p_type, p_brand FROM va WHERE quantity > 0 UNION ALL SELECT p_type, p_brand FROM z WHERE r <= {MIN_CONFIGS} - sel""")


@query("srt_03_top_values")
def srt03(spark, d):
    p = read(spark, d, "part", "p_name")
    c = p.groupBy("p_name").agg(F.count(F.lit(1)).alias("cnt"))
    w = Window.orderBy(F.desc("cnt"), "p_name")
    return c.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= 20).select("p_name", "cnt", big("rank").alias("rank"))


sql("srt_03_top_values", """SELECT p_name, cnt, CAST(rank AS BIGINT) AS rank FROM (SELECT p_name, count(*) AS cnt, row_number() OVER (ORDER BY count(*) DESC, p_name) AS rank
FROM part GROUP BY p_name) WHERE rank <= 20""")

N_VALUES = 3


@query("srt_05_parameter_positions")
def srt05(spark, d):
    c = configurations(spark, d)
    w1 = Window.partitionBy("p_type").orderBy(F.desc("score"), "p_brand")
    best = c.withColumn("_r1", F.row_number().over(w1)).filter("_r1 = 1")
    w2 = Window.orderBy(F.desc("score"), "p_type")
    best = best.withColumn("_r2", F.row_number().over(w2)).filter(F.col("_r2") <= N_VALUES).select("p_type", "p_brand", F.lit(1).alias("_f"))
    return c.join(best, ["p_type", "p_brand"], "left").select("p_type", "p_brand", F.coalesce("_f", F.lit(0)).cast("bigint").alias("best_of_value"))


sql("srt_05_parameter_positions", f"""WITH {CONF_SQL},
b1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY score DESC, p_brand) AS r1 FROM cf) WHERE r1 = 1),
b2 AS (SELECT p_type, p_brand FROM (SELECT *, row_number() OVER (ORDER BY score DESC, p_type) AS r2 FROM b1) WHERE r2 <= {N_VALUES})
SELECT cf.p_type, cf.p_brand, CAST(b2.p_brand IS NOT NULL AS BIGINT) AS best_of_value FROM cf LEFT JOIN b2 USING (p_type, p_brand)""")


@query("srt_07_latest_rows")
def srt07(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_orderdate")
    # the top-k IS the feature here (latest five records); Spark plans it as
    # a per-partition top-k merged once (TakeOrderedAndProject).
    return o.orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(5).select("o_orderkey", dstr("o_orderdate").alias("o_orderdate"))


sql("srt_07_latest_rows", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 5")
