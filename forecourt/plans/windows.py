"""WIN-* / SRT-* registered queries (and AGG-02 / AGG-25 which sit on the
same fixtures)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from forecourt.functions.fmt import big, dstr, rnd, sql_rnd
from forecourt.operators import clean, windows
from forecourt.plans.registry import query
from forecourt.sources.fixtures import (EVENTS_GAPS_SQL, IMPORTER_SQL, MOVEMENTS_SQL, ODOMETER_SQL,
                                        events_gaps, importer_sales, odometer, part_movements)
from forecourt.sources.tables import LINE_KEY, read

LK = ", ".join(LINE_KEY)
ORACLE: dict[str, str] = {}


def sql(name, text):
    ORACLE[name] = text.strip()


# ------------------------------------------------------------------ WIN-03

ICFG = ["p_brand", "p_type"]


@query("win_03_month_windows")
def win03(spark, d):
    s = importer_sales(spark, d)
    out = windows.month_window_counts(s, ICFG, "l_shipdate", ["l_shipdate", *LINE_KEY],
                                      chunk=F.trunc("l_shipdate", "month"))
    return out.drop("l_shipdate")


def _win03_sql():
    m = ",\n  ".join(
        f"CAST(count(*) FILTER (WHERE b.l_shipdate > a.l_shipdate - INTERVAL {k} MONTH AND b.l_shipdate < a.l_shipdate - INTERVAL {k - 1} MONTH) AS BIGINT) AS m{k}"
        for k in range(1, 7))
    c = ",\n  ".join(
        f"CAST(count(*) FILTER (WHERE b.l_shipdate > a.l_shipdate - INTERVAL {k} MONTH) AS BIGINT) AS c{k}" for k in range(1, 7))
    sel_m = ", ".join(f'CASE WHEN n > 1 THEN m{k} ELSE 0 END AS "sales_month-{k}"' for k in range(1, 7))
    sel_c = ", ".join(f'CASE WHEN n > 1 THEN c{k} ELSE 0 END AS "sales_month-{k}_cum"' for k in range(1, 7))
    la = ", ".join(f"a.{c}" for c in LINE_KEY)
    return f"""WITH {IMPORTER_SQL.strip()},
pairs AS (
  SELECT {la}, a.p_brand, a.p_type, a.l_shipdate, count(*) AS n,
  {m},
  {c}
  FROM importer_sales a JOIN importer_sales b ON a.p_brand = b.p_brand AND a.p_type = b.p_type
  GROUP BY {la}, a.p_brand, a.p_type, a.l_shipdate),
r AS (SELECT *, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY l_shipdate, {LK}) AS rn FROM pairs)
SELECT {LK}, p_brand, p_type,
  CAST(CASE WHEN n > 1 AND rn > 1 THEN 1 ELSE 0 END AS BIGINT) AS prev_sales_check,
  CAST(CASE WHEN n > 1 THEN rn - 1 ELSE 0 END AS BIGINT) AS number_prev_sales,
  {sel_m}, {sel_c}
FROM r"""


sql("win_03_month_windows", _win03_sql())

# ------------------------------------------------------------ WIN-10 / AGG-02

MV_OUT = [*LINE_KEY, "copy"]


@query("win_10_negative_netting")
def win10(spark, d):
    mv = part_movements(spark, d)
    out = windows.net_negative_movements(mv, "l_orderkey", "day", "qty", "sale_value", "cost", "margin",
                                         tie_cols=[*LINE_KEY, "copy"])
    return out.select(*MV_OUT, rnd("qty").alias("qty"), rnd("sale_value").alias("sale_value"))


_NET_SQL = f"""negs AS (SELECT l_orderkey AS k0, day AS k1, -qty AS k2, -sale_value AS k3, -cost AS k4, -margin AS k5, count(*) AS nneg
  FROM movements WHERE qty < 0 GROUP BY ALL),
t AS (SELECT p.*, n.nneg, row_number() OVER (PARTITION BY p.l_orderkey, p.day, p.qty, p.sale_value, p.cost, p.margin
        ORDER BY {LK}, copy) AS rn
  FROM (SELECT * FROM movements WHERE qty >= 0) p
  LEFT JOIN negs n ON p.l_orderkey = n.k0 AND p.day = n.k1 AND p.qty = n.k2 AND p.sale_value = n.k3 AND p.cost = n.k4 AND p.margin = n.k5),
netted AS (SELECT * FROM t WHERE nneg IS NULL OR rn > nneg)"""

sql("win_10_negative_netting", f"""WITH {MOVEMENTS_SQL.strip()},
{_NET_SQL}
SELECT {LK}, copy, {sql_rnd('qty')} AS qty, {sql_rnd('sale_value')} AS sale_value FROM netted""")


@query("win_10_purchase_netting")
def win10p(spark, d):
    mv = part_movements(spark, d).withColumnRenamed("l_partkey", "part")
    out = windows.net_negative_movements(mv, "l_orderkey", "day", "qty", "part", "cost", "margin",
                                         tie_cols=["l_linenumber", "part", "l_suppkey", "l_quantity", "l_extendedprice", "copy"],
                                         mode="purchases")
    return out.select("l_orderkey", "l_linenumber", F.col("part").alias("l_partkey"), "l_suppkey", "l_quantity",
                      "l_extendedprice", "copy", rnd("qty").alias("qty"))


sql("win_10_purchase_netting", f"""WITH {MOVEMENTS_SQL.strip()},
negs AS (SELECT l_orderkey AS k0, abs(qty) AS k2, abs(cost) AS k4, l_partkey AS k3, count(*) AS nneg FROM movements WHERE qty < 0 GROUP BY ALL),
t AS (SELECT p.*, n.nneg, row_number() OVER (PARTITION BY p.l_orderkey, p.qty, p.cost, p.l_partkey
        ORDER BY p.day DESC, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, copy) AS rn
  FROM (SELECT * FROM movements WHERE qty >= 0) p
  LEFT JOIN negs n ON p.l_orderkey = n.k0 AND p.qty = n.k2 AND p.cost = n.k4 AND p.l_partkey = n.k3)
SELECT {LK}, copy, {sql_rnd('qty')} AS qty FROM t WHERE nneg IS NULL OR rn > 1""")


@query("agg_02_parts_sales_preparation")
def agg02(spark, d):
    """Rows are shuffled by order (netting and order date), by part and week (sums of a day
    and a week) and by part and order day: a task holds at most a week of a part."""
    mv = part_movements(spark, d, dealt_by="l_orderkey").filter((F.col("qty") != 0) & F.col("l_orderkey").isNotNull())
    net = windows.net_negative_movements(mv, "l_orderkey", "day", "qty", "sale_value", "cost", "margin",
                                         tie_cols=[*LINE_KEY, "copy"])
    o = read(spark, d, "orders", "o_orderkey", "o_orderdate")
    x = (net.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .filter(F.col("day").isNotNull() & F.col("l_partkey").isNotNull())
            .select(*MV_OUT, "day", "qty", "sale_value", "cost", F.to_date("o_orderdate").alias("order_day"),
                    F.date_trunc("week", "day").cast("date").alias("week"))
            .repartition("l_partkey", "week"))
    x = (x.withColumn("qty_day_part", F.sum("qty").over(Window.partitionBy("l_partkey", "week", "day")))
          .filter(F.col("order_day").isNotNull())
          .withColumn("qty_week_part", F.sum("qty").over(Window.partitionBy("l_partkey", "week")))
          .withColumn("qty_order_day_part", F.sum("qty").over(Window.partitionBy("l_partkey", "order_day"))))
    return x.select(*MV_OUT, rnd(F.col("sale_value") / F.col("qty")).alias("unit_price"), rnd(F.col("cost") / F.col("qty")).alias("unit_cost"),
                    rnd("qty_day_part").alias("qty_day_part"), rnd("qty_order_day_part").alias("qty_order_day_part"),
                    rnd("qty_week_part").alias("qty_week_part"))


sql("agg_02_parts_sales_preparation", f"""WITH {MOVEMENTS_SQL.strip().replace('FROM mv_base', 'FROM mv_base WHERE qty <> 0', 1)},
{_NET_SQL.replace('FROM movements WHERE qty >= 0', 'FROM movements WHERE qty > 0').replace('FROM movements WHERE qty < 0', 'FROM movements WHERE qty < 0 AND qty <> 0')},
x AS (SELECT n.*, CAST(o.o_orderdate AS DATE) AS order_day, CAST(date_trunc('week', n.day) AS DATE) AS week
  FROM netted n JOIN orders o ON n.l_orderkey = o.o_orderkey)
SELECT {LK}, copy, {sql_rnd('sale_value / qty')} AS unit_price, {sql_rnd('cost / qty')} AS unit_cost,
  {sql_rnd('sum(qty) OVER (PARTITION BY day, l_partkey)')} AS qty_day_part,
  {sql_rnd('sum(qty) OVER (PARTITION BY order_day, l_partkey)')} AS qty_order_day_part,
  {sql_rnd('sum(qty) OVER (PARTITION BY week, l_partkey)')} AS qty_week_part
FROM x""")

# ------------------------------------------------------------- odometer repair

OKEYS = ["vehicle", "owner"]
OORDER = ["day", "event_id"]


def _day_max(spark, d):
    return windows.keep_group_max(odometer(spark, d), OKEYS + ["day"], "kms")


def _odo_out(df):
    df = windows.diff_prev(df, OKEYS, OORDER, "kms", "kms_diff", chunk=F.trunc("day", "month"))
    return df.select(*OKEYS, "event_id", dstr("day").alias("day"), "kms", big("kms_diff").alias("kms_diff"))


_ODO_DIFF = "CAST(coalesce(kms - lag(kms) OVER (PARTITION BY vehicle, owner ORDER BY day, event_id), 0) AS BIGINT) AS kms_diff"


@query("win_04_kms_diff")
def win04(spark, d):
    return _odo_out(odometer(spark, d))


sql("win_04_kms_diff", f"WITH {ODOMETER_SQL.strip()} SELECT vehicle, owner, event_id, strftime(day, '%Y-%m-%d') AS day, kms, {_ODO_DIFF} FROM odometer")


@query("win_05_day_max")
def win05(spark, d):
    return _odo_out(_day_max(spark, d))


_S1 = f"""{ODOMETER_SQL.strip()},
s1 AS (SELECT vehicle, owner, day, event_id, kms FROM (SELECT *, max(kms) OVER (PARTITION BY vehicle, owner, day) AS mx FROM odometer) WHERE kms = mx),
x AS (SELECT *, row_number() OVER (PARTITION BY vehicle, owner ORDER BY day, event_id) AS pos FROM s1),
g AS (SELECT vehicle, owner, kms AS gk, min(day) AS dmin, max(day) AS dmax FROM x GROUP BY vehicle, owner, kms
      HAVING count(*) > 1 AND max(pos) - min(pos) + 1 > count(*))"""

sql("win_05_day_max", f"WITH {_S1} SELECT vehicle, owner, event_id, strftime(day, '%Y-%m-%d') AS day, kms, {_ODO_DIFF} FROM s1")


@query("win_06_mileage_repair_1")
def win06(spark, d):
    return _odo_out(windows.mileage_repair_between(_day_max(spark, d), OKEYS, OORDER))


sql("win_06_mileage_repair_1", f"""WITH {_S1},
kept AS (SELECT * FROM x WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.vehicle = x.vehicle AND g.owner = x.owner
  AND x.day > g.dmin AND x.day < g.dmax AND x.kms < g.gk))
SELECT vehicle, owner, event_id, strftime(day, '%Y-%m-%d') AS day, kms, {_ODO_DIFF} FROM kept""")


@query("win_07_mileage_repair_2")
def win07(spark, d):
    return _odo_out(windows.mileage_repair_last_pair(_day_max(spark, d), OKEYS, OORDER))


sql("win_07_mileage_repair_2", f"""WITH {_S1},
rk AS (SELECT *, row_number() OVER (PARTITION BY vehicle, owner, kms ORDER BY pos DESC) AS rd FROM x),
g2 AS (SELECT g.vehicle, g.owner, g.gk, g.dmin,
          max(CASE WHEN rk.rd = 1 THEN rk.day END) AS db, max(CASE WHEN rk.rd = 2 THEN rk.day END) AS da
       FROM g JOIN rk ON g.vehicle = rk.vehicle AND g.owner = rk.owner AND g.gk = rk.kms GROUP BY g.vehicle, g.owner, g.gk, g.dmin),
cut AS (SELECT g2.vehicle, g2.owner, g2.gk, g2.dmin, min(x.day) AS dcut FROM g2 JOIN x ON g2.vehicle = x.vehicle AND g2.owner = x.owner
          AND x.day > g2.da AND x.day < g2.db GROUP BY g2.vehicle, g2.owner, g2.gk, g2.dmin),
kept AS (SELECT * FROM x WHERE NOT EXISTS (SELECT 1 FROM cut WHERE cut.vehicle = x.vehicle AND cut.owner = x.owner
  AND x.day >= cut.dmin AND x.day < cut.dcut))
SELECT vehicle, owner, event_id, strftime(day, '%Y-%m-%d') AS day, kms, {_ODO_DIFF} FROM kept""")


@query("agg_25_negative_evolution_counts")
def agg25(spark, d):
    steps = {"initial": odometer(spark, d), "after_day_max": _day_max(spark, d)}
    steps["after_repair_1"] = windows.mileage_repair_between(steps["after_day_max"], OKEYS, OORDER)
    out = None
    for tag, df in steps.items():
        x = windows.diff_prev(df, OKEYS, OORDER, "kms", "kms_diff")
        r = x.agg(F.count_distinct(F.when(F.col("kms_diff") < 0, F.col("owner"))).alias("owners_negative"),
                  F.count_distinct(F.when(F.col("kms_diff") < 0, F.struct(*OKEYS))).alias("vehicles_negative"),
                  F.count_distinct("owner").alias("owners"), F.count_distinct("vehicle").alias("vehicles")).withColumn("step", F.lit(tag))
        out = r if out is None else out.unionByName(r)
    return out


sql("agg_25_negative_evolution_counts", f"""WITH {_S1},
k1 AS (SELECT * FROM x WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.vehicle = x.vehicle AND g.owner = x.owner AND x.day > g.dmin AND x.day < g.dmax AND x.kms < g.gk)),
st AS (SELECT 'initial' AS step, vehicle, owner, {_ODO_DIFF} FROM odometer
  UNION ALL SELECT 'after_day_max', vehicle, owner, {_ODO_DIFF} FROM s1
  UNION ALL SELECT 'after_repair_1', vehicle, owner, {_ODO_DIFF} FROM k1)
SELECT step, count(DISTINCT CASE WHEN kms_diff < 0 THEN owner END) AS owners_negative,
  count(DISTINCT CASE WHEN kms_diff < 0 THEN (vehicle, owner) END) AS vehicles_negative,
  count(DISTINCT owner) AS owners, count(DISTINCT vehicle) AS vehicles FROM st GROUP BY step""")

# --------------------------------------------------------------- fills / sort


@query("win_08_group_fill")
def win08(spark, d):
    e = events_gaps(spark, d)
    out = windows.group_fill(e, ["user_id"], ["ts", "event_id"], ["value", "value2"], chunk=F.date_trunc("day", "ts"))
    return out.select("event_id", rnd("value").alias("value"), rnd("value2").alias("value2"))


def _fill_sql(c):
    w = "PARTITION BY user_id ORDER BY ts, event_id"
    return (f"coalesce({c}, last_value({c} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"first_value({c} IGNORE NULLS) OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0.0)")


sql("win_08_group_fill", f"WITH {EVENTS_GAPS_SQL.strip()} SELECT event_id, {sql_rnd(_fill_sql('value'))} AS value, {sql_rnd(_fill_sql('value2'))} AS value2 FROM events_gaps")


@query("win_09_fill_classes")
def win09(spark, d):
    e = events_gaps(spark, d)
    a = windows.group_fill(e, ["user_id"], ["ts", "event_id"], ["value"], ffill=False, bfill=False, zero=True, chunk=F.date_trunc("day", "ts"))
    b = windows.group_fill(a, ["user_id"], ["ts", "event_id"], ["value2"], ffill=True, bfill=True, zero=False, chunk=F.date_trunc("day", "ts"))
    return b.select("event_id", rnd("value").alias("value"), rnd("value2").alias("value2"))


def _fill2_sql(c):
    w = "PARTITION BY user_id ORDER BY ts, event_id"
    return (f"coalesce({c}, last_value({c} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"first_value({c} IGNORE NULLS) OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))")


sql("win_09_fill_classes", f"WITH {EVENTS_GAPS_SQL.strip()} SELECT event_id, {sql_rnd('coalesce(value, 0.0)')} AS value, {sql_rnd(_fill2_sql('value2'))} AS value2 FROM events_gaps")


@query("srt_01_sort_nulls_first")
def srt01(spark, d):
    e = events_gaps(spark, d).select("event_id", "value", "user_id")
    return clean.sequence_number(e, [F.col("value").asc_nulls_first(), "event_id"], out="position") \
        .select("event_id", rnd("value").alias("value"), "position")


sql("srt_01_sort_nulls_first", f"WITH {EVENTS_GAPS_SQL.strip()} SELECT event_id, {sql_rnd('value')} AS value, CAST(row_number() OVER (ORDER BY value ASC NULLS FIRST, event_id) - 1 AS BIGINT) AS position FROM events_gaps")

# ---------------------------------------------------------- quantity shares


def _cfg_scores(spark, d):
    s = importer_sales(spark, d)
    return s.groupBy(*ICFG).agg((F.sum("l_quantity") / 1000.0).alias("score"))


@query("win_16_quantity_share")
def win16(spark, d):
    out = windows.quantity_share(_cfg_scores(spark, d), ["p_type"], "score", 100,
                                 [F.desc("score"), "p_brand"])
    return out.select(*ICFG, rnd("score").alias("score"), "quantity")


_CFG_SQL = f"""{IMPORTER_SQL.strip()},
cs AS (SELECT p_brand, p_type, sum(l_quantity) / 1000.0 AS score FROM importer_sales GROUP BY p_brand, p_type),
q AS (SELECT *, CAST(round_even(CAST(score / sum(score) OVER (PARTITION BY p_type) * 100 AS DECIMAL(38,10)), 0) AS DOUBLE) AS q0 FROM cs)"""

sql("win_16_quantity_share", f"""WITH {_CFG_SQL},
r AS (SELECT *, sum(q0) OVER (PARTITION BY p_type) AS tot, row_number() OVER (PARTITION BY p_type ORDER BY score DESC, p_brand) AS rn FROM q),
r2 AS (SELECT *, max(CASE WHEN q0 > 0 THEN rn END) OVER (PARTITION BY p_type) AS lastpos FROM r),
f AS (SELECT *, CAST(q0 + CASE WHEN 100 - tot > 0 AND rn = 1 THEN 100 - tot ELSE 0 END
                  + CASE WHEN 100 - tot < 0 AND rn = lastpos THEN 100 - tot ELSE 0 END AS BIGINT) AS quantity FROM r2)
SELECT p_brand, p_type, {sql_rnd('score')} AS score, quantity FROM f WHERE quantity > 0""")


@query("win_17_quantity_share_plain")
def win17(spark, d):
    out = windows.quantity_share(_cfg_scores(spark, d), ["p_type"], "score", 100, [], repair=False)
    return out.select(*ICFG, rnd("score").alias("score"), "quantity")


sql("win_17_quantity_share_plain", f"WITH {_CFG_SQL} SELECT p_brand, p_type, {sql_rnd('score')} AS score, CAST(q0 AS BIGINT) AS quantity FROM q")


@query("win_18_outlier_scores")
def win18(spark, d):
    o = _day_max(spark, d)
    s = windows.outlier_scores_1d(o, OKEYS, "kms", "event_id", 3, 10, 0.1, chunk=F.floor(F.col("kms") / 1000))
    return s.select(*OKEYS, "event_id", rnd("knn_mean", 6).alias("knn_mean"), rnd("knn_median", 6).alias("knn_median"),
                    rnd("lof", 3).alias("lof"), "knn_mean_outlier", "knn_median_outlier", "lof_outlier")


sql("win_18_outlier_scores", f"""WITH {ODOMETER_SQL.strip()},
s1 AS (SELECT vehicle, owner, day, event_id, kms FROM (SELECT *, max(kms) OVER (PARTITION BY vehicle, owner, day) AS mx FROM odometer) WHERE kms = mx),
p AS (SELECT *, row_number() OVER (PARTITION BY vehicle, owner ORDER BY kms, event_id) AS pos, count(*) OVER (PARTITION BY vehicle, owner) AS n FROM s1),
pr AS (SELECT a.vehicle, a.owner, a.event_id, a.pos, a.n, b.pos AS npos, abs(a.kms - b.kms) AS d,
  row_number() OVER (PARTITION BY a.vehicle, a.owner, a.pos ORDER BY abs(a.kms - b.kms), b.pos) AS r
  FROM p a JOIN p b ON a.vehicle = b.vehicle AND a.owner = b.owner AND a.pos <> b.pos),
kn AS (SELECT vehicle, owner, event_id, pos, avg(d) FILTER (WHERE r <= 3) AS knn_mean, quantile_cont(d, 0.5) FILTER (WHERE r <= 3) AS knn_median,
  max(d) FILTER (WHERE r <= greatest(least(10, n - 1), 1)) AS kdist FROM pr GROUP BY vehicle, owner, event_id, pos),
lr AS (SELECT pr.vehicle, pr.owner, pr.pos, 1 / (avg(greatest(o.kdist, pr.d)) + 1e-10) AS lrd FROM pr JOIN kn o ON pr.vehicle = o.vehicle AND pr.owner = o.owner AND pr.npos = o.pos
  WHERE pr.r <= greatest(least(10, pr.n - 1), 1) GROUP BY pr.vehicle, pr.owner, pr.pos),
lf AS (SELECT pr.vehicle, pr.owner, pr.pos, avg(o.lrd) / any_value(me.lrd) AS lof FROM pr JOIN lr o ON pr.vehicle = o.vehicle AND pr.owner = o.owner AND pr.npos = o.pos
  JOIN lr me ON pr.vehicle = me.vehicle AND pr.owner = me.owner AND pr.pos = me.pos WHERE pr.r <= greatest(least(10, pr.n - 1), 1) GROUP BY pr.vehicle, pr.owner, pr.pos),
sc AS (SELECT kn.vehicle, kn.owner, kn.event_id, kn.knn_mean, kn.knn_median, lf.lof FROM kn JOIN lf USING (vehicle, owner, pos)),
th AS (SELECT vehicle, owner, quantile_cont(knn_mean, 0.9) AS t1, quantile_cont(knn_median, 0.9) AS t2, quantile_cont(lof, 0.9) AS t3 FROM sc GROUP BY ALL)
SELECT vehicle, owner, event_id, {sql_rnd('knn_mean', 6)} AS knn_mean, {sql_rnd('knn_median', 6)} AS knn_median, {sql_rnd("lof", 3)} AS lof,
  CAST({sql_rnd('knn_mean', 6)} > {sql_rnd('t1', 6)} AS BIGINT) AS knn_mean_outlier, CAST({sql_rnd('knn_median', 6)} > {sql_rnd('t2', 6)} AS BIGINT) AS knn_median_outlier,
  CAST({sql_rnd('lof', 3)} > {sql_rnd('t3', 3)} AS BIGINT) AS lof_outlier
FROM sc JOIN th USING (vehicle, owner)""")
