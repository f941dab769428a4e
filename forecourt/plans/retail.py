"""Retail vehicle scoring (JOB-01 chain): margin %, score, previous-sale
features per configuration, multi-grain averages."""

from __future__ import annotations

from pyspark.sql import functions as F

from forecourt.functions import measures
from forecourt.functions.fmt import big, rnd, sql_rnd
from forecourt.operators import aggs, windows
from forecourt.plans.registry import query
from forecourt.session import free_shuffles, materialize
from forecourt.sources.fixtures import LINE_KEY_SQL, VEHICLE_SALES_SQL, sale_values, vehicle_lines, vehicle_sales
from forecourt.sources.tables import LINE_KEY

CONFIG = ["brand", "ptype", "size_class"]
CONFIG_SQL = ", ".join(CONFIG)
ORDER = ["sale_date", *LINE_KEY]
ORDER_SQL = "sale_date, " + LINE_KEY_SQL
GRAINS = [("", []), ("_local", ["place"]), ("_local_v2", ["place_v2"])]
HOLD = repr(0.05 / 360)

#: What the history features read and their queries return.
HIST_IN = [*LINE_KEY, *CONFIG, "sale_date", "new_score", "margin_pct", "stock_days"]

# ---------------------------------------------------------------- Spark side


def scored(spark, d):
    return _scored(vehicle_sales(spark, d))


def _scored(sales):
    return measures.score(measures.margin_pct(sales))


def with_history(spark, d):
    # chunk = sale month: a monotone coarsening of the leading order column,
    # so a hot configuration is scanned by many tasks.
    return windows.previous_sales_features(
        materialize(scored(spark, d)), CONFIG, ORDER, chunk=F.trunc("sale_date", "month"))


HIST_COLS = ["prev_sales_check", "number_prev_sales", "last_score", "last_margin",
             "last_stock_days", "average_score_dynamic", "average_score_dynamic_std",
             "prev_average_score_dynamic", "prev_average_score_dynamic_std",
             "average_score_global", "min_score_global", "max_score_global",
             "q3_score_global", "median_score_global", "q1_score_global"]


def _grain_cols():
    out = []
    for tag, _ in GRAINS:
        out.append((f"nr_cars_sold{tag}", "big"))
        for name, _ in aggs.GRAIN_MEASURES:
            out.append((f"{name}{tag}", "dbl"))
    return out


def _fmt(cols):
    res = []
    for name, kind in cols:
        res.append(big(name).alias(name) if kind == "big" else rnd(name, 4).alias(name))
    return res


SCORE_OUT = [("margin_pct", "dbl"), ("stock_days", "big"), ("stock_days_class", "big"),
             ("margin_class", "big"), ("new_score", "big"), ("days_stock_price", "dbl"),
             ("score_euros", "dbl")]
HIST_OUT = [(c, "big" if c in ("prev_sales_check", "number_prev_sales") else "dbl")
            for c in HIST_COLS]


@query("mth_01_margin_pct")
def q_mth01(spark, d):
    v = measures.margin_pct(vehicle_sales(spark, d))
    return v.select(*LINE_KEY, rnd("price_total", 4).alias("price_total"),
                    rnd("margin", 4).alias("margin"), rnd("margin_pct", 4).alias("margin_pct"))


@query("mth_02_score")
def q_mth02(spark, d):
    return scored(spark, d).select(*LINE_KEY, *_fmt(SCORE_OUT))


@query("win_01_previous_sales")
def q_win01(spark, d):
    # the scan is read by the chunk offsets, the group statistics and the
    # rows themselves: materialise the scored base once
    base = materialize(scored(spark, d).select(*HIST_IN))
    h = windows.previous_sales_features(base, CONFIG, ORDER, chunk=F.trunc("sale_date", "month"))
    return h.select(*LINE_KEY, *CONFIG, *_fmt(HIST_OUT))


@query("agg_03_multi_grain_averages")
def q_agg03(spark, d):
    base = materialize(scored(spark, d))
    out = aggs.multi_grain_averages(base, CONFIG, GRAINS)
    return out.select(*LINE_KEY, *CONFIG, "place", "place_v2", *_fmt(_grain_cols()))


def retail_scored(spark, d):
    """JOB-01 analogue: the flagship chain.  The joined lines are
    materialised once (a table in the shared folder): the history
    features and the grain aggregation both read them, so the scan and
    joins of the source tables run once.  Measures are made of the lines where
    they are read, and for the history past the shuffle: neither the table nor
    the shuffle holds them."""
    lines = materialize(vehicle_lines(spark, d), "table")
    base = _scored(sale_values(lines))
    free_shuffles(spark)
    spread = lines.repartition(*CONFIG, F.trunc("sale_date", "month"))
    h = windows.previous_sales_features(_scored(sale_values(spread)), CONFIG, ORDER, chunk=F.trunc("sale_date", "month"), source=base)
    out = aggs.multi_grain_averages(h, CONFIG, GRAINS, source=base)
    return out.select(*LINE_KEY, *CONFIG, "place", "place_v2",
                      *_fmt(SCORE_OUT), *_fmt(HIST_OUT), *_fmt(_grain_cols()))


query("job_01_retail_scored")(retail_scored)


# ------------------------------------------------------------------ SQL side

def _sql_fmt(cols, alias=""):
    res = []
    for name, kind in cols:
        e = f"{alias}{name}"
        res.append(f"CAST({e} AS BIGINT) AS {name}" if kind == "big" else f"{sql_rnd(e, 4)} AS {name}")
    return ",\n  ".join(res)


SCORED_SQL = VEHICLE_SALES_SQL + f""",
m AS (
  SELECT *, {sql_rnd(f"{sql_rnd('margin', 2)} / NULLIF({sql_rnd('price_total', 2)}, 0) * 100", 4)} AS margin_pct
  FROM vehicle_sales),
s1 AS (
  SELECT *, CAST(greatest(date_diff('day', purchase_date, sale_date), 0) AS BIGINT) AS stock_days FROM m),
scored AS (
  SELECT *, CAST(stock_days <= 45 AS BIGINT) AS stock_days_class,
         CAST(coalesce(margin_pct >= 3.5, false) AS BIGINT) AS margin_class,
         CAST(stock_days <= 45 AS BIGINT) * CAST(coalesce(margin_pct >= 3.5, false) AS BIGINT) AS new_score,
         CAST('{HOLD}' AS DOUBLE) * price_total * stock_days AS days_stock_price,
         margin - CAST('{HOLD}' AS DOUBLE) * price_total * stock_days AS score_euros
  FROM s1)"""

_W = f"PARTITION BY {CONFIG_SQL}"
_WO = f"{_W} ORDER BY {ORDER_SQL}"

HIST_SQL = SCORED_SQL + f""",
h1 AS (
  SELECT *, row_number() OVER ({_WO}) AS rn, count(*) OVER ({_W}) AS n_grp,
         sum(new_score) OVER ({_WO} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
         lag(new_score) OVER ({_WO}) AS lag_s, lag(margin_pct) OVER ({_WO}) AS lag_m,
         lag(stock_days) OVER ({_WO}) AS lag_d
  FROM scored),
h2 AS (
  SELECT *, CASE WHEN rn = 1 THEN 0.0 ELSE cum / rn END AS asd,
         CASE WHEN rn <= 2 THEN 0.0 ELSE (cum - new_score) / (rn - 1) END AS pasd
  FROM h1),
h3 AS (
  SELECT *, stddev_pop(asd) OVER ({_W}) AS sd, avg(new_score) OVER ({_W}) AS sa,
         min(new_score) OVER ({_W}) AS smin, max(new_score) OVER ({_W}) AS smax,
         quantile_cont(new_score, 0.75) OVER ({_W}) AS sq3,
         quantile_cont(new_score, 0.5) OVER ({_W}) AS sq2,
         quantile_cont(new_score, 0.25) OVER ({_W}) AS sq1
  FROM h2),
hist AS (
  SELECT *,
    CASE WHEN n_grp > 1 AND rn > 1 THEN 1 ELSE 0 END AS prev_sales_check,
    CASE WHEN n_grp > 1 THEN rn - 1 ELSE 0 END AS number_prev_sales,
    CASE WHEN n_grp > 1 THEN coalesce(CAST(lag_s AS DOUBLE), 0.0) ELSE 0.0 END AS last_score,
    CASE WHEN n_grp > 1 THEN coalesce(CAST(lag_m AS DOUBLE), 0.0) ELSE 0.0 END AS last_margin,
    CASE WHEN n_grp > 1 THEN coalesce(CAST(lag_d AS DOUBLE), 0.0) ELSE 0.0 END AS last_stock_days,
    CASE WHEN n_grp > 1 THEN asd ELSE 0.0 END AS average_score_dynamic,
    CASE WHEN n_grp > 1 THEN sd ELSE 0.0 END AS average_score_dynamic_std,
    CASE WHEN n_grp > 1 THEN pasd ELSE 0.0 END AS prev_average_score_dynamic,
    CASE WHEN n_grp > 1 AND rn > 1 THEN sd ELSE 0.0 END AS prev_average_score_dynamic_std,
    CASE WHEN n_grp > 1 THEN sa ELSE 0.0 END AS average_score_global,
    CASE WHEN n_grp > 1 THEN CAST(smin AS DOUBLE) ELSE 0.0 END AS min_score_global,
    CASE WHEN n_grp > 1 THEN CAST(smax AS DOUBLE) ELSE 0.0 END AS max_score_global,
    CASE WHEN n_grp > 1 THEN sq3 ELSE 0.0 END AS q3_score_global,
    CASE WHEN n_grp > 1 THEN sq2 ELSE 0.0 END AS median_score_global,
    CASE WHEN n_grp > 1 THEN sq1 ELSE 0.0 END AS q1_score_global
  FROM h3)"""


def _grain_sql(src):
    parts, joins = [], []
    for i, (tag, extra) in enumerate(GRAINS):
        keys = CONFIG + extra
        ks = ", ".join(keys)
        meas = ", ".join(f"{sql_rnd(f'avg({c})', 4)} AS {n}{tag}" for n, c in aggs.GRAIN_MEASURES)
        parts.append(f"g{i} AS (SELECT {ks}, CAST(count(*) AS BIGINT) AS nr_cars_sold{tag}, {meas} "
                     f"FROM {src} GROUP BY {ks})")
        joins.append(f"JOIN g{i} USING ({ks})")
    return ",\n".join(parts), " ".join(joins)


_G_SCORED = _grain_sql("scored")
_G_HIST = _grain_sql("hist")

ORACLE = {
    "mth_01_margin_pct": VEHICLE_SALES_SQL + f"""
SELECT {LINE_KEY_SQL}, {sql_rnd('price_total', 4)} AS price_total, {sql_rnd('margin', 4)} AS margin,
  {sql_rnd(f"{sql_rnd('margin', 2)} / NULLIF({sql_rnd('price_total', 2)}, 0) * 100", 4)} AS margin_pct
FROM vehicle_sales""",
    "mth_02_score": "WITH " + SCORED_SQL.lstrip() + f"""
SELECT {LINE_KEY_SQL},
  {_sql_fmt(SCORE_OUT)}
FROM scored""",
    "win_01_previous_sales": "WITH " + HIST_SQL.lstrip() + f"""
SELECT {LINE_KEY_SQL}, {CONFIG_SQL},
  {_sql_fmt(HIST_OUT)}
FROM hist""",
    "agg_03_multi_grain_averages": "WITH " + SCORED_SQL.lstrip() + ",\n" + _G_SCORED[0] + f"""
SELECT {LINE_KEY_SQL}, {CONFIG_SQL}, place, place_v2,
  {_sql_fmt(_grain_cols())}
FROM scored {_G_SCORED[1]}""",
    "job_01_retail_scored": "WITH " + HIST_SQL.lstrip() + ",\n" + _G_HIST[0] + f"""
SELECT {LINE_KEY_SQL}, {CONFIG_SQL}, place, place_v2,
  {_sql_fmt(SCORE_OUT)},
  {_sql_fmt(HIST_OUT)},
  {_sql_fmt(_grain_cols())}
FROM hist {_G_HIST[1]}""",
}
ORACLE["mth_01_margin_pct"] = "WITH " + ORACLE["mth_01_margin_pct"].lstrip()
