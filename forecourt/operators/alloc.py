"""Exact capped order allocation (OPT-*) as window queries.

Both optimisation problems of the reference are integer programs with unit
weights, per-item box bounds and (optionally) one total cap.  For such a
problem filling items greedily by value (ties by key) is optimal: every
unit consumes exactly one unit of the shared cap, so an exchange argument
moves any unit from a lower-value item to a higher-value one without loss.
The greedy fill is a prefix sum over the value-descending order: item i
gets  max(0, min(cap_i, total - sum of caps of better items)).  The prefix
sum runs as a chunked scan per problem instance (see windows.chunked_running)
so a single very large instance is still split over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.operators.windows import chunked_running


def _value_chunk(value: Column) -> Column:
    # monotone non-increasing in value -> non-decreasing along "value desc"
    return -F.floor(F.log2(F.greatest(value, F.lit(1e-9))) * 4)


def greedy_fill(df: DataFrame, problem_cols: list[str], key_cols: list[str], value: str, cap: str,
                total: Column | None, out: str = "quantity") -> DataFrame:
    """Allocate integer quantities 0..cap maximising sum(value * q) under an
    optional total cap (``total`` is a column, null = no total).  Items with
    value <= 0 get 0."""
    pos = df.filter((F.col(value) > 0) & (F.col(cap) > 0))
    rest = df.join(pos.select(*problem_cols, *key_cols), [*problem_cols, *key_cols], "left_anti") \
             .withColumn(out, F.lit(0).cast("bigint"))
    order = [F.col(value).desc(), *[F.col(k) for k in key_cols]]
    scanned = chunked_running(pos, problem_cols, order, _value_chunk(F.col(value)), sum_cols=[cap], lag_cols=[],
                              prefix="_g")
    before = F.col(f"_g_cum_{cap}") - F.col(cap)
    q = F.when(total.isNull(), F.col(cap)).otherwise(F.greatest(F.lit(0), F.least(F.col(cap), total - before))) \
        if total is not None else F.col(cap)
    filled = scanned.withColumn(out, q.cast("bigint")).drop("_g_rn", f"_g_cum_{cap}")
    return filled.unionByName(rest.select(*filled.columns))


def parts_allocation(df: DataFrame, problem_cols: list[str], key_cols: list[str], value: str, dts: str,
                     dts_goal: float, min_value: float | None = None, max_parts: Column | None = None,
                     max_qty: int = 100) -> DataFrame:
    """OPT-01: keep days-to-sell <= goal and value >= minimum; per item the
    quantity q satisfies q * days-to-sell <= goal and 0 <= q <= 100;
    maximise the total value under an optional total part count."""
    x = df.filter(F.col(dts) <= dts_goal)
    if min_value:
        x = x.filter(F.col(value) >= min_value)
    cap = F.when(F.col(dts) <= 0, F.lit(max_qty)).otherwise(
        F.least(F.lit(max_qty), F.floor(F.lit(dts_goal) / F.col(dts)))).cast("bigint")
    x = x.withColumn("_cap", cap)
    out = greedy_fill(x, problem_cols, key_cols, value, "_cap", max_parts)
    return out.drop("_cap")


def vehicles_allocation(df: DataFrame, problem_cols: list[str], key_cols: list[str], score: str,
                        order_size: Column, lower: str | None = None, max_qty: int = 100) -> DataFrame:
    """OPT-02: maximise score * q with 0 <= q <= 100 (q >= lower bound when
    given) and sum(q) <= order size.  Lower bounds are taken first, the
    remaining size is filled greedily by score."""
    lb = F.coalesce(F.col(lower), F.lit(0)) if lower else F.lit(0)
    x = df.withColumn("_lb", lb.cast("bigint"))
    used = x.groupBy(*problem_cols).agg(F.sum("_lb").alias("_lbsum"))
    x = x.join(used, problem_cols, "inner").withColumn("_room", F.lit(max_qty) - F.col("_lb"))
    x = x.withColumn("_left", order_size - F.col("_lbsum"))
    g = greedy_fill(x, problem_cols, key_cols, score, "_room", F.greatest(F.col("_left"), F.lit(0)), out="_extra")
    return (g.withColumn("quantity", (F.col("_lb") + F.col("_extra")).cast("bigint"))
             .withColumn("feasible", (F.col("_left") >= 0).cast("bigint"))
             .drop("_lb", "_lbsum", "_room", "_left", "_extra"))
