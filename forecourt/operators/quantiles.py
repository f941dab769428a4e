"""Exact quantiles without a value map (MTH-06, MLX-08, AGG-22, AGG-26, WIN-19).

Selection by histogram refinement: the interval that holds a wanted order
statistic is cut into ``BINS`` bins, one aggregation counts them (partial sums
before the shuffle), and the bin with the wanted rank becomes the next interval,
tightened to the smallest and largest value in it.  A few passes end at a single
value; several quantiles and all groups go together.  Neither a column nor a
group is ever held in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.session import materialize

BINS = 1024


def quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float]) -> DataFrame:
    """(keys, q0, q1, ...): the linearly interpolated quantiles of ``value`` in each
    group, as ``percentile`` defines them.  Nulls are left out, and a group without
    a value has no row; null keys are a group.  Without keys there is one row,
    all null for an empty table."""
    names = [f"_k{i}" for i in range(len(keys))] or ["_k0"]
    own = [F.col(k).alias(n) for k, n in zip(keys, names)] or [F.lit(0).alias("_k0")]
    x = df.where(F.col(value).isNotNull()).select(*own, F.col(value).cast("double").alias("_v"))
    whole = x.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    at = [F.lit(float(p)) * (F.col("_n") - 1) for p in probs]
    wanted = F.array(*[F.struct(F.lit(2 * i + s).alias("t"), f(a).cast("long").alias("r")) for i, a in enumerate(at) for s, f in ((0, F.floor), (1, F.ceil))])
    state = whole.select(*names, "_n", "_lo", "_hi", F.lit(0).cast("long").alias("_below"), F.explode(wanted).alias("_w")).select(
        *names, "_n", "_lo", "_hi", "_below", F.col("_w.t").alias("_t"), F.col("_w.r").alias("_r"))
    state = materialize(state, "checkpoint")
    found = [state.where("_lo = _hi")]
    state = state.where("_lo < _hi")
    while not state.isEmpty():
        # Without keys the state is a row a quantile; otherwise its size is measured by the optimiser.
        there = state.select(*[F.col(n).alias(f"_s{n}") for n in names], "_n", "_lo", "_hi", "_below", "_t", "_r")
        same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_s{n}")) for n in names])
        met = x.join(there if keys else F.broadcast(there), same & (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
        share = (F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
        binned = met.withColumn("_b", F.least(F.floor(share * BINS), F.lit(BINS - 1)))
        of = [*names, "_n", "_below", "_t", "_r"]
        bins = binned.groupBy(*of, "_b").agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        upto = F.sum("_c").over(Window.partitionBy(*names, "_t").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        reached = bins.withColumn("_upto", F.col("_below") + upto).where((F.col("_upto") > F.col("_r")) & (F.col("_upto") - F.col("_c") <= F.col("_r")))
        state = materialize(reached.withColumn("_below", F.col("_upto") - F.col("_c")).select(*names, "_n", "_lo", "_hi", "_below", "_t", "_r"), "checkpoint")
        found.append(state.where("_lo = _hi"))
        state = state.where("_lo < _hi")
    values = reduce(lambda a, b: a.unionByName(b), found).groupBy(*names).agg(
        F.max("_n").alias("_n"), *[F.max(F.when(F.col("_t") == t, F.col("_lo"))).alias(f"_q{t}") for t in range(2 * len(probs))])
    out = []
    for i, a in enumerate(at):
        low, high = F.col(f"_q{2 * i}"), F.col(f"_q{2 * i + 1}")
        between = (F.ceil(a) - a) * low + (a - F.floor(a)) * high
        out.append(F.when(low == high, low).otherwise(between).alias(f"q{i}"))
    if keys:
        return values.select(*[F.col(n).alias(k) for k, n in zip(keys, names)], *out)
    return values.select(*out) if not values.isEmpty() else df.sparkSession.range(1).select(*[F.lit(None).cast("double").alias(f"q{i}") for i in range(len(probs))])


def quantile_values(df: DataFrame, value: str, probs: list[float]) -> list:
    """The quantiles of a whole column as literals (one row comes to the driver)."""
    return [F.lit(v).cast("double") for v in quantiles(df, [], value, probs).first()]
