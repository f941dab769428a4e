"""Isolation forest on one numeric column per group (WIN-19), grown by Spark.

All trees of all groups grow level by level.  A level is one aggregation over
(group, tree, node) for the smallest value, the largest and the number of
readings; a node splits at a place between the two that a hash of (seed, group,
tree, node) draws, so every tree has draws of its own and any engine repeats
them.  Readings that agree in a value travel as one row with a count.  Nothing is
sampled.  A node is a run of a group's sorted values, so a group of up to ``IN_TASK``
distinct values is one row, all its trees grow in one task, and only the summed paths
leave it; of a larger group a level's rows are stored, and no task holds it.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from forecourt.operators.quantiles import quantiles
from forecourt.session import materialize

TREES = 100
#: Path lengths are summed as whole billionths, so that no order of summing matters.
UNIT = 1_000_000_000
EULER = 0.5772156649
#: Distinct values of a group whose trees grow in one task, and values to a task.
IN_TASK, TASK_VALUES = 20_000, 10_000


def average_path(n: Column) -> Column:
    """Mean path length of an unsuccessful search among n values."""
    return (F.when(n > 2, 2.0 * (F.log((n - 1).cast("double")) + EULER) - 2.0 * (n - 1) / n)
             .when(n == 2, F.lit(1.0)).otherwise(F.lit(0.0)))


def draw(seed: int, parts: list) -> Column:
    """A number in (0, 1) from a hash of the parts' text."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(p).cast("string") for p in parts])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0


def _mean_path(n: np.ndarray) -> np.ndarray:
    """``average_path`` of numbers."""
    m = np.maximum(n, 2).astype(float)
    return np.where(n > 2, 2.0 * (np.log(m - 1) + EULER) - 2.0 * (m - 1) / m, np.where(n == 2, 1.0, 0.0))


def grown_paths(name: str, values: np.ndarray, counts: np.ndarray, limit: int, trees: int) -> np.ndarray:
    """Path of every value of one group, summed over its trees, in ``UNIT`` parts.  ``name`` is
    the text of seed and keys; a node is the values from ``a`` up to ``b``."""
    upto, total, depth = np.concatenate([[0], np.cumsum(counts)]), np.zeros(len(values) + 1, np.int64), 0
    tree, node = np.arange(1, trees + 1), np.ones(trees, np.int64)
    a, b = np.zeros(trees, np.int64), np.full(trees, len(values))
    while len(tree):
        low, high = values[a], values[b - 1]
        ends = (low == high) | (limit <= depth)
        path = np.floor((depth + _mean_path(upto[b[ends]] - upto[a[ends]])) * UNIT + 0.5).astype(np.int64)
        np.add.at(total, a[ends], path)
        np.add.at(total, b[ends], -path)
        tree, node, a, b, low, high = (x[~ends] for x in (tree, node, a, b, low, high))
        drawn = [int.from_bytes(hashlib.md5(f"{name}|{t}|{x}".encode()).digest()[:4], "big") for t, x in zip(tree.tolist(), node.tolist())]
        cut = low + (high - low) * ((np.array(drawn, float) + 0.5) / 4294967296.0)
        middle = np.clip(np.searchsorted(values, cut), a, b)
        tree, node = np.concatenate([tree, tree]), np.concatenate([node * 2, node * 2 + 1])
        a, b = np.concatenate([a, middle]), np.concatenate([middle, b])
        tree, node, a, b = (x[a < b] for x in (tree, node, a, b))
        depth += 1
    return np.cumsum(total[:-1])


def _small_paths(groups: DataFrame, keys: list[str], trees: int, seed: int) -> DataFrame:
    """(keys, _v, _n, _path) of groups that fit a task, from (keys, _v, _c, _n, _limit)."""
    @pandas_udf("array<bigint>")
    def grow(name: pd.Series, values: pd.Series, counts: pd.Series, limit: pd.Series) -> pd.Series:
        return pd.Series([grown_paths(*x, trees) for x in zip(name, values, counts, limit)], dtype=object)
    one = groups.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_v", "_c"))).alias("_g"), F.first("_n").alias("_n"), F.first("_limit").alias("_limit"))
    # The work follows the values, not the bytes: as many tasks as they fill.
    one = one.repartition(max(1, -(-groups.count() // TASK_VALUES)), *keys)
    name = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    paths = one.withColumn("_p", grow(name, F.col("_g._v"), F.col("_g._c"), F.col("_limit")))
    return paths.select(*keys, "_n", F.explode(F.arrays_zip(F.col("_g._v").alias("_v"), F.col("_p").alias("_path"))).alias("_x")).select(
        *keys, "_x._v", "_n", "_x._path")


def isolation_scores(df: DataFrame, keys: list[str], value: str, trees: int = TREES, seed: int = 17) -> DataFrame:
    """(keys, value, if_score): 2 ** -(mean path / average path of the group's size) of every
    distinct value of every group.  A node ends when its values are equal or at depth
    ceil(log2(readings)).  Rows with a null key or value take no part."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, value]])
    counts = df.where(known).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    counts = materialize(counts, "checkpoint")
    endless = F.isnan("_v") | (F.abs("_v") == float("inf"))
    sizes = counts.groupBy(*keys).agg(F.sum("_c").alias("_n"), ((F.count(F.lit(1)) <= IN_TASK) & ~F.bool_or(endless)).alias("_small"))
    base = counts.join(sizes, keys).withColumn("_limit", F.ceil(F.log2(F.greatest(F.col("_n"), F.lit(2)).cast("double"))))
    base = materialize(base, "checkpoint")
    paths = _small_paths(base.where("_small"), keys, trees, seed).unionByName(_large_paths(base.where("NOT _small"), keys, trees, seed))
    total = paths.groupBy(*keys, "_v", "_n").agg(F.sum("_path").alias("_path"))
    usual = F.when(F.col("_n") > 2, average_path(F.col("_n"))).otherwise(F.lit(1.0))
    return total.select(*keys, F.col("_v").alias(value), F.pow(F.lit(2.0), -(F.col("_path").cast("double") / UNIT / trees) / usual).alias("if_score"))


def _large_paths(base: DataFrame, keys: list[str], trees: int, seed: int) -> DataFrame:
    """(keys, _v, _n, _path), a row a level that the value's trees ended in."""
    state = base.select(*keys, "_v", "_c", "_n", "_limit", F.explode(F.sequence(F.lit(1), F.lit(trees))).alias("_tree"), F.lit(1).cast("long").alias("_node"))
    state, ended, depth = materialize(state, "checkpoint"), [base.limit(0).select(*keys, "_v", "_n", F.lit(0).cast("long").alias("_path"))], 0
    while not state.isEmpty():
        node = [*keys, "_tree", "_node"]
        nodes = state.groupBy(*node).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum("_c").alias("_size"))
        nodes = nodes.withColumn("_cut", F.col("_lo") + (F.col("_hi") - F.col("_lo")) * draw(seed, node))
        level = materialize(state.join(nodes, node), "checkpoint")
        ends = (F.col("_lo") == F.col("_hi")) | (F.col("_limit") <= depth)
        path = F.floor((depth + average_path(F.col("_size"))) * UNIT + 0.5)
        ended.append(level.where(ends).groupBy(*keys, "_v", "_n").agg(F.sum(path).alias("_path")))
        state = level.where(~ends).select(*keys, "_v", "_c", "_n", "_limit", "_tree",
                                          (F.col("_node") * 2 + (F.col("_v") >= F.col("_cut")).cast("long")).alias("_node"))
        depth += 1
    return reduce(lambda a, b: a.unionByName(b), ended)


def isolation_outliers(df: DataFrame, keys: list[str], value: str, contamination: float = 0.1, trees: int = TREES, seed: int = 17) -> DataFrame:
    """All rows with a key and value, their score, and whether it is above the group's
    (1 - contamination) quantile, compared at the reported six decimals."""
    from forecourt.functions.fmt import rnd
    scored = df.withColumn("_value", F.col(value).cast("double")).join(
        isolation_scores(df, keys, value, trees, seed).withColumnRenamed(value, "_value"), [*keys, "_value"]).drop("_value")
    scored = materialize(scored, "checkpoint")  # read by every pass of the quantiles
    limits = quantiles(scored, keys, "if_score", [1 - contamination])
    return (scored.join(limits, keys)
            .withColumn("if_outlier", (rnd(F.col("if_score"), 6) > rnd(F.col("q0"), 6)).cast("bigint")).drop("q0"))
