"""Set operators (SET-*)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def union_all(frames: list[DataFrame]) -> DataFrame:
    """SET-01 / SET-02: UNION ALL of equally projected frames (by name)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_distinct(new: DataFrame, previous: DataFrame, drop: list[str] = ()) -> DataFrame:
    """SET-03: new union previous, drop columns, distinct."""
    return new.unionByName(previous).drop(*drop).distinct()


def union_keep_old(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """SET-04: old results union new, one row per key, the old one wins.
    Expressed as new-anti-old + old (no window, no hot-key buffering)."""
    return old.unionByName(new.join(old.select(*keys).distinct(), keys, "left_anti"))


def symmetric_difference(a: DataFrame, b: DataFrame, cols: list[str]) -> DataFrame:
    """SET-05: rows (over ``cols``) present in exactly one of the two sides;
    each side is made distinct first, then a row survives when its count over
    the union is 1 (one aggregation, partial counts map-side)."""
    u = a.select(*cols).distinct().unionByName(b.select(*cols).distinct())
    return u.groupBy(*cols).count().filter(F.col("count") == 1).drop("count")


def intersect_values(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """SET-06: distinct values present on both sides."""
    return a.select(col).distinct().join(b.select(col).distinct(), col, "inner")


def keep_first_by_priority(df: DataFrame, keys: list[str], priority: str) -> DataFrame:
    """Union-with-priority helper: per key keep rows of the smallest
    priority."""
    w = Window.partitionBy(*keys)
    return df.withColumn("_mp", F.min(priority).over(w)).filter(F.col(priority) == F.col("_mp")).drop("_mp")
