"""Join operators (JON-*).

Strategy notes: dimension / rule tables of fixed size are broadcast
explicitly; anything whose size grows with the data is left to AQE, which
converts a shuffle join to a broadcast only from the measured runtime size.
Hot keys on the row side are split by AQE's skew-join handling; lookups are
made unique per key before the join so a hot key never multiplies rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join(df: DataFrame, other: DataFrame, on, suffixes=("_x", "_y")) -> DataFrame:
    """JON-01: left join; clashing non-key column names get suffixes."""
    keys = [on] if isinstance(on, str) else list(on)
    clash = [c for c in df.columns if c in other.columns and c not in keys]
    a = df.withColumnsRenamed({c: c + suffixes[0] for c in clash})
    b = other.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    return a.join(b, keys, "left")


def map_values(df: DataFrame, col: str, mapping: DataFrame, out: str,
               orig: str = "Original_Value", mapped: str = "Mapped_Value") -> DataFrame:
    """JON-02 / CLS-01 building block: left join a (original, mapped) mapping
    table on ``col``; unmapped rows get null in ``out``."""
    m = mapping.select(F.col(orig).alias("_o"), F.col(mapped).alias(out))
    return df.join(m, F.col(col) == F.col("_o"), "left").drop("_o")


def references_merge(df: DataFrame, master: DataFrame, left_key: str, right_key: str,
                     desc: str = "description"):
    """JON-03: left merge on possibly different key names; the description is
    coalesced right-first; returns (all, matched, unmatched).  Like the
    reference, the right side is not de-duplicated here."""
    m = master.select(F.col(right_key).alias("_rk"), F.col(desc).alias("_rdesc"))
    allrows = (df.join(m, F.col(left_key) == F.col("_rk"), "left")
                 .withColumn(desc, F.coalesce(F.col("_rdesc"), F.col(desc)))
                 .drop("_rk", "_rdesc"))
    return allrows, allrows.filter(F.col(desc).isNotNull()), allrows.filter(F.col(desc).isNull())


def cascade_match(stock: DataFrame, master: DataFrame, passes: list, stock_ref: str,
                  master_ref: str, master_desc: str, out_desc: str = "matched_desc",
                  out_pass: str = "match_pass") -> DataFrame:
    """JON-04: multi-pass key matching.  ``passes`` is an ordered list of
    functions Column -> Column that normalise a reference (pass 0 is usually
    the identity).  A stock reference takes the description of the FIRST pass
    whose normalised key exists in the (equally normalised) master, which
    equals the reference's cascade of left joins over still-unmatched rows.

    Plan: distinct stock references x passes and master x passes are joined
    once on (pass, key); the master side is made unique per (pass, key)
    (smallest description) so no row multiplies; the winning pass per
    reference is ``min_by``; the result is joined back on the reference."""
    refs = stock.select(F.col(stock_ref).alias("_ref")).where(F.col("_ref").isNotNull()).distinct()
    s = refs.select("_ref", F.explode(F.array(*[
        F.struct(F.lit(i).alias("pass"), fn(F.col("_ref")).alias("key")) for i, fn in enumerate(passes)
    ])).alias("_c")).select("_ref", "_c.pass", "_c.key").where(F.col("key").isNotNull() & (F.col("key") != ""))
    m = master.select(F.col(master_ref).alias("_mref"), F.col(master_desc).alias("_d"))
    m = m.select("_d", F.explode(F.array(*[
        F.struct(F.lit(i).alias("pass"), fn(F.col("_mref")).alias("key")) for i, fn in enumerate(passes)
    ])).alias("_c")).select("_c.pass", "_c.key", "_d").where(F.col("key").isNotNull() & (F.col("key") != ""))
    m = m.groupBy("pass", "key").agg(F.min("_d").alias("_d"))
    best = (s.join(m, ["pass", "key"], "inner")
              .groupBy("_ref").agg(F.min_by(F.struct("pass", "_d"), F.col("pass")).alias("_b"))
              .select("_ref", F.col("_b._d").alias(out_desc), F.col("_b.pass").cast("bigint").alias(out_pass)))
    return stock.join(best, F.col(stock_ref) == F.col("_ref"), "left").drop("_ref")


def override(df: DataFrame, corrections: DataFrame, key: str, target: str, corr_col: str,
             prob_col: str | None = None) -> DataFrame:
    """JON-06 / JON-07 / JON-11: corrections (unique per key: the smallest
    value is kept) override the target where present; optionally the
    probability becomes 1 where overridden."""
    c = corrections.groupBy(key).agg(F.min(corr_col).alias("_corr"))
    out = df.join(c, key, "left")
    if prob_col:
        out = out.withColumn(prob_col, F.when(F.col("_corr").isNotNull(), F.lit(1.0)).otherwise(F.col(prob_col)))
    return out.withColumn(target, F.coalesce(F.col("_corr"), F.col(target))).drop("_corr")


def keyed_update(df: DataFrame, new: DataFrame, key: str, target: str,
                 pred_col: str = "prediction", flag_col: str = "Classification_Flag") -> DataFrame:
    """JON-09: bring the prediction by key; flag predicted rows; the target
    becomes the prediction, falling back to the existing label."""
    n = new.select(key, F.col(pred_col).alias("_pred"))
    return (df.join(n, key, "left")
              .withColumn(flag_col, F.col("_pred").isNotNull().cast("bigint"))
              .withColumn(target, F.coalesce(F.col("_pred"), F.col(target)))
              .drop("_pred"))


def latest_rows(df: DataFrame, keys: list[str], date_col: str) -> DataFrame:
    """JON-15: rows carrying the per-key maximum date (ties kept), as a
    groupBy + semi-equi join (skew-safe) instead of a self join on text."""
    mx = df.groupBy(*keys).agg(F.max(date_col).alias("_mx"))
    return (df.join(mx, keys, "inner").filter(F.col(date_col) == F.col("_mx")).drop("_mx"))


def semi(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """JON-18 keep-listed."""
    return df.join(keys, on, "left_semi")


def anti(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """JON-18 exclude-listed."""
    return df.join(keys, on, "left_anti")


def one_to_one(df: DataFrame, other: DataFrame, on: list[str]):
    """JON-19: inner join plus a uniqueness check query: the second result
    holds the keys duplicated on either side (must be empty)."""
    dup = (df.groupBy(*on).count().filter("count > 1").select(*on)
             .unionByName(other.groupBy(*on).count().filter("count > 1").select(*on)).distinct())
    return df.join(other, on, "inner"), dup


def membership_flags(df: DataFrame, drop_keys: DataFrame, drop_on: str,
                     flag_keys: DataFrame, flag_on: str, flag_col: str = "regulation_flag",
                     flag_keys_col: str | None = None) -> DataFrame:
    """JON-23: drop rows whose document is listed in ``drop_keys``; flag rows
    whose account is listed in ``flag_keys``."""
    kept = df.join(drop_keys.select(drop_on).distinct(), drop_on, "left_anti")
    fk = flag_keys.select(F.col(flag_keys_col or flag_on).alias("_fk")).distinct().withColumn("_hit", F.lit(1))
    return (kept.join(fk, F.col(flag_on) == F.col("_fk"), "left")
                .withColumn(flag_col, F.coalesce(F.col("_hit"), F.lit(0)).cast("bigint"))
                .drop("_fk", "_hit"))


def value_grid(df: DataFrame, lists: dict[str, list]) -> DataFrame:
    """JON-12: scenario rows times chosen value lists.  The lists are bounded
    parameters, so the product is built with ``explode`` of literal arrays
    rather than a cross join."""
    out = df
    for c, vals in lists.items():
        out = out.withColumn(c, F.explode(F.array(*[F.lit(v) for v in vals])))
    return out


def and_all(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)
