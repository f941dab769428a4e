"""Projection, predicate and row-cleaning operators (PRJ-*).

All are column expressions or one aggregation + join; data-quality findings
(dropped ids, unmapped values) are returned as DataFrames, never printed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.session import materialize

WS = r"^[\s]+|[\s]+$"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def lowercase(df: DataFrame, cols: list[str]) -> DataFrame:
    """PRJ-01."""
    return df.withColumns({c: F.lower(F.col(c)) for c in cols})


def strip(df: DataFrame, cols: list[str]) -> DataFrame:
    """PRJ-02: strip leading / trailing whitespace (any of space, tab, line
    breaks), as Python's ``str.strip``."""
    return df.withColumns({c: F.regexp_replace(F.col(c), WS, "") for c in cols})


def remove_columns(df: DataFrame, cols: list[str]) -> tuple[DataFrame, list[str]]:
    """PRJ-03: drop columns; the missing ones are returned as a warning list."""
    missing = [c for c in cols if c not in df.columns]
    return df.drop(*[c for c in cols if c in df.columns]), missing


def remove_rows(df: DataFrame, conditions: list[Column], id_col: str | None = None):
    """PRJ-04: drop rows matching any condition (all conditions apply, Q-22).
    Returns (kept, removed ids) - the second is a data-quality output."""
    hit = reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions])
    kept = df.filter(~hit)
    removed = df.filter(hit).select(id_col).distinct() if id_col else df.filter(hit)
    return kept, removed


def ordered_rewrites(df: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """PRJ-05: ordered (column, regex, replacement) rewrites, each applied as a
    word-bounded or word-start match; later rules see earlier results."""
    out = df
    for col, pat, rep in rules:
        out = out.withColumn(col, F.regexp_replace(F.col(col), rf"\b{pat}\b|\b{pat}", rep))
    return out


def date_parts(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """PRJ-06: {prefix: date column} -> prefix+day / month / year."""
    out = df
    for prefix, col in mapping.items():
        out = out.withColumns({f"{prefix}day": F.dayofmonth(col), f"{prefix}month": F.month(col),
                               f"{prefix}year": F.year(col)})
    return out


def rename(df: DataFrame, old: list[str], new: list[str]) -> DataFrame:
    """PRJ-07."""
    return df.withColumnsRenamed(dict(zip(old, new)))


def constants(df: DataFrame, cols: list[str], value) -> DataFrame:
    """PRJ-08."""
    return df.withColumns({c: F.lit(value) for c in cols})


def cast_all(df: DataFrame, type_string: str) -> DataFrame:
    """PRJ-09 / PRJ-10: whole-frame cast."""
    return df.select(*[F.col(c).cast(type_string).alias(c) for c in df.columns])


def fill_from(df: DataFrame, null_column: str, non_null_column: str) -> DataFrame:
    """PRJ-11: fill one column from another where it is null."""
    return df.withColumn(null_column, F.coalesce(F.col(null_column), F.col(non_null_column)))


def fill_const(df: DataFrame, mapping: dict) -> DataFrame:
    """PRJ-12."""
    return df.na.fill(mapping)


def literal_removal(df: DataFrame, col: str) -> DataFrame:
    """PRJ-13: newline, carriage return, tab and the literal text \\u to a
    space; nulls stay null."""
    return df.withColumn(col, F.regexp_replace(F.col(col), r"\n|\r|\t|\\u", " "))


def null_if_match(df: DataFrame, col: str, regex: str) -> DataFrame:
    """PRJ-14 (one-key form): the whole cell becomes null when the regex is
    found anywhere in it (Q-17)."""
    return df.withColumn(col, F.when(F.col(col).rlike(regex), F.lit(None)).otherwise(F.col(col)))


def paired_replacement(df: DataFrame, key_col: str, target_col: str, pairs: DataFrame) -> DataFrame:
    """PRJ-14 (two-key form): where key_col equals a listed value, set
    target_col to the paired value.  ``pairs`` = (value, replacement) rows,
    one per value; joined, never collected."""
    p = pairs.toDF("_k", "_v")
    return (df.join(p, F.col(key_col) == F.col("_k"), "left")
              .withColumn(target_col, F.coalesce(F.col("_v"), F.col(target_col)))
              .drop("_k", "_v"))


def keep_non_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """PRJ-15."""
    return df.na.drop(how="any", subset=cols)


def recode(df: DataFrame, col: str, old, new) -> DataFrame:
    """PRJ-16."""
    return df.withColumn(col, F.when(F.col(col) == old, F.lit(new)).otherwise(F.col(col)))


def boolean_text(df: DataFrame, cols: list[str], to_text: bool,
                 yes: str = "Sim", no: str = "Não") -> DataFrame:
    """PRJ-18 with the direction as an explicit argument."""
    if to_text:
        return df.withColumns({c: F.when(F.col(c) == 1, yes).otherwise(no) for c in cols})
    return df.withColumns({c: F.when(F.col(c) == yes, 1).otherwise(0) for c in cols})


def constant_columns(df: DataFrame, value=None) -> list[str]:
    """PRJ-20: names of constant columns, from ONE aggregation pass (a single
    row reaches the driver: the schema decision is a driver decision).
    Default: distinct non-null count = 1; with ``value``: constant AND equal to
    it."""
    aggs = [F.count_distinct(F.col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)]
    if value is not None:
        aggs += [F.min(F.col(c)).alias(f"v{i}") for i, c in enumerate(df.columns)]
    r = df.agg(*aggs).first()
    out = []
    for i, c in enumerate(df.columns):
        if r[f"n{i}"] == 1 and (value is None or r[f"v{i}"] == value):
            out.append(c)
    return out


def bounded_rows(table: DataFrame, limit: int = 1000) -> list:
    """Rows of a parameter table (rules, vocabularies) that an operator turns into
    column expressions.  More than ``limit`` rows is an error, never a cut."""
    rows = table.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a parameter table may have at most {limit} rows")
    return rows


def numeric_columns(df: DataFrame) -> list[str]:
    """PRJ-22."""
    num = ("int", "bigint", "double", "float", "smallint", "tinyint")
    return [c for c, t in df.dtypes if t in num or t.startswith("decimal")]


def split_by_type(df: DataFrame):
    """PRJ-21: (numeric frame without null rows, non-numeric frame)."""
    num = numeric_columns(df)
    other = [c for c in df.columns if c not in num]
    return df.select(*num).na.drop(), df.select(*other)


OPS = {None: lambda c, v: c == v, "eq": lambda c, v: c == v, "gt": lambda c, v: c > v,
       "ge": lambda c, v: c >= v, "lt": lambda c, v: c < v, "le": lambda c, v: c <= v,
       "in": lambda c, v: c.isin(list(v))}


def generic_filter(df: DataFrame, values: list, cols: list[str], ops: list | None = None) -> DataFrame:
    """PRJ-25: parallel lists of value, column, operator; an empty IN list is
    ignored (retail variant)."""
    ops = ops or [None] * len(cols)
    out = df
    for v, c, op in zip(values, cols, ops):
        if op == "in" and not v:
            continue
        out = out.filter(OPS[op](F.col(c), v))
    return out


def dash_filter(df: DataFrame, values: list, cols: list[str], qty_col: str | None = None) -> DataFrame:
    """PRJ-26: '-' means no filter, a list means IN, the quantity column
    means >=."""
    out = df
    for v, c in zip(values, cols):
        if v == "-" or v is None:
            continue
        if isinstance(v, (list, tuple)):
            out = out.filter(F.col(c).isin(list(v)))
        elif c == qty_col:
            out = out.filter(F.col(c) >= v)
        else:
            out = out.filter(F.col(c) == v)
    return out


def first_token(col: str | Column) -> Column:
    """PRJ-36."""
    return F.split(_c(col), " ").getItem(0)


def threshold_grouping(df: DataFrame, group_col: str, column: str, value, threshold: int) -> DataFrame:
    """PRJ-37: groups with fewer than ``threshold`` rows get ``column`` set to
    ``value`` (group sizes by groupBy + join, skew-safe)."""
    sizes = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("_gn"))
    return (df.join(sizes, group_col, "left")
              .withColumn(column, F.when(F.col("_gn") < threshold, F.lit(value)).otherwise(F.col(column)))
              .drop("_gn"))


def keep_frequent(df: DataFrame, col: str, min_count: int) -> DataFrame:
    """PRJ-38 / PRJ-39: keep rows whose value of ``col`` occurs at least
    ``min_count`` times (null values dropped as a pandas groupby does)."""
    ok = (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") >= min_count).select(col))
    return df.join(ok, col, "left_semi")


def dedupe_first(df: DataFrame, subset: list[str], order_cols: list) -> DataFrame:
    """PRJ-44: keep the first row of each subset key in an explicit order
    (``dropDuplicates`` keeps an arbitrary row).  With plain ascending order
    columns this is a ``min_by`` aggregation (partial aggregation map-side,
    so a hot key is reduced before the shuffle); other orders use a
    ``row_number`` window."""
    if all(isinstance(c, str) for c in order_cols):
        rest = [c for c in df.columns if c not in subset]
        picked = df.groupBy(*subset).agg(F.min_by(F.struct(*[F.col(c) for c in rest]),
                                                  F.struct(*[F.col(c) for c in order_cols])).alias("_first"))
        return picked.select(*subset, *[F.col(f"_first.{c}").alias(c) for c in rest]).select(*df.columns)
    w = Window.partitionBy(*subset).orderBy(*[_c(c) for c in order_cols])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def sequence_number(df: DataFrame, order_cols: list, out: str = "idx") -> DataFrame:
    """PRJ-45: a dense 0-based row number in a total order: row_number within
    range partitions plus prefix counts of the partitions.  The range-partitioned
    rows are stored once with their partition number, so the counts and the rows
    are of the same partitioning, whatever the planner samples or coalesces."""
    cols = [_c(c) for c in order_cols]
    s = df.repartitionByRange(*cols).withColumn("_pid", F.spark_partition_id())
    s = materialize(s, "checkpoint")
    w = Window.partitionBy("_pid").orderBy(*cols)
    s = s.withColumn("_lrn", F.row_number().over(w))
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_pc"))
    wo = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_pid", F.coalesce(F.sum("_pc").over(wo), F.lit(0)).alias("_off"))
    return (s.join(F.broadcast(offs), "_pid")
              .withColumn(out, (F.col("_off") + F.col("_lrn") - 1).cast("bigint"))
              .drop("_pid", "_lrn", "_off"))


def null_coverage_count(cols: list[str]) -> Column:
    """PRJ-41: number of null columns among ``cols`` in a row."""
    return reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in cols])
