"""Sources, gates and sinks (SRC-*, GAT-*, SNK-*).

Readers declare schemas and projections so filters and columns reach the
file scan; gates are one-row DataFrames (status data, not prints); sinks
write partitioned Parquet with dynamic partition overwrite, and every
"table update" of the reference (delete, keyed update, upsert) is expressed
as a DataFrame that computes the new table state, so it can be written
atomically to a new location or partition.
"""

from __future__ import annotations

import logging
import uuid
from functools import reduce

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from forecourt.session import scratch_table_path

# ------------------------------------------------------------------ sources


def read_delimited(spark: SparkSession, paths, schema: StructType | str, sep: str = ",", header: bool = True,
                   encoding: str = "utf-8", columns: list[str] | None = None, date_format: str | None = None) -> DataFrame:
    """SRC-01 / SRC-08 / SRC-10: delimited text with a declared schema (no
    inference), optional projection; ``encoding`` covers the latin-1 retry
    case of the reference."""
    r = spark.read.schema(schema).option("sep", sep).option("header", header).option("encoding", encoding)
    if date_format:
        r = r.option("dateFormat", date_format)
    df = r.csv(paths)
    return df.select(*columns) if columns else df


def read_delimited_retry(spark: SparkSession, paths, schema: StructType | str, encodings: tuple[str, ...] = ("utf-8", "iso-8859-1"),
                         **options) -> DataFrame:
    """SRC-01 with the caller's retry: the first encoding that decodes every text,
    else the last.  A byte that an encoding cannot decode reads as U+FFFD."""
    for encoding in encodings[:-1]:
        df = read_delimited(spark, paths, schema, encoding=encoding, **options)
        texts = [F.col(c).contains("\ufffd") for c, t in df.dtypes if t == "string"]
        if not texts or df.where(reduce(lambda a, b: a | b, texts)).isEmpty():
            return df
    return read_delimited(spark, paths, schema, encoding=encodings[-1], **options)


def scan_filter(df: DataFrame, filters: dict | None = None, columns: list[str] | None = None,
                renames: dict[str, str] | None = None) -> DataFrame:
    """SRC-02: AND-ed filters (list value -> IN, scalar -> =), projection and
    source-to-code renames.  Catalyst pushes the filters into the scan."""
    out = df
    for col, v in (filters or {}).items():
        out = out.filter(F.col(col).isin(list(v)) if isinstance(v, (list, tuple, set)) else F.col(col) == v)
    if columns:
        out = out.select(*columns)
    if renames:
        out = out.withColumnsRenamed(renames)
    return out


def run_query(spark: SparkSession, sql: str) -> DataFrame | None:
    """SRC-03: free query over registered views; a failing query returns
    None (the reference logs and returns None)."""
    try:
        return spark.sql(sql)
    except (AnalysisException, ParseException) as e:
        logging.getLogger(__name__).warning("query failed: %s", e)
        return None


def mapping_long(df: DataFrame, key_col: str, value_cols: list[str], rank_col: str | None = None) -> DataFrame:
    """SRC-04 (multi-column mode): per key the distinct non-null values of
    ``value_cols`` as a long (key, value[, rank]) table."""
    long = df.unpivot([key_col] + ([rank_col] if rank_col else []), value_cols, "source_column", "value")
    long = long.filter(F.col("value").isNotNull()).drop("source_column")
    return long.distinct()


def yyyymmdd(c: Column | str) -> Column:
    """SRC-06: integer yyyymmdd to date."""
    c = F.col(c) if isinstance(c, str) else c
    return F.to_date(c.cast("string"), "yyyyMMdd")


def read_fixed_width(spark: SparkSession, path: str, positions: list[int], names: list[str],
                     skip_header: bool = False, skip_tail: bool = False, encoding: str = "utf-8") -> DataFrame:
    """SRC-07: fixed-width text to trimmed columns by character offsets.
    The header line of each file is skipped by the CSV reader's header
    option (only the split at offset 0 drops it); the tail line is the last
    row of the split with the highest start offset of each file."""
    r = (spark.read.option("sep", "\u0001").option("header", skip_header).option("encoding", encoding)
              .option("quote", "").schema("value string").csv(path))
    if skip_tail:
        r = (r.select("value", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"))
              .withColumn("_id", F.monotonically_increasing_id()))
        last = (r.groupBy("_f").agg(F.max(F.struct("_b", "_id")).alias("_m"))
                 .select("_f", F.col("_m._b").alias("_lb"), F.col("_m._id").alias("_lid")))
        r = r.join(last, "_f").filter(~((F.col("_b") == F.col("_lb")) & (F.col("_id") == F.col("_lid")))).select("value")
    cols = [F.trim(F.substring("value", a + 1, b - a)).alias(n) for a, b, n in zip(positions[:-1], positions[1:], names)]
    return r.select(*cols)


def union_frames(frames: list[DataFrame], tag_col: str | None = None, tags: list | None = None) -> DataFrame:
    """SRC-05 / SRC-09: union of frames by name, optionally tagging each
    with a literal (e.g. the platform)."""
    if tag_col:
        frames = [f.withColumn(tag_col, F.lit(t)) for f, t in zip(frames, tags)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def fill_missing_key(df: DataFrame, lookup: DataFrame, on: str, null_col: str, lookup_col: str,
                     prefix: str) -> DataFrame:
    """SRC-12: fill a missing account key from a lookup (prefixed)."""
    lk = lookup.groupBy(on).agg(F.min(lookup_col).alias("_lk"))
    return (df.join(lk, on, "left")
              .withColumn(null_col, F.coalesce(F.col(null_col), F.concat(F.lit(prefix), F.col("_lk").cast("string"))))
              .drop("_lk"))


def cached(spark: SparkSession, name: str, run_date: str, build) -> DataFrame:
    """SRC-13: load-or-recompute a date-stamped cache, as a Parquet table in
    the shared checkpoint folder (never a machine-local path).  ``build`` is
    a zero-argument callable returning the DataFrame to materialise."""
    path = scratch_table_path(spark, f"{name}/date={run_date}")
    if not _written(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# -------------------------------------------------------------------- gates


def volume_gate(df: DataFrame, unit_col: str, minimum: int = 100, last_count: Column | None = None) -> DataFrame:
    """GAT-01: distinct units; without history: below ``minimum`` is an
    error; with the last stored count: fewer = error, equal = warning, more
    = append (status row)."""
    n = df.agg(F.count_distinct(unit_col).alias("units"))
    if last_count is None:
        return n.withColumn("status", F.when(F.col("units") < minimum, "error").otherwise("ok"))
    return n.withColumn("last_units", last_count).withColumn(
        "status", F.when(F.col("units") < F.col("last_units"), "error")
                   .when(F.col("units") == F.col("last_units"), "warning").otherwise("append"))


def freshness_gate(df: DataFrame, date_col: str, run_date: str, days: int) -> DataFrame:
    """GAT-02: 1 when run date - latest stamp >= days (data is stale)."""
    return df.agg(F.max(date_col).alias("last_date")).withColumn(
        "stale", (F.datediff(F.to_date(F.lit(run_date)), F.col("last_date")) >= days).cast("bigint"))


def max_date_or_default(df: DataFrame, date_col: str, default: str = "1960-01-01") -> DataFrame:
    """GAT-03."""
    return df.agg(F.coalesce(F.max(F.to_date(date_col)), F.to_date(F.lit(default))).alias("max_date"))


def latest_run_before(df: DataFrame, date_col: str, run_date: str) -> DataFrame:
    """GAT-04: rows of the latest run strictly before the run date (scalar
    subquery, not a CTE + cross join)."""
    before = df.filter(F.to_date(date_col) < F.to_date(F.lit(run_date)))
    last = before.agg(F.max(F.to_date(date_col))).scalar()
    return before.filter(F.to_date(date_col) == last)


def last_row(df: DataFrame, date_col: str, tie_cols: list[str]) -> DataFrame:
    """GAT-05: the most recent row (max_by over a total order)."""
    return df.agg(F.max_by(F.struct(*df.columns), F.struct(date_col, *tie_cols)).alias("r")).select("r.*")


def watermark(df: DataFrame, date_col: str, current_date: str) -> DataFrame:
    """GAT-06: last and second-last processed dates and whether the run is
    already at the current date (error)."""
    dates = df.select(F.to_date(date_col).alias("d")).distinct()
    last = dates.agg(F.max("d")).scalar()
    r = dates.agg(F.max("d").alias("last_date"), F.max(F.when(F.col("d") < last, F.col("d"))).alias("second_last_date"))
    return r.withColumn("already_processed", (F.col("last_date") >= F.to_date(F.lit(current_date))).cast("bigint"))


# -------------------------------------------------------------------- sinks


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                fmt: str = "parquet") -> None:
    """SNK-01 / SNK-06: write; with ``partition_by`` only the partitions
    present in ``df`` are replaced (dynamic partition overwrite)."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.save(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes the new state of a table under a name of its own and reads it back."""
    path = scratch_table_path(df.sparkSession, f"{name}_{uuid.uuid4().hex[:12]}")
    write_table(df, path)
    return df.sparkSession.read.parquet(path)


def _written(spark: SparkSession, path: str) -> bool:
    """Only a finished write leaves the marker."""
    done = spark._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def append_rows(df: DataFrame, path: str, run_date: str, truncate: bool = False, check_days: int | None = None) -> bool:
    """SNK-02 / SNK-03: stamped rows are appended, with ``truncate`` instead of
    what is there.  With ``check_days`` nothing is written while the latest stamp
    is younger than that (GAT-02).  Tells whether it wrote."""
    spark = df.sparkSession
    if check_days is not None and _written(spark, path):
        if not freshness_gate(spark.read.parquet(path), "Date", run_date, check_days).first()["stale"]:
            return False
    write_table(stamp(df, run_date), path, mode="overwrite" if truncate else "append")
    return True


def stamp(df: DataFrame, run_date: str, col: str = "Date") -> DataFrame:
    """SNK-02 / SNK-03 / SNK-04: date stamp column; the text 'NULL' becomes
    a real null in string columns."""
    out = df.withColumn(col, F.lit(run_date))
    for c, t in out.dtypes:
        if t == "string":
            out = out.withColumn(c, F.nullif(F.col(c), F.lit("NULL")))
    return out


def delete_where(df: DataFrame, filters: dict) -> DataFrame:
    """SNK-05: the table after deleting rows matching AND-ed IN / = filters
    (the kept complement; null-safe)."""
    conds = [F.col(c).isin(list(v)) if isinstance(v, (list, tuple, set)) else F.col(c) == v for c, v in filters.items()]
    hit = reduce(lambda a, b: a & b, conds)
    return df.filter(~F.coalesce(hit, F.lit(False)))


def keyed_update(target: DataFrame, updates: DataFrame, keys: list[str], cols: list[str],
                 set_null: bool = False) -> DataFrame:
    """SNK-07 / SNK-08 / SNK-09: update ``cols`` of the target from the
    updates matched on keys.  Of several updates of a key one whole row is
    taken, the smallest in the order of ``cols``.  A null in it leaves the old
    value (SNK-07, 08) or, with ``set_null``, replaces it (SNK-09)."""
    u = updates.groupBy(*keys).agg(F.min(F.struct(*cols)).alias("_u"))
    out = target.join(u, keys, "left")
    kept = F.col("_u").isNull() if set_null else F.lit(True)
    new = {c: F.coalesce(F.col(f"_u.{c}"), F.when(kept, F.col(c))) for c in cols}
    return out.withColumns(new).drop("_u")


def upsert(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """SNK-26 / SNK-27: keyed replace (delete + insert): rows of the target
    whose key is in the updates are replaced by the update rows."""
    return target.join(updates.select(*keys).distinct(), keys, "left_anti").unionByName(updates)


def mapping_rows(mapping: DataFrame, key_col: str, list_col: str) -> DataFrame:
    """SNK-11: dictionary of lists -> (Original_Value, Mapped_Value) rows."""
    return mapping.select(F.explode(list_col).alias("Original_Value"), F.col(key_col).alias("Mapped_Value"))


def confusion_table(pairs: DataFrame, actual: str, predicted: str, classes: list[str]) -> DataFrame:
    """SNK-12 / MLX-28: confusion matrix with one column per class (bounded
    class list), a row total and the actual class as column ``Actual``."""
    m = pairs.groupBy(F.col(actual).alias("Actual")).pivot(predicted, classes).agg(F.count(F.lit(1)))
    m = m.na.fill(0, subset=classes)
    return m.withColumn("Totals", reduce(lambda a, b: a + b, [F.col(c) for c in classes]))


def cast_output(df: DataFrame, renames: dict[str, str], to_string: bool = True, extra: dict | None = None) -> DataFrame:
    """SNK-13..20: final projection: optional constant columns, rename to
    the target names, everything as text."""
    out = df
    for c, v in (extra or {}).items():
        out = out.withColumn(c, F.lit(v))
    out = out.select(*[F.col(c).alias(renames.get(c, c)) for c in out.columns])
    if to_string:
        out = out.select(*[F.col(c).cast("string").alias(c) for c in out.columns])
    return out
