"""Window operators (WIN-*) and top-k helpers (SRT-*).

Ordered windows always end their ORDER BY with a unique key (Q-03).  Where a
single group can be very large (a hot configuration), running aggregates are
computed as a chunked prefix scan: the window is partitioned by (group, chunk)
where chunk is a monotone coarsening of the leading order column, per-chunk
totals are prefix-summed over the (small) chunk table, and the offsets are
joined back.  A hot group is then spread over as many tasks as it has chunks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.session import free_shuffles, materialize

#: Rows of a table of offsets up to which it is broadcast.
FEW = 100_000
UNB = Window.unboundedPreceding
CUR = Window.currentRow


def _cols(cs):
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def chunked_running(df: DataFrame, group_cols: list[str], order_cols: list,
                    chunk: Column | None, sum_cols: list[str], lag_cols: list[str],
                    prefix: str = "_r", offsets: DataFrame | None = None) -> DataFrame:
    """Adds for every row, within its group in ``order_cols`` order:
      {prefix}_rn          1-based position in the group
      {prefix}_cum_<c>     running sum of c (current row included)
      {prefix}_lag_<c>     value of c on the previous row (null on the first)
    computed per (group, chunk) and stitched with per-chunk offsets.  Rows with
    a null group key form a group of their own, and null order values come last;
    no row is lost.  ``offsets``: those of ``chunk_offsets``, if they are stored."""
    chunk = F.lit(0) if chunk is None else chunk
    order_cols = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_cols]
    g = list(group_cols)
    gc = g + ["_chunk"]
    x = df.withColumn("_chunk", chunk)
    w = Window.partitionBy(*gc).orderBy(*_cols(order_cols))
    x = x.withColumn("_lrn", F.row_number().over(w))
    for c in sum_cols:
        x = x.withColumn(f"_lcum_{c}", F.sum(c).over(w.rowsBetween(UNB, CUR)))
    for c in lag_cols:
        x = x.withColumn(f"_llag_{c}", F.lag(c).over(w))
    if offsets is None:
        offsets = _offsets(x, g, F.col("_lrn"), sum_cols, lag_cols)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(gc)])
    x = x.join(offsets, same)
    out = x.withColumn(f"{prefix}_rn", (F.col("_off_n") + F.col("_lrn")).cast("bigint"))
    for c in sum_cols:
        out = out.withColumn(f"{prefix}_cum_{c}",
                             F.coalesce(F.col(f"_off_{c}"), F.lit(0)) + F.col(f"_lcum_{c}"))
    for c in lag_cols:
        out = out.withColumn(f"{prefix}_lag_{c}",
                             F.when(F.col("_lrn") == 1, F.col("_prev_last")[c])
                              .otherwise(F.col(f"_llag_{c}")))
    drop = ["_chunk", "_lrn", "_cn", "_off_n", "_prev_last", *[f"_k{i}" for i in range(len(gc))]] + \
        [f"_lcum_{c}" for c in sum_cols] + [f"_off_{c}" for c in sum_cols] + \
        [f"_llag_{c}" for c in lag_cols]
    return out.drop(*drop)


def _offsets(x: DataFrame, g: list[str], at: Column, sum_cols: list[str], lag_cols: list[str]) -> DataFrame:
    """A row per (group, chunk): what the chunks before it hold; ``at`` orders the rows of a chunk."""
    gc = [*g, "_chunk"]
    last = F.max_by(F.struct(*[F.col(c).alias(c) for c in lag_cols] or [F.lit(0).alias("_z")]), at)
    per_chunk = x.groupBy(*gc).agg(F.count(F.lit(1)).alias("_cn"),
                                   *[F.sum(c).alias(f"_cs_{c}") for c in sum_cols],
                                   last.alias("_last"))
    wc = Window.partitionBy(*g).orderBy(F.col("_chunk").asc_nulls_last())
    before = wc.rowsBetween(UNB, -1)
    return per_chunk.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(gc)],
        F.coalesce(F.sum("_cn").over(before), F.lit(0)).alias("_off_n"),
        *[F.sum(f"_cs_{c}").over(before).alias(f"_off_{c}") for c in sum_cols],
        F.lag("_last").over(wc).alias("_prev_last"))


def chunk_offsets(df: DataFrame, group_cols: list[str], order_cols: list[str], chunk: Column | None, sum_cols: list[str],
                  lag_cols: list[str]) -> DataFrame:
    """Offsets for ``chunked_running`` by aggregation alone: the rows are not sorted or shuffled for them."""
    x = df.withColumn("_chunk", F.lit(0) if chunk is None else chunk)
    at = F.struct(*[e for c in order_cols for e in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))])
    return _offsets(x, list(group_cols), at, sum_cols, lag_cols)


def previous_sales_features(df: DataFrame, group_cols: list[str], order_cols: list,
                            chunk: Column | None = None, score: str = "new_score",
                            margin: str = "margin_pct", days: str = "stock_days",
                            source: DataFrame | None = None) -> DataFrame:
    """WIN-01: per configuration, ordered by sale date:
    prev_sales_check, number_prev_sales, last_score / last_margin /
    last_stock_days (lag, first row 0), average_score_dynamic (running mean of
    the score, first row forced to 0), its population std over the group and
    the lag of both, and group mean / min / max / q1 / median / q3 of the score.
    Groups of a single row get 0 in every feature (Q-11).

    The offsets of the chunks are stored first (``df`` is read for them: pass a
    materialised base), then the group statistics.  If the offsets are few, they and the
    statistics, which are fewer, are broadcast, and the rows are shuffled for the window only.
    ``source`` (default ``df``): the same rows for offsets and statistics, where ``df`` deals
    whole rows by group and chunk itself."""
    g = list(group_cols)
    scan = (chunk, [score], [score, margin, days])
    few, stored = (lambda t: t), None
    if all(isinstance(c, str) for c in order_cols):
        stored = materialize(chunk_offsets(df if source is None else source, g, order_cols, *scan), "checkpoint")
        few = F.broadcast if stored.count() <= FEW else few
        stored = few(stored)
    rn = F.col("_p_rn")
    cum = F.col(f"_p_cum_{score}")

    def running(rows):
        x = chunked_running(rows, g, order_cols, *scan, prefix="_p", offsets=stored)
        return (x.withColumn("average_score_dynamic",
                             F.when(rn == 1, F.lit(0.0)).otherwise(cum / rn))
                 .withColumn("prev_average_score_dynamic",
                             F.when(rn <= 2, F.lit(0.0)).otherwise((cum - F.col(score)) / (rn - 1))))
    x = running(df)
    narrow = x if source is None else running(source)
    stats = narrow.groupBy(*g).agg(
        F.count(F.lit(1)).alias("_n"),
        F.stddev_pop("average_score_dynamic").alias("_std"),
        F.avg(score).alias("_avg"), F.min(score).cast("double").alias("_min"),
        F.max(score).cast("double").alias("_max"),
        F.percentile(score, 0.75).alias("_q3"), F.percentile(score, 0.5).alias("_q2"),
        F.percentile(score, 0.25).alias("_q1"))
    if stored is not None:  # the shuffle they are made from ends before that of the whole rows
        stats = materialize(stats, "checkpoint")
        free_shuffles(df.sparkSession)
    x = x.join(few(stats), on=g, how="inner")
    multi = F.col("_n") > 1

    def z(e):
        return F.when(multi, e).otherwise(F.lit(0.0))

    return (x.select(
        *[c for c in df.columns],
        F.when(multi & (rn > 1), 1).otherwise(0).cast("bigint").alias("prev_sales_check"),
        F.when(multi, rn - 1).otherwise(0).cast("bigint").alias("number_prev_sales"),
        z(F.coalesce(F.col(f"_p_lag_{score}").cast("double"), F.lit(0.0))).alias("last_score"),
        z(F.coalesce(F.col(f"_p_lag_{margin}").cast("double"), F.lit(0.0))).alias("last_margin"),
        z(F.coalesce(F.col(f"_p_lag_{days}").cast("double"), F.lit(0.0))).alias("last_stock_days"),
        z(F.col("average_score_dynamic")).alias("average_score_dynamic"),
        z(F.col("_std")).alias("average_score_dynamic_std"),
        z(F.col("prev_average_score_dynamic")).alias("prev_average_score_dynamic"),
        z(F.when(rn > 1, F.col("_std")).otherwise(0.0)).alias("prev_average_score_dynamic_std"),
        z(F.col("_avg")).alias("average_score_global"),
        z(F.col("_min")).alias("min_score_global"),
        z(F.col("_max")).alias("max_score_global"),
        z(F.col("_q3")).alias("q3_score_global"),
        z(F.col("_q2")).alias("median_score_global"),
        z(F.col("_q1")).alias("q1_score_global")))


def month_window_counts(df: DataFrame, group_cols: list[str], ts_col: str, order_cols: list,
                        months: int = 6, chunk: Column | None = None) -> DataFrame:
    """WIN-03: rolling calendar-month counts per group.  For a row at time t:
      sales_month-k      rows with time strictly inside (t - k months, t - (k-1) months)
      sales_month-k_cum  rows with time > t - k months (no upper bound)
    plus prev_sales_check / number_prev_sales; single-row groups get 0
    everywhere (Q-16: rows exactly on a month boundary fall in no bucket).

    The RANGE frames run on the per-(group, time) count table, not on rows:
    every row with the same time has the same counts, so the window input
    is bounded by the number of distinct times per group, whatever the skew."""
    g = list(group_cols)
    daily = df.groupBy(*g, ts_col).agg(F.count(F.lit(1)).alias("_c"))
    part = ", ".join(f"`{c}`" for c in g)

    def frame(lo, hi):
        lo_s = "UNBOUNDED PRECEDING" if lo is None else (
            "CURRENT ROW" if lo == 0 else f"INTERVAL '{lo}' MONTH PRECEDING")
        hi_s = "CURRENT ROW" if hi == 0 else f"INTERVAL '{hi}' MONTH PRECEDING"
        return (f"coalesce(sum(_c) OVER (PARTITION BY {part} ORDER BY `{ts_col}` "
                f"RANGE BETWEEN {lo_s} AND {hi_s}), 0)")

    exprs = [f"sum(_c) OVER (PARTITION BY {part}) AS _n"]
    for k in range(1, months + 1):
        exprs.append(f"{frame(k, k - 1)} - {frame(k, k)} - {frame(k - 1, k - 1)} AS `_m{k}`")
        exprs.append(f"sum(_c) OVER (PARTITION BY {part}) - {frame(None, k)} AS `_mc{k}`")
    counts = daily.selectExpr(*g, ts_col, *exprs)
    rows = chunked_running(df, g, order_cols, chunk, sum_cols=[], lag_cols=[], prefix="_w")
    out = rows.join(counts, on=[*g, ts_col], how="inner")
    multi = F.col("_n") > 1
    cols = [F.when(multi & (F.col("_w_rn") > 1), 1).otherwise(0).cast("bigint").alias("prev_sales_check"),
            F.when(multi, F.col("_w_rn") - 1).otherwise(0).cast("bigint").alias("number_prev_sales")]
    for k in range(1, months + 1):
        cols.append(F.when(multi, F.col(f"_m{k}")).otherwise(0).cast("bigint").alias(f"sales_month-{k}"))
    for k in range(1, months + 1):
        cols.append(F.when(multi, F.col(f"_mc{k}")).otherwise(0).cast("bigint").alias(f"sales_month-{k}_cum"))
    return out.select(*df.columns, *cols)


def net_negative_movements(df: DataFrame, order_col: str, date_col: str, qty: str, value: str,
                           cost: str, margin: str, tie_cols: list, mode: str = "sales") -> DataFrame:
    """WIN-10: netting of reversed movements within an order.

    sales mode: every negative-quantity row is removed; a positive row with
    the same order, date and exactly opposite quantity, value, cost and margin
    is removed once per negative (the first ones in ``tie_cols`` order), i.e.
    per match key min(#negatives, #positives) positives go.
    purchases mode (match on order, quantity, cost and part given as
    ``value``): only the latest matching positive goes, once per key.

    One sorted pass over the rows by match key, negatives first, so the rows are
    shuffled once (not at all if they are already dealt by ``order_col``); a key
    with a null matches nothing."""
    negative = F.col(qty) < 0

    def matched(c, by):
        return F.when(negative, by(F.col(c))).otherwise(F.col(c))
    if mode == "sales":
        keys = [F.col(order_col), F.col(date_col), *[matched(c, lambda x: -x) for c in (qty, value, cost, margin)]]
        order = _cols(tie_cols)
    else:
        keys = [F.col(order_col), matched(qty, F.abs), matched(cost, F.abs), F.col(value)]
        order = [F.col(date_col).desc(), *_cols(tie_cols)]
    w = (Window.partitionBy(*keys).orderBy(negative.desc(), *order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    x = (df.filter(F.col(qty).isNotNull())
           .withColumns({"_rn": F.count(F.lit(1)).over(w), "_nneg": F.count(F.when(negative, 1)).over(w)})
           .filter(~negative))
    gone = F.col("_nneg") if mode == "sales" else F.least("_nneg", F.lit(1))
    alone = reduce(lambda p, q: p | q, [k.isNull() for k in keys])
    return x.filter(alone | (F.col("_rn") - F.col("_nneg") > gone)).select(*df.columns)


def diff_prev(df: DataFrame, keys: list[str], order_cols: list, col: str, out: str,
              chunk: Column | None = None) -> DataFrame:
    """WIN-04: difference to the previous value in the group, first = 0.
    With ``chunk`` (a monotone coarsening of the leading order column) the
    lag runs as a chunked scan, so one long history is split over tasks."""
    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(*_cols(order_cols))
        return df.withColumn(out, F.coalesce(F.col(col) - F.lag(col).over(w), F.lit(0).cast(df.schema[col].dataType)))
    x = chunked_running(df, keys, order_cols, chunk, [], [col], "_d")
    return (x.withColumn(out, F.coalesce(F.col(col) - F.col(f"_d_lag_{col}"), F.lit(0).cast(df.schema[col].dataType)))
             .drop("_d_rn", f"_d_lag_{col}"))


def keep_group_max(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """WIN-05: keep rows equal to their group's maximum (ties kept), as a
    groupBy + join (partial aggregation, skew-safe)."""
    mx = df.groupBy(*keys).agg(F.max(col).alias("_mx"))
    return df.join(mx, keys, "inner").filter(F.col(col) == F.col("_mx")).drop("_mx")


def _positions(df, keys, order_cols, date_col):
    """Row position per group in ``order_cols`` order, as a chunked scan
    (chunk = month of the leading date)."""
    x = chunked_running(df, keys, order_cols, F.trunc(F.col(date_col), "month"), [], [], "_q")
    return x.withColumnRenamed("_q_rn", "_pos")


def _repeated_reading_groups(df, keys, order_cols, kms, date_col):
    x = _positions(df, keys, order_cols, date_col)
    grp = (x.groupBy(*keys, kms)
             .agg(F.count(F.lit(1)).alias("_cnt"), F.min("_pos").alias("_pmin"), F.max("_pos").alias("_pmax"),
                  F.min(date_col).alias("_dmin"), F.max(date_col).alias("_dmax"),
                  F.max_by(date_col, "_pos").alias("_dlast"))
             .filter((F.col("_cnt") > 1) & (F.col("_pmax") - F.col("_pmin") + 1 > F.col("_cnt"))))
    return x, grp


def mileage_repair_between(df: DataFrame, keys: list[str], order_cols: list, kms: str = "kms",
                           date_col: str = "day") -> DataFrame:
    """WIN-06 (solution 1): for a reading repeated at non-adjacent positions,
    delete the readings dated strictly between its first and last date that
    are lower than it.  Range anti join on the vehicle key; the repeated
    groups side is tiny (only inconsistent histories produce it)."""
    x, grp = _repeated_reading_groups(df, keys, order_cols, kms, date_col)
    g = grp.select(*[F.col(k).alias(f"_g_{k}") for k in keys], F.col(kms).alias("_gk"), "_dmin", "_dmax")
    cond = [F.col(k) == F.col(f"_g_{k}") for k in keys] + [
        F.col(date_col) > F.col("_dmin"), F.col(date_col) < F.col("_dmax"), F.col(kms) < F.col("_gk")]
    from functools import reduce as _r
    return x.join(g, _r(lambda a, b: a & b, cond), "left_anti").drop("_pos")


def mileage_repair_last_pair(df: DataFrame, keys: list[str], order_cols: list, kms: str = "kms",
                             date_col: str = "day") -> DataFrame:
    """WIN-07 (solution 2): for the same situation take the last two equal
    readings, find the first date strictly between them, and delete every
    reading from the first equal reading's date up to (excluding) that date.
    No reading strictly between the last two means no deletion (Q-12)."""
    from functools import reduce as _r
    x = _positions(df, keys, order_cols, date_col)
    # last two equal readings by position: two aggregations (partial,
    # skew-safe) instead of a descending row_number per (vehicle, reading)
    g1 = (x.groupBy(*keys, kms)
           .agg(F.count(F.lit(1)).alias("_cnt"), F.min("_pos").alias("_pmin"), F.max("_pos").alias("_pmax"),
                F.min(date_col).alias("_dmin"), F.max_by(date_col, "_pos").alias("_db"))
           .filter((F.col("_cnt") > 1) & (F.col("_pmax") - F.col("_pmin") + 1 > F.col("_cnt"))))
    g2 = (x.join(g1.select(*keys, kms, "_pmax"), [*keys, kms]).filter(F.col("_pos") < F.col("_pmax"))
           .groupBy(*keys, kms).agg(F.max_by(date_col, "_pos").alias("_da")))
    grp = g1.join(g2, [*keys, kms])
    g = grp.select(*[F.col(k).alias(f"_g_{k}") for k in keys], F.col(kms).alias("_gk"), "_dmin", "_da", "_db")
    between = x.join(g, _r(lambda a, b: a & b, [F.col(k) == F.col(f"_g_{k}") for k in keys] + [
        F.col(date_col) > F.col("_da"), F.col(date_col) < F.col("_db")]), "inner")
    cut = between.groupBy(*[f"_g_{k}" for k in keys], "_gk", "_dmin").agg(F.min(date_col).alias("_dcut"))
    cond = [F.col(k) == F.col(f"_g_{k}") for k in keys] + [
        F.col(date_col) >= F.col("_dmin"), F.col(date_col) < F.col("_dcut")]
    return x.join(cut, _r(lambda a, b: a & b, cond), "left_anti").drop("_pos")


def group_fill(df: DataFrame, keys: list[str], order_cols: list[str], cols: list[str],
               ffill: bool = True, bfill: bool = True, zero: bool = True, chunk: Column | None = None) -> DataFrame:
    """WIN-08 / WIN-09: forward fill, then back fill, then 0 within a group
    (each step optional, for the three column classes of the ledger).

    A prefix scan of "last value": windows fill within (group, chunk), where
    ``chunk`` is a monotone coarsening of the leading order column; the last
    and first values of the chunks are scanned on the small chunk table and
    joined back, so a hot group is as many tasks as it has chunks.  Null keys
    are a group, null order values come first."""
    gc = [*keys, "_chunk"]
    x = df.withColumn("_chunk", F.lit(0) if chunk is None else chunk)
    w = Window.partitionBy(*gc).orderBy(*order_cols).rowsBetween(UNB, CUR)
    # back fill = running "last non-null" in DESCENDING order: a streaming
    # running frame, where a current..unbounded-following frame would be
    # re-evaluated for every row (quadratic on a long group)
    back = Window.partitionBy(*gc).orderBy(*[F.col(c).desc() for c in order_cols]).rowsBetween(UNB, CUR)
    at = F.struct(*order_cols)
    ends = x.groupBy(*gc).agg(*[f(c, F.when(F.col(c).isNotNull(), at)).alias(f"_{n}_{c}") for c in cols for n, f in (("last", F.max_by), ("first", F.min_by))])
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(UNB, -1)
    after = Window.partitionBy(*keys).orderBy(F.desc("_chunk")).rowsBetween(UNB, -1)
    ends = ends.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(gc)],
                       *[F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_prev_{c}") for c in cols],
                       *[F.last(f"_first_{c}", ignorenulls=True).over(after).alias(f"_next_{c}") for c in cols])
    x = x.withColumns({f"_f_{c}": F.last(c, ignorenulls=True).over(w) for c in cols} | {f"_b_{c}": F.last(c, ignorenulls=True).over(back) for c in cols})
    x = x.join(ends, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(gc)]))
    out = {}
    for c in cols:
        e = [F.col(c)]
        e += [F.col(f"_f_{c}"), F.col(f"_prev_{c}")] if ffill else []
        e += [F.col(f"_b_{c}"), F.col(f"_next_{c}")] if bfill else []
        e += [F.lit(0).cast(df.schema[c].dataType)] if zero else []
        out[c] = F.coalesce(*e)
    return x.withColumns(out).select(*df.columns)


def quantity_share(df: DataFrame, group_cols: list[str], score: str, order_size: int,
                   order_cols: list, repair: bool = True, out: str = "quantity") -> DataFrame:
    """WIN-16 / WIN-17: order quantity by score share, rounded half-even.
    With ``repair`` the shortage is added to the first row (best score) and
    the excess is taken from the last positive row; rows left without a
    positive quantity are dropped."""
    g = list(group_cols)
    wg = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))
    share = F.try_divide(F.col(score), F.sum(score).over(wg)) * order_size
    x = df.withColumn("_q", F.bround(share.cast("decimal(38,10)"), 0).cast("double"))
    if not repair:
        return x.withColumn(out, F.col("_q").cast("bigint")).drop("_q")
    wo = (Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))).orderBy(*_cols(order_cols))
    x = (x.withColumn("_tot", F.sum("_q").over(wg))
          .withColumn("_rn", F.row_number().over(wo))
          .withColumn("_lastpos", F.max(F.when(F.col("_q") > 0, F.col("_rn"))).over(wg)))
    diff = F.lit(order_size) - F.col("_tot")
    q = (F.col("_q") + F.when((diff > 0) & (F.col("_rn") == 1), diff).otherwise(0)
         + F.when((diff < 0) & (F.col("_rn") == F.col("_lastpos")), diff).otherwise(0))
    return (x.withColumn(out, q.cast("bigint")).filter(F.col(out) > 0)
             .drop("_q", "_tot", "_rn", "_lastpos"))


#: Rows of one block of a sorted group; neighbours' rows are doubled at its edges.
BLOCK_ROWS = 10_000


def _neighbour_arrays(x: DataFrame, w, col: str, K: int, name: str) -> DataFrame:
    before = F.array(*[F.lag(col, j).over(w) for j in range(1, K + 1)])
    after = F.array(*[F.lead(col, j).over(w) for j in range(1, K + 1)])
    return x.withColumn(f"{name}_b", before).withColumn(f"{name}_a", after)


def outlier_scores_1d(df: DataFrame, keys: list[str], value: str, tie: str, k_knn: int = 3, k_lof: int = 10,
                      contamination: float = 0.1, chunk: Column | None = None) -> DataFrame:
    """WIN-18: per group, 1-D neighbour outlier scores of ``value``:
    knn_mean / knn_median = mean / median distance to the k_knn nearest
    other points; lof = local outlier factor with k_lof neighbours (fewer
    when the group is smaller); each score is flagged above its group's
    (1 - contamination) percentile.  In one dimension the k nearest
    neighbours are within k sorted positions on either side, so every pass
    is a bounded lag/lead window (no pairs are formed); ties in distance go
    to the neighbour earlier in the sorted order.  A reading alone in its group
    has null scores.

    Positions come from a chunked scan (``chunk``: a monotone coarsening of the
    value) and the sorted group is cut into blocks of rows.  The three passes
    look K rows aside each, so a block also gets 3 K rows of its neighbours;
    a hot group is as many tasks as it has blocks."""
    K = max(k_knn, k_lof)
    halo = 3 * K
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    x = chunked_running(df, keys, [value, tie], chunk, [], [], "_s").withColumnRenamed("_s_rn", "_pos").join(sizes, keys)
    own = F.floor((F.col("_pos") - 1) / BLOCK_ROWS)
    reach = F.sequence(F.floor((F.col("_pos") - 1 - halo) / BLOCK_ROWS), F.floor((F.col("_pos") - 1 + halo) / BLOCK_ROWS))
    x = x.withColumn("_own", own).withColumn("_block", F.explode(reach)).where((F.col("_block") >= 0) & (F.col("_block") <= F.floor((F.col("_n") - 1) / BLOCK_ROWS)))
    w = Window.partitionBy(*keys, "_block").orderBy("_pos")
    x = _neighbour_arrays(x, w, value, K, "_v")
    cands = F.filter(F.concat(
        F.transform(F.col("_v_b"), lambda v, i: F.struct(F.abs(F.col(value) - v).alias("d"), (F.col("_pos") - i - 1).alias("npos"), (-(i + 1)).alias("off"))),
        F.transform(F.col("_v_a"), lambda v, i: F.struct(F.abs(F.col(value) - v).alias("d"), (F.col("_pos") + i + 1).alias("npos"), (i + 1).alias("off")))),
        lambda s: s["d"].isNotNull())
    x = x.withColumn("_c", F.sort_array(cands))
    kk = F.least(F.lit(k_lof), F.col("_n") - 1)
    x = (x.withColumn("_knn", F.slice("_c", 1, k_knn))
          .withColumn("_lofn", F.slice("_c", 1, F.greatest(kk, F.lit(1))))
          .withColumn("_kdist", F.get("_lofn", F.size("_lofn") - 1)["d"]))
    x = _neighbour_arrays(x, w, "_kdist", K, "_k")

    def at(arr_b, arr_a, off):
        return F.when(off < 0, F.element_at(F.col(arr_b), -off)).otherwise(F.element_at(F.col(arr_a), off))

    reach = F.transform("_lofn", lambda s: F.greatest(at("_k_b", "_k_a", s["off"]), s["d"]))
    x = x.withColumn("_lrd", 1 / (F.try_divide(F.aggregate(reach, F.lit(0.0), lambda a, b: a + b), F.size(reach)) + 1e-10))
    x = _neighbour_arrays(x, w, "_lrd", K, "_l")
    lrd_o = F.transform("_lofn", lambda s: at("_l_b", "_l_a", s["off"]))
    x = x.withColumn("lof", F.try_divide(F.aggregate(lrd_o, F.lit(0.0), lambda a, b: a + b), F.size(lrd_o)) / F.col("_lrd"))
    dists = F.transform("_knn", lambda s: s["d"])
    x = (x.withColumn("knn_mean", F.try_divide(F.aggregate(dists, F.lit(0.0), lambda a, b: a + b), F.size(dists)))
          .withColumn("_sd", F.array_sort(dists)).withColumn("_h", (F.size(dists) / 2).cast("int"))
          .withColumn("knn_median", F.when(F.size(dists) % 2 == 1, F.get("_sd", F.col("_h")))
                      .otherwise((F.get("_sd", F.col("_h") - 1) + F.get("_sd", F.col("_h"))) / 2)))
    x = x.where("_block = _own")
    q = 1 - contamination
    th = x.groupBy(*keys).agg(*[F.percentile(c, q).alias(f"_t_{c}") for c in ("knn_mean", "knn_median", "lof")])
    x = x.join(th, keys)
    # scores are compared with their group's percentile at the reported
    # precision (6 decimals, LOF 3: it can reach 1e10 when reach distances
    # are 0), so float noise cannot flip a score equal to the threshold
    from forecourt.functions.fmt import rnd
    for c, k in (("knn_mean", 6), ("knn_median", 6), ("lof", 3)):
        x = x.withColumn(f"{c}_outlier", (rnd(F.col(c), k) > rnd(F.col(f"_t_{c}"), k)).cast("bigint"))
    return x.drop(*[c for c in x.columns if c.startswith("_")])


def deviation_scores(df: DataFrame, keys: list[str], value: str, contamination: float = 0.1) -> DataFrame:
    """WIN-20: deviation-based (LMDD) score with single-element exception
    sets and the variance as dissimilarity: SF(x) = (n - 1) * (var(I) -
    var(I - {x})), exact from the group's sums (no iteration, no Python);
    flagged above the group's (1 - contamination) percentile."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s1"),
                              F.sum(F.col(value) * F.col(value)).alias("_s2"))
    x = df.join(g, keys)
    n, s1, s2, v = F.col("_n"), F.col("_s1"), F.col("_s2"), F.col(value).cast("double")
    var_all = s2 / n - (s1 / n) * (s1 / n)
    var_wo = (s2 - v * v) / (n - 1) - ((s1 - v) / (n - 1)) * ((s1 - v) / (n - 1))
    x = x.withColumn("lmdd", F.when(n > 1, (n - 1) * (var_all - var_wo)))
    th = x.groupBy(*keys).agg(F.percentile("lmdd", 1 - contamination).alias("_t"))
    from forecourt.functions.fmt import rnd
    return (x.join(th, keys).withColumn("lmdd_outlier", (rnd(F.col("lmdd"), 6) > rnd(F.col("_t"), 6)).cast("bigint"))
             .drop("_n", "_s1", "_s2", "_t"))
