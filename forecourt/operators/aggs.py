"""Aggregation operators (AGG-*).

Whole-group values attached to rows are computed with ``groupBy`` (partial
aggregation map-side, so a hot key costs one partial row per task) and joined
back, instead of an unbounded window that would buffer a hot group in one
task.  The joined-back side is one row per group; AQE turns the join into a
broadcast when the measured size is small and keeps a shuffle join (with
skew splitting on the row side) otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.fmt import rnd
from forecourt.session import materialize, stored_small

#: Rows of the finest grain up to which the grains are broadcast.
FEW = 100_000
#: Most frequent words of a group whose bigrams bound the others (AGG-19).
HEADS = 50


def attach_group_agg(df: DataFrame, keys: list[str], aggs: list[Column],
                     keep_null_keys: bool = False) -> DataFrame:
    """Aggregate by ``keys`` and attach the values to every row of the group.
    Rows whose key is null are dropped like a pandas groupby does, unless
    ``keep_null_keys``."""
    agg = df.groupBy(*keys).agg(*aggs)
    if keep_null_keys:
        cond = [df[k].eqNullSafe(agg[k]) for k in keys]
        joined = df.join(agg, on=cond, how="left")
        return joined.select(df["*"], *[agg[c] for c in agg.columns if c not in keys])
    return df.join(agg, on=keys, how="inner")


def total_price(df: DataFrame, unit: str, cost: str, out: str = "price_total") -> DataFrame:
    """AGG-01: total cost per unit attached to each of its rows."""
    return attach_group_agg(df, [unit], [F.sum(cost).alias(out)])


GRAIN_MEASURES = (
    ("average_percentage_margin", "margin_pct"),
    ("average_stock_days", "stock_days"),
    ("average_score", "new_score"),
    ("average_score_euros", "score_euros"),
)


def multi_grain_averages(df: DataFrame, base: list[str], grains: list[tuple[str, list[str]]],
                         measures=GRAIN_MEASURES, decimals: int | None = 4, source: DataFrame | None = None) -> DataFrame:
    """AGG-03: for each grain (tag, extra key columns) = base + extra, attach
    nr_cars_sold<tag> and the mean of each measure (rounded half-even) to
    every row.  Rows are aggregated once, to sums and counts at the finest grain
    (base and all extras); the grains are rolled up from that small table, which is
    stored, so no row is expanded once per grain; up to ``FEW`` rows are broadcast.
    ``source`` (default ``df``) is the frame aggregated - pass the
    materialised base when ``df`` is an expensive derivation of it, so the
    aggregation does not re-run that derivation."""
    key_cols = list(dict.fromkeys([*base, *(c for _, extra in grains for c in extra)]))
    src = df if source is None else source
    fine = src.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("_n"),
                                      *[f(c).alias(f"_{t}{i}") for i, (_, c) in enumerate(measures) for t, f in (("s", F.sum), ("c", F.count))])
    fine = materialize(fine, "checkpoint")
    few = F.broadcast if fine.count() <= FEW else lambda t: t  # no grain has more rows
    out = df
    for tag, extra in grains:
        keys = [*base, *extra]
        mean = [F.try_divide(F.sum(f"_s{i}"), F.sum(f"_c{i}")) for i in range(len(measures))]
        part = fine.groupBy(*keys).agg(F.sum("_n").cast("bigint").alias(f"nr_cars_sold{tag}"),
                                       *[(rnd(m, decimals) if decimals is not None else m).alias(f"{name}{tag}") for m, (name, _) in zip(mean, measures)])
        out = out.join(few(part), on=keys, how="inner")
    return out


def mode_value(col: str) -> Column:
    """Deterministic mode: highest count, then the smallest value."""
    return F.mode(F.col(col), True)


def column_profile(df: DataFrame, kind: str = "null") -> DataFrame:
    """AGG-10 / AGG-11 / AGG-12: one aggregation pass over all columns, then
    unpivoted to (column_name, column_type, n, pct).  kind: null | pos_inf |
    neg_inf | zero."""
    def hit(c, t):
        if kind == "null":
            return F.col(c).isNull()
        numeric = t in ("double", "float") or t.startswith("decimal") or t in ("int", "bigint", "smallint")
        if not numeric:
            return F.lit(False)
        if kind == "pos_inf":
            return F.col(c) == F.lit(float("inf"))
        if kind == "neg_inf":
            return F.col(c) == F.lit(float("-inf"))
        return F.col(c) == 0
    cols = df.dtypes
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.sum(F.coalesce(hit(c, t), F.lit(False)).cast("bigint")).alias(f"_h{i}") for i, (c, t) in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("column_type"),
                              F.col(f"_h{i}").alias("n")) for i, (c, t) in enumerate(cols)])
    return (agg.select("_rows", F.explode(rows).alias("r"))
               .select("r.column_name", "r.column_type", F.col("r.n").cast("bigint").alias("n"),
                       (F.col("r.n") / F.col("_rows") * 100).alias("pct")))


def relative_histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """AGG-13: equal-width histogram between min and max (last bin closed),
    as relative frequency in percent, with the bin centres.  Bounds and count
    are scalar subqueries (computed once, no join)."""
    lo = df.agg(F.min(col)).scalar()
    hi = df.agg(F.max(col)).scalar()
    n = df.agg(F.count(col)).scalar()
    width = (hi - lo) / bins
    b = F.least(F.floor((F.col(col) - lo) / (hi - lo) * bins), F.lit(bins - 1))
    x = df.filter(F.col(col).isNotNull()).withColumn("bin", F.when(hi == lo, F.lit(0)).otherwise(b).cast("bigint"))
    return (x.groupBy("bin").agg(F.count(F.lit(1)).alias("cnt"))
             .select("bin", (lo + (F.col("bin") + 0.5) * width).alias("bin_center"),
                     (F.col("cnt") * 100.0 / n).alias("rel_freq")))


def empirical_cdf(df: DataFrame, col: str, tie_cols: list) -> DataFrame:
    """AGG-13: sorted values against evenly spaced cumulative fractions
    0..1 (n points), i.e. position / (n - 1)."""
    from forecourt.operators.clean import sequence_number
    n = df.agg(F.count(F.lit(1))).scalar()
    s = sequence_number(df.select(col, *[c for c in tie_cols if isinstance(c, str)]), [col, *tie_cols], out="position")
    return s.select(col, "position", F.when(n > 1, F.col("position") / (n - 1)).otherwise(0.0).alias("cdf"))


def duplicated_key_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-14: all rows whose key occurs more than once."""
    dup = df.groupBy(*keys).count().filter("count > 1").select(*keys)
    return df.join(dup, keys, "left_semi")


def group_number(df: DataFrame, keys: list[str], out: str = "group_id") -> DataFrame:
    """AGG-16: number of each key combination in sorted key order (0-based),
    null keys get -1.  Distinct keys are numbered (range-partitioned, no
    single-partition window) and joined back."""
    from forecourt.operators.clean import sequence_number
    nonnull = F.lit(True)
    for k in keys:
        nonnull = nonnull & F.col(k).isNotNull()
    ks = df.filter(nonnull).select(*keys).distinct()
    ids = sequence_number(ks, keys, out=out)
    return (df.join(ids, keys, "left").withColumn(out, F.coalesce(F.col(out), F.lit(-1)).cast("bigint")))


def tokens(text: Column, pattern: str = "[^a-z0-9]+") -> Column:
    """Lower-case tokens (non-empty) of a text."""
    return F.filter(F.split(F.lower(text), pattern), lambda t: t != "")


def word_unit_frequency(df: DataFrame, unit: str, text: str, threshold: int = 0) -> DataFrame:
    """AGG-18: word -> number of distinct units whose text contains it,
    kept when above the threshold."""
    words = df.select(unit, F.explode(F.array_distinct(tokens(F.col(text)))).alias("word"))
    return (words.groupBy("word").agg(F.count_distinct(unit).alias("n_units"))
                 .filter(F.col("n_units") > threshold))


def top_ngrams(df: DataFrame, group: str, order_col: str, text: str, k: int = 3) -> DataFrame:
    """AGG-19 / AGG-20: top-k unigrams and bigrams of each group's texts
    concatenated in ``order_col`` order (bigrams cross text borders, as the
    concatenation does).  Within-text bigrams come from the token arrays, as pairs of words
    frequent enough to be in a top-k bigram;
    border bigrams from each text's last token and the next text's first
    token (a window over texts, not over tokens).  Ties: count desc, n-gram
    asc."""
    from pyspark.sql import Window
    t = df.select(group, order_col, tokens(F.col(text)).alias("_t")).filter(F.size("_t") > 0)
    uni = materialize(t.select(group, F.explode("_t").alias("ngram")).groupBy(group, "ngram").agg(F.count(F.lit(1)).alias("cnt")), "checkpoint")
    # border bigrams: last token of a text + first token of the next text of
    # the group.  Texts are numbered per group with the chunked scan (chunk =
    # order key / 4096), then paired by an equi-join on (group, rn + 1), so a
    # large group is never one task.
    from forecourt.operators.windows import chunked_running
    ends = materialize(t.select(group, order_col, F.element_at("_t", 1).alias("_first"), F.element_at("_t", -1).alias("_last")), "checkpoint")
    numbered = chunked_running(ends, [group], [order_col], F.floor(F.col(order_col) / 4096), [], [], "_b")
    nxt = numbered.select(group, (F.col("_b_rn") - 1).alias("_b_rn"), F.col("_first").alias("_b"))
    border = numbered.join(nxt, [group, "_b_rn"]).select(group, F.col("_last").alias("_a"), "_b")
    inner = t.filter(F.size("_t") > 1).select(group, F.explode(F.transform(
        F.sequence(F.lit(1), F.size("_t") - 1),
        lambda i: F.struct(F.element_at("_t", i).alias("a"), F.element_at("_t", i + 1).alias("b")))).alias("_p")).select(
        group, F.col("_p.a").alias("_a"), F.col("_p.b").alias("_b"))

    def counted(words: DataFrame, pairs: DataFrame) -> DataFrame:
        """Bigrams of two of the group's given words."""
        words = stored_small(words.select(F.col(group).alias("_g"), F.col("ngram").alias("_w")))
        for side in ("_a", "_b"):
            pairs = pairs.join(words, F.col(group).eqNullSafe(F.col("_g")) & (F.col(side) == F.col("_w")), "left_semi")
        return pairs.groupBy(group, "_a", "_b").agg(F.count(F.lit(1)).alias("cnt"))

    # A bigram is no more frequent than its words.  The k-th count among bigrams of
    # the group's most frequent words is a bound: only words as frequent as it can be
    # in a top-k bigram, and bigrams of those words are counted in full.
    frequent = Window.partitionBy(group).orderBy(F.desc("cnt"), "ngram")
    heads = uni.withColumn("_r", F.row_number().over(frequent)).filter(F.col("_r") <= HEADS)
    best = Window.partitionBy(group).orderBy(F.desc("cnt"))
    bound = (counted(heads, inner).withColumn("_r", F.row_number().over(best)).filter(F.col("_r") == k)
             .select(F.col(group).alias("_g"), F.col("cnt").alias("_bound")))
    able = uni.join(stored_small(bound), F.col(group).eqNullSafe(F.col("_g")), "left").filter(F.col("cnt") >= F.coalesce("_bound", F.lit(1)))
    bi = counted(able, inner.unionByName(border)).select(group, F.lit(2).alias("n"), F.concat_ws(" ", "_a", "_b").alias("ngram"), "cnt")
    counts = uni.select(group, F.lit(1).alias("n"), "ngram", "cnt").unionByName(bi)
    wr = Window.partitionBy(group, "n").orderBy(F.desc("cnt"), "ngram")
    return counts.withColumn("rank", F.row_number().over(wr)).filter(F.col("rank") <= k)


def group_ordered_set(df: DataFrame, key: str, value: str, out: str = "members") -> DataFrame:
    """AGG-30: key -> sorted distinct members."""
    return df.groupBy(key).agg(F.array_sort(F.collect_set(value)).alias(out))


def drop_rows_lacking(df: DataFrame, group: str, date_cols: list[str]) -> DataFrame:
    """AGG-31: within a group, for each date column in sequence, drop the
    rows lacking that date when some row of the group has it."""
    out = df
    for c in date_cols:
        has = out.groupBy(group).agg(F.count(c).alias("_has"))
        out = (out.join(has, group, "left")
                  .filter(F.col(c).isNotNull() | (F.col("_has") == 0)).drop("_has"))
    return out


def correlation_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """AGG-33: Pearson correlation of every column pair in one aggregation
    pass, returned long (col_a, col_b, corr)."""
    pairs = [(a, b) for a in cols for b in cols]
    agg = df.agg(*[F.corr(a, b).alias(f"_c{i}") for i, (a, b) in enumerate(pairs)])
    arr = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"_c{i}").alias("corr"))
                    for i, (a, b) in enumerate(pairs)])
    return agg.select(F.explode(arr).alias("r")).select("r.*")


def vehicle_collapse(df: DataFrame, keys: list[str], order_cols: list, date_col: str, qty_col: str,
                     measures: list[str], supports: list[str], second_date_col: str,
                     reg_col: str, chs_doc_col: str, rgn_doc_col: str, keep_cols: list[str]) -> DataFrame:
    """AGG-32 (Q-07): one row per vehicle key.

    Groups are dropped when all measures sum to 0, when they are a single row
    of quantity 0, or when no row has an invoice date.  d0 = earliest invoice
    date; the picked row is the first (in ``order_cols``) with date d0 and
    quantity 1 when the group has several distinct dates, else the first with
    date d0; its quantity Q overwrites the group.  With E1 = sum of the first
    measure over rows dated d0 or undated and E2 = the same over rows dated
    d0 or (Q = 1): every measure is the sum over rows dated d0 or undated if
    E1 != 0, else the sum over all rows if E2 = 0, else the sum over rows
    dated d0 when Q = 1 (nothing otherwise).  Support measures sum over rows
    dated d0.  The first row of the group provides the other columns; one of
    four status flags is set from the distinct document counts.

    Two aggregations on the same key (partial aggregation map-side) and one
    join; no per-group Python."""
    nonnull = F.lit(True)
    for k in keys:
        nonnull = nonnull & F.col(k).isNotNull()
    x = df.filter(nonnull)
    total = None
    for m in measures:
        total = F.col(m) if total is None else total + F.col(m)
    # only "more than one distinct date" and "any document" are tested, so
    # min != max and non-null counts replace distinct counts (no Expand)
    st = x.groupBy(*keys).agg(F.min(date_col).alias("_d0"),
                              F.when(F.min(date_col) != F.max(date_col), 2).otherwise(1).alias("_nd"),
                              F.count(date_col).alias("_ndated"), F.count(F.lit(1)).alias("_rows"),
                              F.sum(total).alias("_msum"),
                              F.min(qty_col).alias("_qmin"))
    st = st.filter((F.col("_msum") != 0) & (F.col("_ndated") > 0)
                   & ~((F.col("_rows") == 1) & (F.col("_qmin") == 0)))
    j = x.join(st, keys, "inner")
    at_d0 = F.col(date_col) == F.col("_d0")
    prio = (F.when(at_d0 & (F.col(qty_col) == 1) & (F.col("_nd") > 1), 0)
             .when(at_d0, 1).otherwise(2))
    order = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_cols])
    d0_or_null = at_d0 | F.col(date_col).isNull()
    aggs_ = [F.min_by(qty_col, F.struct(prio.alias("p"), order.alias("o"))).alias("_Q"),
             F.min_by(F.struct(*keep_cols), order).alias("_first"),
             F.min(date_col).alias(date_col), F.min(second_date_col).alias(second_date_col),
             F.count(reg_col).alias("_nreg"), F.count(chs_doc_col).alias("_nchs"),
             F.count(rgn_doc_col).alias("_nrgn")]
    for i, m in enumerate(measures + supports):
        aggs_ += [F.sum(F.when(at_d0, F.col(m)).otherwise(0)).alias(f"_a{i}"),
                  F.sum(F.when(d0_or_null, F.col(m)).otherwise(0)).alias(f"_b{i}"),
                  F.sum(F.col(m)).alias(f"_c{i}")]
    g = j.groupBy(*keys).agg(*aggs_)
    q1 = F.col("_Q") == 1
    e1 = F.col("_b0")
    e2 = F.when(q1, F.col("_c0")).otherwise(F.col("_a0"))
    out = [*[F.col(k) for k in keys], *[F.col(f"_first.{c}").alias(c) for c in keep_cols],
           F.col("_Q").alias(qty_col), F.col(date_col), F.col(second_date_col)]
    for i, m in enumerate(measures):
        out.append(F.when(e1 != 0, F.col(f"_b{i}"))
                    .when(e2 == 0, F.col(f"_c{i}"))
                    .otherwise(F.when(q1, F.col(f"_a{i}")).otherwise(F.lit(0.0))).alias(m))
    for i, s in enumerate(supports):
        out.append(F.col(f"_a{i + len(measures)}").alias(s))
    reg, chs, rgn = F.col("_nreg") > 0, F.col("_nchs") > 0, F.col("_nrgn") > 0
    status = (F.when(~reg & chs, "No_Registration_Number_Flag")
               .when(reg & chs & ~rgn, "Registration_Number_No_SLR_Document_RGN_Flag")
               .when(chs & rgn, "SLR_Document_RGN_Flag").otherwise("Undefined_VHE_Status"))
    for flag in ("No_Registration_Number_Flag", "Registration_Number_No_SLR_Document_RGN_Flag",
                 "SLR_Document_RGN_Flag", "Undefined_VHE_Status"):
        out.append((status == flag).cast("bigint").alias(flag))
    return g.select(*out)


def feature_contribution(df: DataFrame, model_col: str, class_col: str, booleans: list[str],
                         categoricals: list[str], skip_value: str = "outros") -> DataFrame:
    """AGG-15: per model, P(class 1 | feature) - P(class 1 | not feature) for
    every boolean feature (name + '_sim') and every value of every
    categorical feature (name + '_' + value, 'outros' skipped); zero
    denominators are skipped; each difference is divided by the model's
    largest absolute difference (max(|min|, max)).  Features are unpivoted
    once; all counts come from one aggregation."""
    cols = [F.struct(F.lit(b).alias("feature"), F.col(b).cast("string").alias("value"), F.lit(True).alias("is_bool"))
            for b in booleans]
    cols += [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"), F.lit(False).alias("is_bool"))
             for c in categoricals]
    long = df.select(model_col, F.col(class_col).alias("_c"), F.explode(F.array(*cols)).alias("f")).select(
        model_col, "_c", "f.feature", "f.value", "f.is_bool")
    tot = df.groupBy(model_col).agg(F.count(F.lit(1)).alias("_n"), F.sum((F.col(class_col) == 1).cast("long")).alias("_n1"))
    cells = (long.groupBy(model_col, "feature", "value", "is_bool")
                 .agg(F.count(F.lit(1)).alias("f1"), F.sum((F.col("_c") == 1).cast("long")).alias("c1_f1")))
    x = cells.join(tot, model_col)
    x = x.filter(~F.col("is_bool") | (F.col("value") == "1")).filter(F.col("is_bool") | (F.col("value") != skip_value))
    f0 = F.col("_n") - F.col("f1")
    c1_f0 = F.col("_n1") - F.col("c1_f1")
    x = x.filter((F.col("f1") > 0) & (f0 > 0)).withColumn("difference", F.col("c1_f1") / F.col("f1") - c1_f0 / f0)
    x = x.withColumn("features", F.when(F.col("is_bool"), F.concat(F.col("feature"), F.lit("_sim")))
                     .otherwise(F.concat_ws("_", "feature", "value")))
    rng = x.groupBy(model_col).agg(F.greatest(F.abs(F.min("difference")), F.max("difference")).alias("_m"))
    return (x.join(rng, model_col)
             .select(model_col, "features", "difference", (F.col("difference") / F.col("_m")).alias("difference_normalized")))


def distinct_profile(df: DataFrame) -> DataFrame:
    """PRJ-20 as data: per column the number of distinct non-null values and
    whether it is constant (one pass)."""
    agg = df.agg(*[F.count_distinct(F.col(c)).alias(f"_d{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_d{i}").alias("n_distinct"))
                     for i, c in enumerate(df.columns)])
    return (agg.select(F.explode(rows).alias("r")).select("r.column_name", F.col("r.n_distinct").cast("bigint").alias("n_distinct"))
               .withColumn("is_constant", (F.col("n_distinct") == 1).cast("bigint")))


def duplicate_movement_cleaning(al: DataFrame, sales: DataFrame, keys: list[str], audit: str, doc: str,
                                order_cols: list) -> DataFrame:
    """WIN-15: within each (date, part, order) group of movements with more
    rows than distinct audit numbers: when 1..group-size matching sales
    exist keep the rows whose document is among the sales documents; with no
    matching sale keep the last row; with more sales than rows keep all."""
    from pyspark.sql import Window
    g = al.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"), F.count_distinct(audit).alias("_na"))
    s = sales.groupBy(*keys).agg(F.count(F.lit(1)).alias("_ns"))
    x = al.join(g, keys).join(s, keys, "left").withColumn("_ns", F.coalesce(F.col("_ns"), F.lit(0)))
    dirty = (F.col("_size") > 1) & (F.col("_na") < F.col("_size"))
    docs = (sales.select(*[F.col(k).alias(f"_s_{k}") for k in keys], F.col(doc).alias("_sdoc")).distinct()
                 .withColumn("_in", F.lit(1)))
    cond = [F.col(k) == F.col(f"_s_{k}") for k in keys] + [F.col(doc) == F.col("_sdoc")]
    from functools import reduce as _r
    x = x.join(docs, _r(lambda a, b: a & b, cond), "left").drop(*[f"_s_{k}" for k in keys], "_sdoc")
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() if isinstance(c, str) else c for c in order_cols])
    x = x.withColumn("_last", F.row_number().over(w) == 1)
    keep = (~dirty | (F.col("_ns") > F.col("_size"))
            | ((F.col("_ns") > 0) & (F.col("_ns") <= F.col("_size")) & F.col("_in").isNotNull())
            | ((F.col("_ns") == 0) & F.col("_last")))
    return x.filter(keep).drop("_size", "_na", "_ns", "_in", "_last")
