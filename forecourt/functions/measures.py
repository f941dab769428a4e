"""Business measures (MTH-*) and date helpers (DAT-*) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.operators.quantiles import quantile_values

from forecourt.functions.fmt import rnd


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def margin_pct(df: DataFrame, margin: str = "margin", total: str = "price_total",
               out: str = "margin_pct") -> DataFrame:
    """MTH-01: round(margin, 2) / round(total, 2) * 100, rounded to 4 places,
    half-even.  A zero total gives null instead of an ANSI error."""
    return df.withColumn(out, rnd(F.try_divide(rnd(margin, 2), rnd(total, 2)) * 100, 4))


def score(df: DataFrame, stock_days_threshold: int = 45, margin_threshold: float = 3.5,
          purchase: str = "purchase_date", sale: str = "sale_date",
          total: str = "price_total", margin: str = "margin",
          margin_pct_col: str = "margin_pct", holding_rate: float = 0.05) -> DataFrame:
    """MTH-02 (retail): stock days (whole days, negatives to 0), the two class
    flags, their conjunction, the holding cost rate/360 * price * days and the
    euro score margin - holding cost."""
    days = F.greatest(F.datediff(_c(sale), _c(purchase)), F.lit(0)).cast("bigint")
    return (df.withColumn("stock_days", days)
              .withColumn("stock_days_class", (F.col("stock_days") <= stock_days_threshold).cast("bigint"))
              .withColumn("margin_class", F.coalesce((_c(margin_pct_col) >= margin_threshold).cast("bigint"), F.lit(0).cast("bigint")))
              .withColumn("new_score", (F.col("stock_days_class") * F.col("margin_class")).cast("bigint"))
              .withColumn("days_stock_price", F.lit(holding_rate / 360) * _c(total) * F.col("stock_days"))
              .withColumn("score_euros", _c(margin) - F.col("days_stock_price")))


def day_class(days: Column | str, bounds=(90, 120, 150, 180, 270, 365)) -> Column:
    """MTH-02 (importer): multi-class stock-day bucket.  Bucket 0 up to the
    first bound, i for (bound[i-1], bound[i]], len(bounds) beyond the last."""
    d = _c(days)
    expr = F.when(d <= bounds[0], F.lit(0))
    for i in range(1, len(bounds)):
        expr = expr.when((d > bounds[i - 1]) & (d <= bounds[i]), F.lit(i))
    return expr.when(d > bounds[-1], F.lit(len(bounds))).otherwise(F.lit(0)).cast("bigint")


def _safe_ratio(num: Column, den: Column) -> Column:
    """x / 0 gives +-inf in the reference and is then replaced by 0; 0 / 0
    (NaN) stays missing (null)."""
    return F.when(den == 0, F.when(num == 0, F.lit(None)).otherwise(F.lit(0.0))).otherwise(num / den)


def importer_measures(df: DataFrame, m: dict[int, str]) -> DataFrame:
    """MTH-03: importer totals, discounts, margins I / II, network support.
    ``m`` maps measure numbers to columns (absent measures count as 0).
    Measures 40-42 enter the network support twice, as in the reference."""
    def g(i):
        return F.col(m[i]) if i in m else F.lit(0.0)
    total_sales = g(2) + g(3) + g(4)
    total_disc = g(5) + g(6) + g(7)
    net = (g(2) - g(5)) + (g(3) - g(6)) + (g(4) - g(7))
    fm1 = ((((g(2) - g(5)) + (g(3) - g(6))) + (g(4) - g(7))) + ((g(9) + g(10)) + (g(11) + g(12)))
           + ((g(13) + g(14)) + g(15)))
    quality = g(17) + g(18) + g(19) + g(20) + g(40) + g(41) + g(42)
    support = quality
    for i in (21, 22, 23, 24, 25, 26, 27, 28, 29, 30, 40, 41, 42, 43):
        support = support + g(i)
    return (df.withColumn("Total_Sales", total_sales).withColumn("Total_Discount", total_disc)
              .withColumn("Total_Discount_pct", _safe_ratio(F.col("Total_Discount"), F.col("Total_Sales")))
              .withColumn("Total_Net_Sales", net)
              .withColumn("Total_Cost", g(9) + g(10) + g(11) + g(12))
              .withColumn("Fixed_Margin_I", fm1)
              .withColumn("Fixed_Margin_I_pct", _safe_ratio(F.col("Fixed_Margin_I"), F.col("Total_Net_Sales")))
              .withColumn("Quality_Margin", quality)
              .withColumn("Total_Network_Support", support)
              .withColumn("Fixed_Margin_II", F.col("Fixed_Margin_I") + F.col("Total_Network_Support"))
              .withColumn("Fixed_Margin_II_pct", _safe_ratio(F.col("Fixed_Margin_II"), F.col("Total_Net_Sales")))
              .withColumn("HME_Support", g(13) + g(14) + g(15)))


def zscore(df: DataFrame, cols: list[str]) -> DataFrame:
    """MTH-04: (x - mean) / population std; the statistics are scalar
    subqueries (no global window, no single-partition shuffle)."""
    out = df
    for c in cols:
        mu = df.agg(F.avg(c)).scalar()
        sd = df.agg(F.stddev_pop(c)).scalar()
        out = out.withColumn(c, F.try_divide(F.col(c) - mu, sd))
    return out


def minmax(df: DataFrame, cols: list[str], reverse: list[str] = (), suffix: str = "") -> DataFrame:
    """MTH-05 / MTH-08: (x - min) / (max - min); for "lower is better"
    columns (x - max) / (min - max).  A constant column gives null."""
    out = df
    for c in cols:
        lo, hi = df.agg(F.min(c)).scalar(), df.agg(F.max(c)).scalar()
        e = (F.try_divide(F.col(c) - hi, lo - hi) if c in reverse else F.try_divide(F.col(c) - lo, hi - lo))
        out = out.withColumn(c + suffix, e)
    return out


def minmax_inverse(df: DataFrame, scaled: str, ref: DataFrame, ref_col: str, out: str) -> DataFrame:
    """MTH-05 inverse: x = s * (max - min) + min with the reference column's
    bounds."""
    lo, hi = ref.agg(F.min(ref_col)).scalar(), ref.agg(F.max(ref_col)).scalar()
    return df.withColumn(out, F.col(scaled) * (hi - lo) + lo)


def robust_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    """MTH-06: (x - median) / (q3 - q1), exact quantiles by refinement."""
    out = df
    for c in cols:
        q1, med, q3 = quantile_values(df, c, [0.25, 0.5, 0.75])
        out = out.withColumn(c, F.try_divide(F.col(c) - med, q3 - q1))
    return out


def skew_report(df: DataFrame, cols: list[str]) -> DataFrame:
    """MTH-07: per non-negative column, the bias-corrected skewness of x and
    the biased skewness of log1p(x) (the reference compares these two), and
    whether log1p is applied (it lowers the absolute skew).  One
    aggregation pass."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"n{i}"), F.skewness(c).alias(f"s{i}"), F.skewness(F.log1p(c)).alias(f"l{i}"),
                 F.min(c).alias(f"m{i}")]
    a = df.agg(*aggs)
    rows = []
    for i, c in enumerate(cols):
        n = F.col(f"n{i}")
        corrected = F.col(f"s{i}") * F.sqrt(n * (n - 1)) / (n - 2)
        rows.append(F.struct(F.lit(c).alias("column_name"), corrected.alias("original_skew"),
                             F.col(f"l{i}").alias("log_skew"),
                             ((F.col(f"m{i}") >= 0) & (F.abs(F.col(f"l{i}")) < F.abs(corrected))).cast("bigint").alias("applied")))
    return a.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def weighted_score(weights: dict[str, float], suffix: str = "_normalized") -> Column:
    """MTH-09."""
    e = None
    for c, w in weights.items():
        t = F.col(c + suffix) * w
        e = t if e is None else e + t
    return e


def threshold_predictions(df: DataFrame, prob: str, pred: str, fallback="1",
                          cuts=(("50", 0.5, True), ("80", 0.8, False), ("85", 0.85, False),
                                ("90", 0.9, False), ("95", 0.95, False))) -> DataFrame:
    """MTH-11: New_Prediction_<cut>: fallback class below the cut (the first
    cut inclusive), else the prediction."""
    out = df
    for tag, cut, inclusive in cuts:
        below = F.col(prob) <= cut if inclusive else F.col(prob) < cut
        out = out.withColumn(f"New_Prediction_{tag}", F.when(below, F.lit(fallback)).otherwise(F.col(pred)))
    return out


def force_predictions(df: DataFrame, text_col: str, copy_col: str, prob: str, pred: str,
                      tags=("50", "80", "85", "90", "95")) -> DataFrame:
    """MTH-12: where a text rule fired (text differs from its rule copy) the
    rule class is forced everywhere with probability 1."""
    fired = F.col(text_col) != F.col(copy_col)
    out = df.withColumn(prob, F.when(fired, F.lit(1.0)).otherwise(F.col(prob)))
    out = out.withColumn(pred, F.when(fired, F.col(copy_col)).otherwise(F.col(pred)))
    for t in tags:
        c = f"New_Prediction_{t}"
        out = out.withColumn(c, F.when(fired, F.col(copy_col)).otherwise(F.col(c)))
    return out


def time_tags(ts: Column, fmt_date: str = "yyyy-MM-dd", fmt_time: str = "HH:mm:ss") -> list[Column]:
    """DAT-01 (run time is an argument, never the wall clock)."""
    return [F.date_format(ts, fmt_date).alias("date_tag"), F.date_format(ts, fmt_time).alias("time_tag")]


def year_to_date(d: Column) -> list[Column]:
    """DAT-02: first day of the year and the number of elapsed months."""
    return [F.trunc(d, "year").alias("period_start"), F.month(d).alias("period_months")]


def split_date(d: Column, months_back: int = 37) -> Column:
    """DAT-04: first of the month ``months_back`` months before."""
    return F.trunc(F.add_months(d, -months_back), "month")
