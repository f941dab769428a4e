"""Parts stock ledger and per-part sales metrics (AGG-07/08/09/35,
WIN-11..14, DAT-03).

All parts are processed in one plan (no per-part loop).  The ledger is sparse:
one row per part and movement day (and the part's opening row), with the
running sums and the interval of calendar days they hold for, so its size
follows the movements and not parts times days.  Calendar days are listed only
by ``list_days``, for outputs that need them.  Metrics over calendar days are
taken from the sparse rows and the number of days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QTY_COLS = ["qty_sold", "qty_purchased", "qty_purchased_urgent", "qty_purchased_non_urgent", "qty_regulated"]


def business_days(start: Column, end: Column) -> Column:
    """DAT-03: weekdays in [start, end) (numpy busday_count): five a whole week,
    and what the rest of the days has before and after the weekend."""
    days, first = F.datediff(end, start), F.weekday(start)  # Monday is 0
    rest = days % 7
    before = F.least(rest, F.greatest(5 - first, F.lit(0)))
    after = F.greatest(rest - (7 - first), F.lit(0))
    return F.when(days > 0, F.floor(days / 7) * 5 + before + after).otherwise(0)


def daily_movements(mv: DataFrame, part: str, day: str, kind: str, qty: str, unit_cost: str,
                    unit_price: str, urgent: Column) -> DataFrame:
    """Per (part, day): sold / purchased (urgent, non urgent) / regulated
    quantities and the day's mean costs and prices."""
    sale, buy, reg = (F.col(kind) == "sale"), (F.col(kind) == "purchase"), (F.col(kind) == "regulation")
    return mv.groupBy(part, day).agg(
        F.sum(F.when(sale, F.col(qty)).otherwise(0)).alias("qty_sold"),
        F.avg(F.when(sale, F.col(unit_cost))).alias("cost_sale_avg"),
        F.avg(F.when(sale, F.col(unit_price))).alias("pvp_avg"),
        F.sum(F.when(buy, F.col(qty)).otherwise(0)).alias("qty_purchased"),
        F.sum(F.when(buy & urgent, F.col(qty)).otherwise(0)).alias("qty_purchased_urgent"),
        F.sum(F.when(buy & ~urgent, F.col(qty)).otherwise(0)).alias("qty_purchased_non_urgent"),
        F.avg(F.when(buy, F.col(unit_cost))).alias("cost_purchase_avg"),
        F.sum(F.when(reg, F.col(qty)).otherwise(0)).alias("qty_regulated"),
        F.sum(F.when(reg, F.col(unit_cost) * F.col(qty))).alias("cost_reg_avg"))


FLOWS = QTY_COLS + ["cost_sale_avg", "pvp_avg", "cost_purchase_avg", "cost_reg_avg"]
EVOLUTIONS = {"sales_evolution": "qty_sold", "purchases_evolution": "qty_purchased",
              "purchases_urgent_evolution": "qty_purchased_urgent",
              "purchases_non_urgent_evolution": "qty_purchased_non_urgent", "regulated_evolution": "qty_regulated"}


def with_opening_row(rows: DataFrame, keys: list[str], start: Column, flows: list[str], day: str = "day",
                     until: str | None = None, end: Column | None = None) -> DataFrame:
    """Adds a row at the period's start, with null flows, to every key that has
    none: the first row of a key is doubled, so nothing is joined or shuffled
    again.  ``until`` names a column for the last day a row holds for (``end`` for a
    key's last row), as ``valid_until`` gives it, from the same sorted rows."""
    by_day = Window.partitionBy(*keys).orderBy(day)
    x = rows.withColumn("_first", F.lag(day).over(by_day).isNull() & (F.col(day) > start))
    if until:
        x = x.withColumn("_at", F.when(F.col("_first"), start).otherwise(F.col(day))).withColumn("_next", F.lead("_at").over(by_day))
    x = x.withColumn("_opening", F.explode(F.when(F.col("_first"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))))
    if until:
        x = x.withColumn(until, F.when(F.col("_opening"), F.date_sub(day, 1)).otherwise(F.coalesce(F.date_sub("_next", 1), end)))
    return (x.withColumns({c: F.when(~F.col("_opening"), F.col(c)) for c in flows})
             .withColumn(day, F.when(F.col("_opening"), start).otherwise(F.col(day))).drop("_first", "_opening", "_at", "_next"))


def valid_until(keys: list[str], end: Column, day: str = "day") -> Column:
    """Last calendar day a row's balances hold for."""
    return F.coalesce(F.date_sub(F.lead(day).over(Window.partitionBy(*keys).orderBy(day)), 1), end)


def list_days(intervals: DataFrame, flows: list[str], day: str = "day", until: str = "valid_to") -> DataFrame:
    """WIN-11: one row per calendar day of every interval; the flows belong to
    the first day of the interval and are zero on the others."""
    x = intervals.withColumn("_at", F.col(day)).withColumn(day, F.explode(F.sequence("_at", until)))
    return x.withColumns({c: F.when(F.col("_at") == F.col(day), F.col(c)).otherwise(0.0) for c in flows}).drop("_at", until)


def list_months(intervals: DataFrame, keys: list[str], flows: dict[str, Column], levels: list[str], day: str = "day",
                until: str = "valid_to") -> DataFrame:
    """WIN-11, a month to a row: (keys, month, n_days, an array a column): every calendar day of the
    intervals, in order.  A flow belongs to the first day of its interval and is the given
    value on the others.  Intervals are cut at month ends and spread inside the row, so no row
    a day is made."""
    # An interval that ends before it begins (a repeated day) lists its days backwards, as ``list_days``
    # does; the days of such a month overlap and are sorted one by one.
    turned = F.col(until) < F.col(day)
    months = F.sequence(F.trunc(day, "month"), F.trunc(until, "month"), F.expr("INTERVAL 1 MONTH"))
    x = intervals.withColumn("_m", F.explode(F.when(turned, F.sequence(day, until)).otherwise(months))).withColumn("_t", turned)
    at = F.when(F.col("_t"), F.col("_m")).otherwise(F.greatest(F.col(day), F.col("_m")))
    end = F.when(F.col("_t"), F.col("_m")).otherwise(F.least(F.col(until), F.last_day("_m")))
    piece = F.struct(at.alias("at"), (F.datediff(end, at) + 1).alias("n"), *[F.when(at == F.col(day), F.col(c)).otherwise(v).alias(c) for c, v in flows.items()], *levels)
    months = x.select(*keys, F.trunc("_m", "month").alias("_m"), "_t", piece.alias("_p")).groupBy(*keys, "_m").agg(
        F.sort_array(F.collect_list("_p")).alias("_p"), F.sum("_p.n").alias("n_days"), F.bool_or("_t").alias("_t"))

    def day_of(p: Column, i: Column) -> Column:
        return F.struct(F.date_add(p["at"], i).alias("at"), *[F.when(i == 0, p[c]).otherwise(v).alias(c) for c, v in flows.items()], *[p[c].alias(c) for c in levels])
    each = F.sort_array(F.flatten(F.transform("_p", lambda p: F.transform(F.sequence(F.lit(0), p["n"] - 1), lambda i: day_of(p, i)))))

    def spread(c: str, others: Column | None) -> Column:
        days = (lambda p: F.array_repeat(p[c], p["n"])) if others is None else (lambda p: F.concat(F.array(p[c]), F.array_repeat(others, p["n"] - 1)))
        return F.when(F.col("_t"), F.transform(each, lambda x: x[c])).otherwise(F.flatten(F.transform("_p", days))).alias(c)
    return months.select(*keys, F.col("_m").alias("month"), "n_days", *[spread(c, v) for c, v in flows.items()], *[spread(c, None) for c in levels])


def stock_ledger(daily: DataFrame, opening: DataFrame, part: str, start: Column, end: Column) -> DataFrame:
    """AGG-35 / WIN-13: sparse ledger per part over the calendar days ``start``
    to ``end`` (literals or scalar subqueries): a row per movement day and one
    at the start, valid from ``day`` to ``valid_to``.  Evolutions are running
    sums from the day after the start, computed stock = opening - sold +
    purchased - regulated (opening on the first day); closing photo, offset and
    correctness flag per part.  ``opening`` = (part, stock_qty) photo at the
    start.  A part's rows are bounded by the calendar, so a window holds one."""
    inside = daily.filter(F.col("day").between(start, end)).join(opening, part, "left")
    x = with_opening_row(inside, [part], start, FLOWS)
    x = x.na.fill(0.0, subset=FLOWS + ["stock_qty"])
    after = F.col("day") > start
    so_far = Window.partitionBy(part).orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumns({out: F.sum(F.when(after, F.col(src)).otherwise(0.0)).over(so_far) for out, src in EVOLUTIONS.items()}
                      | {"valid_to": valid_until([part], end)})
    x = x.withColumn("stock_qty_al", F.col("stock_qty") - F.col("sales_evolution") + F.col("purchases_evolution")
                     - F.col("regulated_evolution"))
    whole = Window.partitionBy(part)
    net = F.col("qty_purchased") - F.col("qty_sold") - F.col("qty_regulated")
    x = x.withColumns({"stock_end": F.col("stock_qty") + F.sum(net).over(whole),
                       "_al_end": F.col("stock_qty") + F.sum(F.when(after, net).otherwise(0.0)).over(whole)})
    return (x.withColumn("offset", F.col("stock_end") - F.col("_al_end"))
             .withColumn("stock_evolution_correct_flag", (F.col("offset") == 0).cast("bigint")).drop("_al_end"))


def part_metrics(series: DataFrame, part: str, start: Column, end: Column, dts_goal: int) -> DataFrame:
    """AGG-08 / AGG-09 / WIN-14: per-part sales metrics as of the day after
    ``end``, from the sparse ledger (day, valid_to, qty_sold, cost_sale_avg,
    pvp_avg, stock_qty_al); calendar days without a movement count as days with
    no sale.

    Weekend days are removed; parts need a non-negative total and more than
    one sale day, a sale within the last year, a non-negative last stock and
    non-zero last-year sales.  The days-to-sell window is the last ``dts_goal``
    calendar days (Q-18: per part).  Gaps are the day differences between
    consecutive sale days divided by the later quantity; their mean and median
    are reported."""
    current = F.date_add(end, 1)
    last_year, dts_start = F.add_months(current, -12), F.date_sub(end, dts_goal - 1)
    last_weekday = F.date_sub(end, F.when(F.dayofweek(end) == 7, 1).when(F.dayofweek(end) == 1, 2).otherwise(0))
    weekday = F.dayofweek("day").between(2, 6)
    s = series.withColumns({"_weekday": weekday, "_sold": weekday & (F.col("qty_sold") > 0), "_year": weekday & (F.col("day") >= last_year),
                            "_dts": weekday & (F.col("day") >= dts_start)})
    w = Window.partitionBy(part).orderBy("day")
    gaps = s.filter("_sold").withColumn("_gap", F.datediff("day", F.lag("day").over(w)) / F.col("qty_sold"))
    g_stats = gaps.groupBy(part).agg(F.avg("_gap").alias("dts_ratio_mean"),
                                     F.percentile("_gap", 0.5).alias("dts_ratio_median"))
    qty = F.col("qty_sold")
    agg = s.groupBy(part).agg(
        F.sum(F.when(F.col("_weekday"), qty)).alias("_tot"), F.count_if("_sold").alias("_sale_days"),
        F.max(F.when(F.col("_sold"), F.col("day"))).alias("last_sale_date"),
        F.max_by(F.struct("cost_sale_avg", "pvp_avg"), F.when(F.col("_sold"), F.col("day"))).alias("_last"),
        F.max(F.when((F.col("day") <= last_weekday) & (F.col("valid_to") >= last_weekday), F.col("stock_qty_al"))).alias("last_stock"),
        F.coalesce(F.sum(F.when(F.col("_dts"), qty)), F.lit(0.0)).alias("dts_total_qty_sold"),
        F.min(F.when(F.col("_dts") & (qty >= 0), qty)).alias("_dts_min"), F.max(F.when(F.col("_dts"), qty)).alias("_dts_max"),
        F.count_if("_dts").alias("_dts_rows"),
        F.coalesce(F.sum(F.when(F.col("_year"), qty)), F.lit(0.0)).alias("last_year_sales"))
    agg = agg.filter((F.col("_tot") >= 0) & (F.col("_sale_days") > 1) & (F.col("last_sale_date") >= last_year)
                     & (F.col("last_stock") >= 0) & (F.col("last_year_sales") != 0))
    # a calendar day without a row sells nothing
    idle = F.when(business_days(F.greatest(dts_start, start), current) > F.col("_dts_rows"), F.lit(0.0))
    agg = agg.withColumns({
        "last_year_sales_mean": F.try_divide(F.col("last_year_sales"), business_days(F.greatest(last_year, start), current)),
        "dts_min_total_qty_sold": F.least("_dts_min", idle), "dts_max_total_qty_sold": F.greatest("_dts_max", idle)})
    cost, pvp = F.col("_last.cost_sale_avg"), F.col("_last.pvp_avg")
    out = agg.select(
        part, "last_sale_date", cost.alias("cost"), pvp.alias("pvp"), (pvp - cost).alias("margin"),
        "last_stock", (F.col("last_stock") * cost).alias("last_stock_value"),
        "last_year_sales", "last_year_sales_mean", (F.col("last_year_sales") * cost).alias("last_year_cogs"),
        (F.try_divide(F.col("last_stock") * cost, F.col("last_year_sales") * cost) * 365).alias("dii_year"),
        F.try_divide(F.col("last_stock"), F.col("last_year_sales_mean")).alias("dii_year_weekdays"),
        F.try_divide(F.col("last_year_sales"), business_days(last_year, current)).alias("dii_year_weekdays_v2"),
        F.try_divide(F.lit(1.0), F.col("last_year_sales_mean")).alias("days_to_sell_1_part"),
        "dts_total_qty_sold", "dts_min_total_qty_sold", "dts_max_total_qty_sold")
    return out.join(g_stats, part, "left")


def part_type(sales: DataFrame, part: str, group_col: str, desc_col: str, oil_words: list[str],
              no_ta: str = "NO_TA") -> DataFrame:
    """AGG-07: part type = 2nd character of the part's product group (the
    most frequent one when there are several: count desc, value asc);
    groups too short to have one fall back to '1' when the most frequent
    description holds an oil word, else NO_TA (Q-06: returned as the type)."""
    s = sales.filter(F.col(group_col).isNotNull())
    g = s.groupBy(part).agg(F.mode(F.col(group_col), True).alias("_grp"),
                            F.mode(F.col(desc_col), True).alias("_desc"))
    oil = F.lit(False)
    for wd in oil_words:
        oil = oil | F.lower(F.col("_desc")).contains(wd)
    ta = (F.when(F.length("_grp") >= 2, F.substring("_grp", 2, 1))
           .when(oil, F.lit("1")).otherwise(F.lit(no_ta)))
    return g.select(part, ta.alias("ta"))
