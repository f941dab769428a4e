"""Sparse ledger, its metrics and the ledger stream against dense brute force."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from forecourt.operators import ledger
from forecourt.session import scratch_table_path
from forecourt.streaming import streams

START, END = dt.date(2020, 1, 4), dt.date(2021, 7, 18)
DAYS = [START + dt.timedelta(i) for i in range((END - START).days + 1)]


def movements(seed=1, parts=12, n=25):
    r = random.Random(seed)
    rows = {}
    for p in range(parts):
        for day in r.sample(DAYS, n if p else 1) + ([START, END] if p == 1 else []):
            kind = r.random()
            sold, bought = (float(r.randint(0, 9)), 0.0) if kind < 0.6 else (0.0, float(r.randint(1, 20)))
            rows[p, day] = (p, day, sold, 2.0 * p, 3.0 * p, bought, bought / 2, bought / 2, 1.0, float(kind > 0.95), 0.5)
    return list(rows.values())


SCHEMA = ("part long, day date, qty_sold double, cost_sale_avg double, pvp_avg double, qty_purchased double, qty_purchased_urgent double, "
          "qty_purchased_non_urgent double, cost_purchase_avg double, qty_regulated double, cost_reg_avg double")


def the_ledger(spark, rows):
    opening = spark.createDataFrame([(p, 100.0 + p) for p in range(10)], "part long, stock_qty double")
    return ledger.stock_ledger(spark.createDataFrame(rows, SCHEMA).repartition(3), opening, "part", F.lit(START), F.lit(END))


def dense(rows):
    """(part, day) -> (sold, computed stock) for every calendar day."""
    flows = {(r[0], r[1]): r for r in rows}
    out = {}
    for p in {r[0] for r in rows}:
        stock = 100.0 + p if p < 10 else 0.0
        for day in DAYS:
            r = flows.get((p, day))
            if r and day > START:
                stock += r[5] - r[2] - r[9]
            out[p, day] = (r[2] if r else 0.0, stock)
    return out


def test_sparse_ledger_lists_the_dense_one(spark):
    rows = movements()
    x = the_ledger(spark, rows)
    kept = {(r[0], r[1]) for r in rows} | {(r[0], START) for r in rows}
    assert {(r.part, r.day) for r in x.select("part", "day").collect()} == kept
    days = ledger.list_days(x, ["qty_sold"]).collect()
    assert len(days) == 12 * len(DAYS)
    want = dense(rows)
    assert all((r.qty_sold, r.stock_qty_al) == want[r.part, r.day] for r in days)


def test_metrics_count_days_without_a_row(spark):
    rows = movements(2)
    got = {r.part: r for r in ledger.part_metrics(the_ledger(spark, rows), "part", F.lit(START), F.lit(END), 30).collect()}
    full = dense(rows)
    week = [d for d in DAYS if d.weekday() < 5]
    year = [d for d in week if d >= dt.date(2020, 7, 19)]
    for p in range(12):
        sold = {d: full[p, d][0] for d in week}
        sales = [d for d in week if sold[d] > 0]
        total = sum(sold[d] for d in year)
        fine = len(sales) > 1 and sales[-1] >= year[0] and full[p, week[-1]][1] >= 0 and total
        assert (p in got) == bool(fine)
        if fine:
            m, last = got[p], [sold[d] for d in week if d > END - dt.timedelta(30)]
            assert (m.last_sale_date, m.last_stock, m.last_year_sales) == (sales[-1], full[p, week[-1]][1], total)
            assert m.last_year_sales_mean == pytest.approx(total / len(year))
            assert (m.dts_total_qty_sold, m.dts_min_total_qty_sold, m.dts_max_total_qty_sold) == (sum(last), min(last), max(last))
    assert got


def test_business_days(spark):
    rows = [(DAYS[i], DAYS[i] + dt.timedelta(n)) for i in range(9) for n in range(-2, 25)]
    got = spark.createDataFrame(rows, "a date, b date").select("a", "b", ledger.business_days(F.col("a"), F.col("b")).alias("n")).collect()
    assert all(r.n == sum((r.a + dt.timedelta(i)).weekday() < 5 for i in range((r.b - r.a).days)) for r in got)


def arrivals(spark, rows, of):
    flat = [(r[0], r[1], r[2], r[5], r[9], 100.0 + r[0] if r[0] < 10 else 0.0, of(r)) for r in rows]
    return spark.createDataFrame(flat, "part long, day date, qty_sold double, qty_purchased double, qty_regulated double, stock_qty double, arrival int")


def test_stream_with_expiring_state_equals_the_batch(spark):
    rows = movements(3, n=6)
    name = f"ledger_test_{random.random()}"
    month = lambda r: (r[1].year - 2020) * 4 + (r[1].month - 1) // 3
    out = streams.ledger_stream(streams.staged(arrivals(spark, rows, month), "arrival", ["part"], name), "arrival", START, name, idle=45, delay="3 days")
    want = dense(rows)
    got = out.collect()
    assert {(r.part, r.day) for r in got} == {(r[0], r[1]) for r in rows}
    assert all(r.stock_qty_al == want[r.part, r.day][1] and not r.late for r in got)
    posted = spark.read.parquet(scratch_table_path(spark, f"{name}/out"))
    assert posted.where("kind = 'closed'").count() > 5  # the timers did end states


def test_stream_late_and_refused_movements(spark):
    day = lambda i: START + dt.timedelta(i)
    row = lambda p, i, sold: (p, day(i), sold, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)
    first, second = [row(1, 10, 1.0), row(1, 20, 2.0), row(2, 100, 1.0)], [row(1, 98, 4.0), row(2, 97, 8.0), row(1, 15, 16.0)]
    name = f"ledger_late_{random.random()}"
    table = streams.staged(arrivals(spark, first + second, lambda r: int(r in second)), "arrival", ["part"], name)
    out = {(r.part, r.day): r for r in streams.ledger_stream(table, "arrival", START, name, delay="5 days").collect()}
    assert out[2, day(97)].late and out[2, day(97)].sales_evolution == 9.0 and out[2, day(100)].sales_evolution == 1.0
    assert out[1, day(98)].sales_evolution == 7.0 and (1, day(15)) not in out
    lost = streams.refused(spark, scratch_table_path(spark, f"{name}/in"), name).collect()
    assert [(r.part, r.day) for r in lost] == [(1, day(15))]


def test_months_list_every_day_as_single_days_do(spark):
    d = dt.date
    rows = [(1, d(2020, 1, 20), d(2020, 3, 4), 5, 7), (1, d(2020, 3, 5), d(2020, 3, 4), 2, 9), (1, d(2020, 3, 5), d(2020, 3, 31), 3, 4), (2, d(2020, 2, 29), d(2020, 2, 29), 1, 1)]
    x = spark.createDataFrame(rows, "part long, day date, valid_to date, q long, s long").repartition(2)
    want = defaultdict(list)
    for r in ledger.list_days(x, ["q"]).collect():
        want[r.part, r.day.replace(day=1)].append((r.day, int(r.q), r.s))
    plan = ledger.list_months(x, ["part"], {"q": F.lit(0).cast("long")}, ["s"])
    got = {(r.part, r.month): (r.n_days, r.q, r.s) for r in plan.collect()}
    assert got == {k: (len(v), [y[1] for y in sorted(v)], [y[2] for y in sorted(v)]) for k, v in want.items()}
