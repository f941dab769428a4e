"""Semantic edge cases and brute-force checks on tiny frames."""

import calendar
import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from forecourt.functions.text import porter_stem
from forecourt.operators import alloc, joins, rules, windows


def test_porter_stemmer_classic_examples():
    cases = {"caresses": "caress", "ponies": "poni", "agreed": "agre", "motoring": "motor", "hopping": "hop",
             "relational": "relat", "generalizations": "gener", "effective": "effect", "controll": "control"}
    assert {w: porter_stem(w) for w in cases} == cases


def _brute(values, caps, total):
    best = 0
    for q in itertools.product(*[range(c + 1) for c in caps]):
        if total is not None and sum(q) > total:
            continue
        best = max(best, sum(a * b for a, b in zip(q, values)))
    return best


def test_greedy_allocation_is_optimal(spark):
    rnd = random.Random(3)
    rows, expect = [], {}
    for prob in range(40):
        n = rnd.randint(1, 4)
        vals = [round(rnd.uniform(-5, 20), 2) for _ in range(n)]
        caps = [rnd.randint(0, 3) for _ in range(n)]
        total = rnd.choice([None, rnd.randint(0, 6)])
        expect[prob] = _brute(vals, caps, total)
        rows += [(prob, i, v, c, total) for i, (v, c) in enumerate(zip(vals, caps))]
    df = spark.createDataFrame(rows, "prob int, item int, value double, cap bigint, total bigint")
    out = alloc.greedy_fill(df, ["prob"], ["item"], "value", "cap", F.col("total"))
    got = {r["prob"]: r["obj"] for r in out.groupBy("prob").agg(F.sum(F.col("quantity") * F.col("value")).alias("obj")).collect()}
    for prob, best in expect.items():
        assert got[prob] == pytest.approx(best), prob
    assert out.filter((F.col("quantity") < 0) | (F.col("quantity") > F.col("cap"))).count() == 0


def test_netting_two_negatives_one_positive_and_orphans(spark):
    rows = [(1, "d", 2.0, 10.0, 8.0, 2.0, 1), (1, "d", -2.0, -10.0, -8.0, -2.0, 2), (1, "d", -2.0, -10.0, -8.0, -2.0, 3),
            (1, "d", 5.0, 20.0, 15.0, 5.0, 4), (1, "d", 5.0, 20.0, 15.0, 5.0, 5), (1, "d", -5.0, -20.0, -15.0, -5.0, 6),
            (2, "d", -1.0, -1.0, -1.0, 0.0, 7), (2, "d", 3.0, 3.0, 3.0, 0.0, 8)]
    df = spark.createDataFrame(rows, "o int, day string, q double, v double, c double, m double, k int")
    out = windows.net_negative_movements(df, "o", "day", "q", "v", "c", "m", ["k"])
    assert sorted(r["k"] for r in out.collect()) == [5, 8]   # negatives gone, one of two positives kept


def test_netting_with_null_keys_and_of_purchases(spark):
    rows = [(1, None, 2.0, 10.0, 8.0, 2.0, 1), (1, None, -2.0, -10.0, -8.0, -2.0, 2), (None, "d", 2.0, 10.0, 8.0, 2.0, 3),
            (None, "d", -2.0, -10.0, -8.0, -2.0, 4), (1, "d", None, 1.0, 1.0, 1.0, 5), (1, "d", 0.0, 0.0, 0.0, 0.0, 6)]
    df = spark.createDataFrame(rows, "o int, day string, q double, v double, c double, m double, k int")
    out = windows.net_negative_movements(df, "o", "day", "q", "v", "c", "m", ["k"])
    assert sorted(r["k"] for r in out.collect()) == [1, 3, 6]  # a null matches nothing, null quantities go
    bought = [(1, "d1", 2.0, 7, 8.0, 1), (1, "d3", 2.0, 7, 8.0, 2), (1, "d2", -2.0, 7, -8.0, 3), (1, "d4", -2.0, 7, 8.0, 4),
              (1, "d1", 2.0, 9, 8.0, 5), (1, "d1", 2.0, None, 8.0, 6), (1, "d2", -2.0, None, 8.0, 7)]
    df = spark.createDataFrame(bought, "o int, day string, q double, part int, c double, k int").withColumn("m", F.lit(0.0))
    out = windows.net_negative_movements(df, "o", "day", "q", "part", "c", "m", ["k"], mode="purchases")
    assert sorted(r["k"] for r in out.collect()) == [1, 5, 6]  # only the latest positive of a key goes
    plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
    assert plan.split("== Initial Plan ==")[-1].count("Exchange") == 1


def test_part_sums_shuffle_each_row_three_times(spark, tmp_path):
    from datetime import datetime

    from forecourt.plans import all_queries
    day = lambda n: datetime(2020, 6, n)
    lines = [(1, 1, 4, 1, 5.0, 50.0, 0.1, "N", day(2)), (1, 2, 4, 1, 3.0, 30.0, 0.0, "N", day(3)), (2, 1, 4, 1, 2.0, 20.0, 0.0, "N", day(3)),
             (2, 2, 3, 1, 7.0, 70.0, 0.0, "R", day(3)), (3, 1, 4, 1, 9.0, 90.0, 0.0, "N", day(9)), (4, 1, 4, 1, 1.0, 10.0, 0.0, "N", day(2)),
             (None, 1, 4, 1, 1.0, 10.0, 0.0, "N", day(2)), (1, 3, None, 1, 1.0, 10.0, 0.0, "N", day(2)), (1, 4, 4, 1, 1.0, 10.0, 0.0, "N", None)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
                                 "l_discount double, l_returnflag string, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, day(1)), (2, day(1)), (3, day(5)), (4, None)], "o_orderkey long, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    out = all_queries()["agg_02_parts_sales_preparation"](spark, str(tmp_path))
    got = sorted((r.l_orderkey, r.l_linenumber, r.unit_price, r.unit_cost, r.qty_day_part, r.qty_order_day_part, r.qty_week_part) for r in out.collect())
    assert got == [(1, 1, 10.0, 9.0, 6.0, 10.0, 10.0), (1, 2, 10.0, 10.0, 5.0, 10.0, 10.0), (2, 1, 10.0, 10.0, 5.0, 10.0, 10.0), (3, 1, 10.0, 10.0, 9.0, 9.0, 9.0)]
    plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple").split("== Initial Plan ==")[-1]
    assert plan.count("Exchange hashpartitioning") <= 4 and plan.count("FileScan parquet") == 2  # three of the lines, one of the orders


def _minus_months(d, k):
    y, m = d.year, d.month - k
    while m <= 0:
        m += 12
        y -= 1
    return dt.date(y, m, min(d.day, calendar.monthrange(y, m)[1]))


def test_month_windows_against_naive(spark):
    rnd = random.Random(5)
    base = dt.date(2020, 1, 31)
    days = [base + dt.timedelta(days=rnd.randint(0, 200)) for _ in range(60)] + [dt.date(2020, 3, 31), dt.date(2020, 2, 29), dt.date(2020, 1, 31)]
    rows = [("g", dt.datetime.combine(d, dt.time()), i) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "g string, ts timestamp, k int")
    out = {r["k"]: r for r in windows.month_window_counts(df, ["g"], "ts", ["ts", "k"], 6).collect()}
    for i, t in enumerate(days):
        for k in range(1, 7):
            hi = t if k == 1 else _minus_months(t, k - 1)
            lo = _minus_months(t, k)
            assert out[i][f"sales_month-{k}"] == sum(1 for s in days if lo < s < hi)
            assert out[i][f"sales_month-{k}_cum"] == sum(1 for s in days if s > lo)


def test_chunked_scan_equals_plain_running_values(spark):
    rnd = random.Random(7)
    rows = [("hot" if rnd.random() < 0.6 else f"g{rnd.randint(0, 3)}", rnd.randint(0, 99), i, rnd.randint(0, 1)) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, t int, k int, s int")
    got = windows.chunked_running(df, ["g"], ["t", "k"], F.floor(F.col("t") / 10), ["s"], ["s"], "_r").collect()
    by = {}
    for g, t, k, s in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        by.setdefault(g, []).append((k, s))
    want = {}
    for g, seq in by.items():
        cum = 0
        for pos, (k, s) in enumerate(seq):
            cum += s
            want[k] = (pos + 1, cum, seq[pos - 1][1] if pos else None)
    for r in got:
        assert (r["_r_rn"], r["_r_cum_s"], r["_r_lag_s"]) == want[r["k"]]


def test_singleton_configuration_gets_zero_history(spark):
    rows = [("a", dt.date(2020, 1, 1), 1, 1, 5.0, 10), ("b", dt.date(2020, 1, 2), 2, 1, 6.0, 3), ("b", dt.date(2020, 1, 3), 3, 0, 1.0, 50)]
    df = spark.createDataFrame(rows, "cfg string, sale_date date, k int, new_score int, margin_pct double, stock_days int")
    out = {r["k"]: r for r in windows.previous_sales_features(df, ["cfg"], ["sale_date", "k"]).collect()}
    assert out[1]["average_score_global"] == 0 and out[1]["number_prev_sales"] == 0 and out[1]["max_score_global"] == 0
    assert out[3]["last_score"] == 1 and out[3]["prev_sales_check"] == 1 and out[2]["average_score_dynamic"] == 0


def _sequential_cascade(stock_refs, master, passes):
    out = {}
    for ref in stock_refs:
        for i, fn in enumerate(passes):
            k = fn(ref)
            cands = sorted(d for m, d in master if k and fn(m) == k)
            if cands:
                out[ref] = (cands[0], i)
                break
    return out


def test_cascade_equals_sequential_passes(spark):
    import re
    py = [lambda s: s, lambda s: re.sub("^0+", "", re.sub("^(BM|VW)", "", s)), lambda s: re.sub("[A-Z]+$", "", s)]
    sp = [lambda c: c, lambda c: F.regexp_replace(F.regexp_replace(c, "^(BM|VW)", ""), "^0+", ""), lambda c: F.regexp_replace(c, "[A-Z]+$", "")]
    rnd = random.Random(11)
    stock = [rnd.choice(["", "00", "BM", "VW"]) + str(rnd.randint(1, 30)) + rnd.choice(["", "AT", "X"]) for _ in range(80)]
    master = [(str(rnd.randint(1, 30)) + rnd.choice(["", "AB"]), f"desc{i}") for i in range(25)]
    want = _sequential_cascade(set(stock), master, py)
    s = spark.createDataFrame([(r,) for r in stock], "ref string")
    m = spark.createDataFrame(master, "mref string, description string")
    got = {r["ref"]: (r["matched_desc"], r["match_pass"]) for r in joins.cascade_match(s, m, sp, "ref", "mref", "description").collect()}
    for ref in set(stock):
        assert got[ref] == want.get(ref, (None, None)), ref


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def test_edit_distance_is_per_character(spark):
    pairs = [("oßen", "ouen"), ("éléphant", "elephant"), ("kitten", "sitting"), ("", "abc")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(F.levenshtein("a", "b")).collect()]
    assert got == [_lev(a, b) for a, b in pairs]


def test_consecutive_rule_counts_adjacent_hits(spark):
    # 'a b c' needs 1 + adjacent hits >= 3; "a b x a b" has two (a,b) hits
    reqs = spark.createDataFrame([(1, ["a", "b", "x", "a", "b", "c"]), (2, ["a", "b", "x", "c"]), (3, ["c", "b", "a"])],
                                 "id int, tokens array<string>")
    r = spark.createDataFrame([(0, "L", "consecutive", ["a", "b", "c"], None, None)],
                              "rule_id bigint, label string, kind string, words array<string>, pattern string, user_id bigint")
    got = sorted(x["id"] for x in rules.keyword_matches(reqs, "id", "tokens", r).collect())
    assert got == [1]


def test_url_nulls_whole_cell(spark):
    from forecourt.operators import clean
    df = spark.createDataFrame([("see http://x.y now",), ("plain",)], "t string")
    assert [r[0] for r in clean.null_if_match(df, "t", "http").collect()] == [None, "plain"]


def test_sequence_number_keeps_every_row_over_many_partitions(spark):
    from forecourt.operators import clean
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
        li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
        keys = ["l_shipdate", "l_extendedprice", "l_orderkey", "l_linenumber"]
        out = clean.sequence_number(li.select(*keys, "l_comment") if "l_comment" in li.columns else li.select(*keys), keys)
        rows = out.select("idx", *keys).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(rows) == li.count()
    want = sorted(tuple(r[1:]) for r in rows)
    assert [tuple(r[1:]) for r in sorted(rows)] == want and [r.idx for r in sorted(rows)] == list(range(len(rows)))


def test_chunked_running_keeps_null_keys_and_null_order(spark):
    from pyspark.sql import functions as F

    from forecourt.operators.windows import chunked_running
    rows = [("a", 1, 1), ("a", None, 2), (None, 3, 4), (None, None, 8), ("a", 2, 16)]
    df = spark.createDataFrame(rows, "g string, t int, v int")
    out = chunked_running(df, ["g"], ["t", "v"], F.floor(F.col("t") / 2), ["v"], ["v"], "_p")
    got = {(r.g, r.v): (r["_p_rn"], r["_p_cum_v"], r["_p_lag_v"]) for r in out.collect()}
    assert got == {("a", 1): (1, 1, None), ("a", 16): (2, 17, 1), ("a", 2): (3, 19, 16),
                   (None, 4): (1, 4, None), (None, 8): (2, 12, 4)}


def test_order_quantities_are_never_negative(spark):
    from pyspark.sql import functions as F

    from forecourt.operators.windows import quantity_share
    df = spark.createDataFrame([(f"i{k}", 0.6) for k in range(10)], "item string, score double")
    out = quantity_share(df, [], "score", 6, [F.desc("score"), "item"]).collect()
    assert out and all(r.quantity > 0 for r in out)


def test_keyed_update_takes_whole_rows_and_sets_null(spark):
    from forecourt.sources import io
    target = spark.createDataFrame([(1, "x", "y"), (2, "x", "y"), (3, "x", "y")], "k int, a string, b string")
    new = spark.createDataFrame([(1, "a1", "b9"), (1, "a2", "b1"), (2, None, "b2")], "k int, a string, b string")
    got = {r.k: (r.a, r.b) for r in io.keyed_update(target, new, ["k"], ["a", "b"]).collect()}
    assert got == {1: ("a1", "b9"), 2: ("x", "b2"), 3: ("x", "y")}
    got = {r.k: (r.a, r.b) for r in io.keyed_update(target, new, ["k"], ["a", "b"], set_null=True).collect()}
    assert got == {1: ("a1", "b9"), 2: (None, "b2"), 3: ("x", "y")}


def test_hash_of_large_keys_and_constant_features(spark):
    from pyspark.sql import functions as F

    from forecourt.operators import ml
    keys = [0, 1, 7, 3_500_000_000, 2 ** 62, 123456789012]
    df = spark.createDataFrame([(k,) for k in keys], "k long").select("k", ml.knuth_hash(F.col("k"), 5).alias("h"))
    assert all(r.h == (r.k * 2654435761 + 5) % 2 ** 32 for r in df.collect())
    rows = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "a double, b double")
    assert ml.rescale(rows, rows, {"a": "minmax", "b": "standard"})[1].columns == ["a"]


def test_similar_words_against_every_keyword(spark):
    import difflib

    import __spark_entry__ as E
    from forecourt.plans import text
    sf = "/root/testdata/sf0.01"
    vocab = [r.word for r in text._vocab(spark, sf).collect() if len(r.word) > 2]

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    want = {(w, k) for w in vocab for k in text.KEYWORDS if abs(len(w) - len(k)) <= 1 and edits(w, k) <= 1}
    assert {(r.word, r.keyword) for r in E.queries()["str_15_edit_distance"](spark, sf).collect()} == want
    want = {(w, k) for w in vocab for k in text.KEYWORDS
            if 0.85 <= difflib.SequenceMatcher(None, k, w).ratio() < 1}
    assert {(r.word, r.keyword) for r in E.queries()["str_16_ratio_similarity"](spark, sf).collect()} == want
