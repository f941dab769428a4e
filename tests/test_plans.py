"""Plan-shape checks: pushdown / pruning reach the scan, bounded sides are
broadcast, the flagship reads its source tables once."""

import re

import __spark_entry__ as E

from .conftest import SF


def _plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_scan_filter_is_pushed_and_pruned(spark):
    p = _plan(E.queries()["src_02_scan_filter"](spark, SF))
    assert re.search(r"PushedFilters: \[[^\]]*l_linestatus", p) and re.search(r"PushedFilters: \[[^\]]*l_returnflag", p)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert "l_comment" not in schema and "l_shipdate" not in schema and "l_tax" in schema


def test_fixed_size_dimension_is_broadcast(spark):
    p = _plan(E.queries()["jon_20_dimension_enrichment"](spark, SF))
    assert "BroadcastExchange" in p


def test_flagship_scans_sources_once(spark):
    df = E.queries()["job_01_retail_scored"](spark, SF)
    p = _plan(df)
    # the scored base is checkpointed: the final plan reads it, not lineitem
    assert len(re.findall(r"lineitem\.parquet", p)) == 0


def test_month_window_frames_run_on_daily_counts(spark):
    p = _plan(E.queries()["win_03_month_windows"](spark, SF))
    assert "RangeFrame" in p


def test_flagship_deals_whole_rows_once_without_their_measures(spark):
    df = E.queries()["job_01_retail_scored"](spark, SF)
    p = _plan(df)
    dealt = [x for x in p.split("\n\n") if "REPARTITION_BY_COL" in x]
    # the group statistics are stored, so the plan has the window of the rows alone
    assert len(re.findall(r"\n\(\d+\) Window\n", p)) == 1 and len(dealt) == 1
    assert "p_retailprice" in dealt[0] and "score_euros" not in dealt[0] and "margin_pct" not in dealt[0]
