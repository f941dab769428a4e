"""Every registered query runs on sf0.001 and its SQL twin gives the same
rows (row count, column names, order-insensitive value hash).  Model-fitting
queries (mlx_, job_) run only with FORECOURT_FULL=1 (they are rows-only and
slow); the driver's own check covers them."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from forecourt.sources.tables import TABLES, path
from scripts.compare import digest

from .conftest import SF

QUERIES = E.queries()
SQL = E.oracle_sql()
FULL = os.environ.get("FORECOURT_FULL") == "1"
NAMES = sorted(n for n in QUERIES if FULL or n in SQL)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path(SF, t)}')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        return
    rel = con.sql(SQL[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert digest(rows, df.columns)[0] == digest(orows, rel.columns)[0]
