"""Result formatting shared by every registered query and its SQL twin.

Per-row double arithmetic is bit-identical between engines (IEEE basic ops),
but aggregates sum in different orders and the engines round doubles in
different ways.  Every double that leaves a registered query is therefore
normalised the same way on both sides: cast to DECIMAL(38,10) (recovers the
short decimal a double stands for), then rounded half-even to ``k`` places,
then cast back to DOUBLE.  Dates leave as ISO text, integers as BIGINT.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rnd(c: Column | str, k: int = 4) -> Column:
    """Half-even rounding of a double through an exact decimal (numpy-like
    ``round`` on the decimal the double stands for)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.bround(c.cast("decimal(38,10)"), k).cast("double")


def sql_rnd(expr: str, k: int = 4) -> str:
    # Spark converts a double to DECIMAL through the double's decimal string;
    # DuckDB's direct cast multiplies in floating point, so the twin goes
    # through VARCHAR to convert the same decimal.
    return f"CAST(round_even(CAST(CAST(CAST(({expr}) AS DOUBLE) AS VARCHAR) AS DECIMAL(38,10)), {k}) AS DOUBLE)"


def dstr(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd")


def sql_dstr(expr: str) -> str:
    return f"strftime(CAST(({expr}) AS DATE), '%Y-%m-%d')"


def big(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("bigint")


def sql_big(expr: str) -> str:
    return f"CAST(({expr}) AS BIGINT)"


def mean_money(c: Column | str, k: int = 4) -> Column:
    """Exact half-even rounded mean of 2-decimal amounts (an aggregate):
    decimal average (scale 10) then half-even to ``k`` places."""
    c = F.col(c) if isinstance(c, str) else c
    return F.bround(F.avg(c.cast("decimal(24,6)")), k).cast("double")


def sql_mean_money(expr: str, k: int = 4) -> str:
    """SQL twin of ``mean_money``: integer arithmetic on cents so the
    half-even tie rule is applied to the exact mean (DuckDB's decimal
    average returns a double)."""
    s = f"sum(CAST(round(({expr}) * 100) AS HUGEINT))"
    n = f"count({expr})"
    num = f"(abs({s}) * {10 ** (k - 2)})"
    q = f"({num} // {n})"
    r = f"({num} - {q} * {n})"
    rounded = f"(CASE WHEN 2 * {r} > {n} THEN {q} + 1 WHEN 2 * {r} = {n} THEN {q} + ({q} % 2) ELSE {q} END)"
    return f"CAST(sign({s}) * {rounded} AS DOUBLE) / {10 ** k}"
