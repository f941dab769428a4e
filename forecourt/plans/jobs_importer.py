"""Importer pipeline pieces: vehicle collapse (AGG-32), importer measures
(MTH-03), filter-cascade audit (PRJ-28)."""

from __future__ import annotations

from pyspark.sql import functions as F

from forecourt.functions.fmt import dstr, rnd, sql_rnd
from forecourt.operators import aggs
from forecourt.plans.registry import query
from forecourt.sources.fixtures import COLLAPSE_SQL, collapse_input
from forecourt.sources.tables import LINE_KEY, read

ORACLE: dict[str, str] = {}
MEAS = ["measure_2", "measure_3", "measure_4", "measure_5"]
SUPP = ["measure_13", "measure_14"]
FLAGS = ["No_Registration_Number_Flag", "Registration_Number_No_SLR_Document_RGN_Flag", "SLR_Document_RGN_Flag",
         "Undefined_VHE_Status"]


def sql(name, text):
    ORACLE[name] = text.strip()


def collapsed(spark, d):
    return aggs.vehicle_collapse(collapse_input(spark, d), ["l_orderkey", "l_linenumber"], LINE_KEY[2:],
                                 "invoice_date", "quantity", MEAS, SUPP, "registration_date",
                                 "registration_number", "doc_chs", "doc_rgn", ["l_partkey", "l_suppkey"])


@query("agg_32_vehicle_collapse")
def agg32(spark, d):
    c = collapsed(spark, d)
    return c.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "quantity",
                    dstr("invoice_date").alias("invoice_date"), dstr("registration_date").alias("registration_date"),
                    *[rnd(m).alias(m) for m in MEAS + SUPP], *FLAGS)


def _collapse_sql():
    order = "l_partkey, l_suppkey, l_quantity, l_extendedprice"
    sums = []
    for i, m in enumerate(MEAS + SUPP):
        sums.append(f"sum(CASE WHEN invoice_date = d0 THEN {m} ELSE 0 END) AS a{i}, "
                    f"sum(CASE WHEN invoice_date = d0 OR invoice_date IS NULL THEN {m} ELSE 0 END) AS b{i}, sum({m}) AS c{i}")
    meas = []
    for i, m in enumerate(MEAS):
        meas.append(f"{sql_rnd(f'CASE WHEN b0 <> 0 THEN b{i} WHEN (CASE WHEN q = 1 THEN c0 ELSE a0 END) = 0 THEN c{i} ELSE (CASE WHEN q = 1 THEN a{i} ELSE 0.0 END) END')} AS {m}")
    for i, s in enumerate(SUPP):
        meas.append(f"{sql_rnd(f'a{i + len(MEAS)}')} AS {s}")
    status = ("CASE WHEN nreg = 0 AND nchs > 0 THEN 'No_Registration_Number_Flag' "
              "WHEN nreg > 0 AND nchs > 0 AND nrgn = 0 THEN 'Registration_Number_No_SLR_Document_RGN_Flag' "
              "WHEN nchs > 0 AND nrgn > 0 THEN 'SLR_Document_RGN_Flag' ELSE 'Undefined_VHE_Status' END")
    flags = ", ".join(f"CAST({status} = '{f}' AS BIGINT) AS {f}" for f in FLAGS)
    return f"""WITH {COLLAPSE_SQL.strip()},
st AS (SELECT l_orderkey, l_linenumber, min(invoice_date) AS d0, count(DISTINCT invoice_date) AS nd, count(invoice_date) AS ndated,
  count(*) AS nrows, sum({' + '.join(MEAS)}) AS msum, min(quantity) AS qmin FROM collapse_input GROUP BY l_orderkey, l_linenumber),
j AS (SELECT c.*, st.d0, st.nd,
  CASE WHEN c.invoice_date = st.d0 AND c.quantity = 1 AND st.nd > 1 THEN 0 WHEN c.invoice_date = st.d0 THEN 1 ELSE 2 END AS prio
  FROM collapse_input c JOIN st USING (l_orderkey, l_linenumber)
  WHERE st.msum <> 0 AND st.ndated > 0 AND NOT (st.nrows = 1 AND st.qmin = 0)),
g AS (SELECT l_orderkey, l_linenumber, arg_min(quantity, (prio, {order})) AS q,
  arg_min(l_partkey, ({order})) AS l_partkey, arg_min(l_suppkey, ({order})) AS l_suppkey,
  min(invoice_date) AS invoice_date, min(registration_date) AS registration_date,
  count(DISTINCT registration_number) AS nreg, count(DISTINCT doc_chs) AS nchs, count(DISTINCT doc_rgn) AS nrgn,
  {', '.join(sums)}
  FROM j GROUP BY l_orderkey, l_linenumber)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, q AS quantity,
  strftime(invoice_date, '%Y-%m-%d') AS invoice_date, strftime(registration_date, '%Y-%m-%d') AS registration_date,
  {', '.join(meas)}, {flags}
FROM g"""


sql("agg_32_vehicle_collapse", _collapse_sql())
