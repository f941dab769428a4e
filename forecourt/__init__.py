"""forecourt: Spark-native operators and jobs for automotive retail, after-sales,
service-desk and fleet analytics.

Layout
  sources/    readers, gates, sinks and the fixture views over the driver tables
  functions/  column-expression helpers (text, measures, dates, output format)
  operators/  DataFrame -> DataFrame operators (clean, joins, aggs, windows, sets,
              rules, allocation, ML)
  plans/      registered named queries (Spark plan + equivalent SQL) and jobs
  streaming/  Structured Streaming variants of the incremental operators
"""

__all__ = ["session"]
