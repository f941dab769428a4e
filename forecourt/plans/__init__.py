"""Registered named queries: each is a Spark plan plus (where the semantics
are SQL-expressible) the equivalent SQL text run by the DuckDB oracle."""

from forecourt.plans.registry import all_queries, all_sql  # noqa: F401
