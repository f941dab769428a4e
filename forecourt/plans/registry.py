"""Query registry.  ``@query(name, sql)`` registers a callable
``(spark, sf_dir) -> DataFrame``; ``sql`` is the oracle text (None when the
operator is not SQL-expressible, e.g. iterative ML)."""

from __future__ import annotations

import importlib
from collections.abc import Callable

_REG: dict[str, tuple[Callable, str | None]] = {}

_MODULES = (
    "forecourt.plans.retail",
    "forecourt.plans.cleaning",
    "forecourt.plans.joins",
    "forecourt.plans.windows",
    "forecourt.plans.aggregates",
    "forecourt.plans.jobs_importer",
    "forecourt.plans.parts",
    "forecourt.plans.text",
    "forecourt.plans.measures",
    "forecourt.plans.alloc",
    "forecourt.plans.classify",
    "forecourt.plans.cleaning2",
    "forecourt.plans.io",
    "forecourt.plans.ml",
    "forecourt.plans.streams",
    "forecourt.plans.jobs",
    "forecourt.plans.extras",
    "forecourt.plans.jobs_chains",
)


def query(name: str, sql: str | None = None, stored: bool = False):
    """``stored``: the result is written to a run-scoped table and read back."""
    def deco(fn):
        if name in _REG:
            raise ValueError(f"duplicate query {name}")
        _REG[name] = (_written(fn, name) if stored else fn, sql)
        return fn
    return deco


def _written(fn, name: str):
    def run(spark, sf_dir):
        from forecourt.sources import io
        return io.stored(fn(spark, sf_dir), name)
    return run


_ORACLE: dict[str, str] = {}


def _load():
    for m in _MODULES:
        mod = importlib.import_module(m)
        _ORACLE.update(getattr(mod, "ORACLE", {}))


def _utc(fn):
    """Queries are defined in UTC (the source timestamps are zone-free, but
    conversions to instants and epoch seconds use the session zone)."""
    def run(spark, sf_dir):
        if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def all_queries() -> dict[str, Callable]:
    _load()
    return {k: _utc(v[0]) for k, v in _REG.items()}


def all_sql() -> dict[str, str]:
    _load()
    out = {k: v[1] for k, v in _REG.items() if v[1] is not None}
    out.update({k: v for k, v in _ORACLE.items() if k in _REG})
    return out
