"""Registered queries: ``(spark, sf_dir) -> DataFrame`` plus the DuckDB oracle text.

Every query reads the driver's tables (through the graph views of
``plans.fixtures``) and runs the library's operators over them; the
oracle states the same result in SQL over the same tables. Column names
match between the two.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .oracle_base import with_base

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, select: str | None = None, extra_ctes: str = ""):
    """Register a query under ``name``; ``select`` (over the base CTEs) is its oracle."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if select is not None:
            ORACLE[name] = with_base(select, extra_ctes)
        return fn
    return deco


def _load_all():
    # importing the modules registers their queries
    from . import q_layers, q_load, q_merge, q_query, q_records, q_round_trip  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
