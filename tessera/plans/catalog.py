"""Query catalogue: ``queries()`` and ``oracle_sql()`` of ``__spark_entry__``.

Each entry is a Spark builder ``(spark, sf_dir) -> DataFrame`` over the full
test tables, plus (where SQL can express it) the DuckDB SQL of the same
result. Computed columns carry the same alias on both sides. Float results
that depend on summation order are rounded identically on both sides; money
sums go through DECIMAL so they are exact in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from tessera.plans import (  # noqa: F401
        q_orders, q_sales, q_shop, q_streams, q_taxi)
