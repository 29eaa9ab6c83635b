"""Row-level changes and set operations.

Each is a pure DataFrame -> DataFrame transformation; a table
(``sources.tables``) rewrites the partitions they touch. Conditions use SQL three-valued
logic: only rows where the condition is TRUE are touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tessera.functions.scalar import true_only


def _expr(e) -> Column:
    return F.expr(e) if isinstance(e, str) else e


def update_where(df: DataFrame, cond, sets: dict) -> DataFrame:
    """V1: ``UPDATE ... SET col = expr WHERE cond`` (``cond``/``expr`` may be SQL text)."""
    hit = true_only(_expr(cond))
    return df.withColumns({c: F.when(hit, _expr(v).cast(df.schema[c].dataType))
                           .otherwise(F.col(c)) for c, v in sets.items()})


def delete_where(df: DataFrame, cond) -> DataFrame:
    """V2: ``DELETE WHERE cond``; rows where it is unknown stay."""
    return df.where(~true_only(_expr(cond)))


def concat(a: DataFrame, b: DataFrame) -> DataFrame:
    """All rows of both, matched by column name, duplicates kept."""
    return a.unionByName(b)