"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def cols_of(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row frame (a global aggregate) to every row.

    The one-row side has a size bound of one row by construction, so it is
    broadcast. Catalyst folds the constant join key, so the plan is a
    BroadcastNestedLoopJoin whose build side is that single row: every input
    row meets exactly one row (no pair explosion), and nothing is collected.
    """
    k = "__one"
    return (df.withColumn(k, F.lit(1))
              .join(F.broadcast(one_row.withColumn(k, F.lit(1))), k, "inner")
              .drop(k))


def true_only(cond: Column) -> Column:
    """Unknown (null) counts as false, as in SQL ``WHERE``/``UPDATE``."""
    return F.coalesce(cond, F.lit(False))
