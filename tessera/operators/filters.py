"""Projections, filters and predicates.

All are plain ``filter`` / ``select`` / ``withColumn`` calls, so Catalyst
pushes simple comparisons into the parquet scan (``PushedFilters``) and
prunes partitions (``PartitionFilters``) when the predicate is on a partition
column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tessera.functions.scalar import int_or_zero, true_only


def where_equals(df: DataFrame, col: str, value) -> DataFrame:
    """Equality filter."""
    return df.where(F.col(col) == F.lit(value))


def between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Closed range. For a timestamp column a bare upper date means
    midnight, so later on that day is outside (pandas semantics)."""
    dtype = dict(df.dtypes)[col]
    c = F.col(col)
    if dtype.startswith("timestamp"):
        lo_c, hi_c = F.lit(lo).cast(dtype), F.lit(hi).cast(dtype)
    else:
        lo_c, hi_c = F.lit(lo), F.lit(hi)
    return df.where((c >= lo_c) & (c <= hi_c))


def greater_than(df: DataFrame, col: str, threshold) -> DataFrame:
    """Strictly-greater filter."""
    return df.where(F.col(col) > F.lit(threshold))


def not_equal_count(df: DataFrame, col: str, value, alias: str = "n") -> DataFrame:
    """Rows where ``col != value`` (SQL: null is not counted), as a count."""
    return df.where(F.col(col) != F.lit(value)).agg(F.count(F.lit(1)).alias(alias))


def suspicious_ride(fare: float = 50.0, distance: float = 5.0) -> Column:
    """P5 predicate: same zip and fare > f, or distance < d and fare > f."""
    f, z1, z2, d = (F.col("fare_amount"), F.col("pickup_zip"), F.col("dropoff_zip"),
                    F.col("trip_distance"))
    return ((z1 == z2) & (f > fare)) | ((d < distance) & (f > fare))


def flag_rides(df: DataFrame, fare: float = 50.0, distance: float = 5.0) -> DataFrame:
    """P5: keep suspicious rides."""
    return df.where(suspicious_ride(fare, distance))


def positive_quantity(df: DataFrame, col: str = "quantity") -> DataFrame:
    """Load-time filter: quantity as int (missing/bad = 0) must be > 0."""
    return df.withColumn(col, int_or_zero(col)).where(F.col(col) > 0)


def clean_staging(df: DataFrame) -> DataFrame:
    """``DELETE WHERE quantity <= 0 OR customer_id IS NULL OR product_id IS NULL``.

    Only rows where the condition is TRUE go: a null quantity with both keys
    present makes the condition unknown, so that row stays.
    """
    cond = (F.col("quantity") <= 0) | F.col("customer_id").isNull() | F.col("product_id").isNull()
    return df.where(~true_only(cond))


def read_partition(df: DataFrame, **equals) -> DataFrame:
    """P10: filter on (partition) columns; Spark prunes the directories."""
    out = df
    for c, v in equals.items():
        out = out.where(F.col(c) == F.lit(v))
    return out


def with_columns(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """Add derived or literal columns."""
    return df.withColumns(cols)


def case_flag(cond: Column) -> Column:
    """``CASE WHEN cond THEN TRUE ELSE FALSE END`` (unknown -> FALSE)."""
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))
