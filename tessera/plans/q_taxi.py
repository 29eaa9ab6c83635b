"""Catalogue entries of the taxi flow (batch)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import testviews as tv
from tessera.operators.quality import count_violations
from tessera.operators.stats import group_count, top_n
from tessera.plans import taxi
from tessera.plans.catalog import register

WEEK_SQL = "CAST(date_trunc('week', tpep_pickup_datetime) AS DATE)"
BRONZE_SQL = "bronze AS (SELECT * FROM trips WHERE trip_distance > 0.0)"
FLAGGED_SQL = f"""flagged AS (
  SELECT {WEEK_SQL} AS week, pickup_zip AS zip, fare_amount, trip_distance
  FROM bronze
  WHERE (pickup_zip = dropoff_zip AND fare_amount > 50) OR (trip_distance < 5 AND fare_amount > 50))"""


def exact_mean_sql(c: str, scale: int = 6) -> str:
    return (f"CAST(sum(CAST({c} AS DECIMAL(38,{scale}))) AS DOUBLE) / "
            f"CAST(count({c}) AS DOUBLE)")


def spark_round_sql(x: str, n: int) -> str:
    """SQL ROUND as Spark evaluates it: half-up on the double's decimal text."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,12)), {n}) AS DOUBLE)"


WEEKLY_SQL = f"""weekly AS (
  SELECT {WEEK_SQL} AS week, {exact_mean_sql("fare_amount")} AS avg_amount,
         {exact_mean_sql("trip_distance")} AS avg_distance
  FROM bronze GROUP BY 1)"""


def _sql(body: str, *ctes: str) -> str:
    return tv.with_views(body, "trips") if not ctes else \
        tv.with_views("", "trips").rstrip() + ",\n" + ",\n".join(ctes) + "\n" + body


def _bronze(spark, sf):
    return taxi.bronze(tv.trips(spark, sf))


@register("taxi_bronze", _sql("SELECT count(*) AS n_rows, "
                              "CAST(sum(CAST(fare_amount * 1000 AS DECIMAL(18,2))) AS DOUBLE) AS fare_total "
                              "FROM bronze", BRONZE_SQL))
def taxi_bronze(spark, sf):
    """Rows kept by the expectation (count and exact fare total)."""
    b = _bronze(spark, sf)
    return b.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.sum((F.col("fare_amount") * 1000).cast("decimal(18,2)")).cast("double")
                 .alias("fare_total"))


@register("expectation_metrics", _sql(
    "SELECT 'valid_distance' AS expectation, count(*) AS rows_seen, "
    "count(*) FILTER (WHERE coalesce(trip_distance > 0.0, false)) AS rows_kept, "
    "count(*) FILTER (WHERE NOT coalesce(trip_distance > 0.0, false)) AS rows_dropped FROM trips"))
def expectation_metrics(spark, sf):
    """P6 counts: rows seen / kept / dropped by ``valid_distance``."""
    return taxi.bronze_metrics(tv.trips(spark, sf))


@register("invalid_after_bronze", _sql(
    "SELECT count(*) AS invalid_trip_distance_rows FROM bronze WHERE trip_distance <= 0", BRONZE_SQL))
def invalid_after_bronze(spark, sf):
    """Re-check that no violating row passed the expectation (0)."""
    return count_violations(_bronze(spark, sf), F.col("trip_distance") <= 0,
                            "invalid_trip_distance_rows")


@register("bronze_sample", _sql(
    "SELECT * FROM bronze ORDER BY tpep_pickup_datetime NULLS FIRST, pickup_zip, dropoff_zip, "
    "fare_amount, trip_distance LIMIT 10", BRONZE_SQL))
def bronze_sample(spark, sf):
    """A 10-row peek at bronze, after a total order."""
    return top_n(_bronze(spark, sf), [F.col(c).asc_nulls_first() for c in (
        "tpep_pickup_datetime", "pickup_zip", "dropoff_zip", "fare_amount", "trip_distance")], 10)


@register("taxi_flagged", _sql(
    "SELECT week, zip, count(*) AS n_rides, "
    "CAST(sum(CAST(fare_amount * 1000 AS DECIMAL(18,2))) AS DOUBLE) AS fare_total, "
    "CAST(sum(CAST(trip_distance AS DECIMAL(18,2))) AS DOUBLE) AS distance_total "
    "FROM flagged GROUP BY week, zip", BRONZE_SQL, FLAGGED_SQL))
def taxi_flagged(spark, sf):
    """P5 + P12: flagged rides, summarised per (week, zip) with exact totals."""
    f = taxi.flagged(_bronze(spark, sf))
    return f.groupBy("week", "zip").agg(
        F.count(F.lit(1)).alias("n_rides"),
        F.sum((F.col("fare_amount") * 1000).cast("decimal(18,2)")).cast("double").alias("fare_total"),
        F.sum(F.col("trip_distance").cast("decimal(18,2)")).cast("double").alias("distance_total"))


@register("flagged_per_week", _sql(
    "SELECT week, count(*) AS flagged_count FROM flagged GROUP BY week ORDER BY week",
    BRONZE_SQL, FLAGGED_SQL))
def flagged_per_week(spark, sf):
    """G5 + O1: flagged rides per week, ordered by week."""
    f = taxi.flagged(_bronze(spark, sf))
    return group_count(f, "week", "flagged_count").orderBy("week")


@register("taxi_weekly_stats", _sql(
    "SELECT week, avg_amount, avg_distance FROM weekly", BRONZE_SQL, WEEKLY_SQL))
def taxi_weekly_stats(spark, sf):
    """G4 + X5: weekly mean fare and distance over bronze."""
    return taxi.weekly_stats(_bronze(spark, sf), exact_scale=6)


@register("taxi_top_n", _sql(
    f"""SELECT w.week AS week, {spark_round_sql("w.avg_amount", 2)} AS avg_amount,
              {spark_round_sql("w.avg_distance", 3)} AS avg_distance,
              f.fare_amount, f.trip_distance, f.zip
       FROM (SELECT * FROM flagged
             ORDER BY fare_amount DESC NULLS LAST, week ASC NULLS FIRST, zip ASC NULLS FIRST,
                      trip_distance ASC NULLS FIRST LIMIT 3) f
       LEFT JOIN weekly w ON w.week = f.week""", BRONZE_SQL, FLAGGED_SQL, WEEKLY_SQL))
def taxi_top_n(spark, sf):
    """J1 + O2 + X6: the gold view: top 3 fares with their week's rounded means."""
    out = taxi.run(tv.trips(spark, sf), n=3, exact_scale=6)
    return out["top_n"]
