"""Catalogue entries of the streamed taxi flow (E: same SQL as the batch form)."""

from __future__ import annotations

from tessera import schemas
from tessera import testviews as tv
from tessera.plans import q_taxi
from tessera.plans.catalog import ORACLE, register
from tessera.session import scratch_path
from tessera.streaming import taxi as st

def scenario(spark, sf, upto: str) -> str:
    """bronze stream -> flagged stream -> weekly views -> top-N view in a fresh folder, as
    far as ``upto`` needs. The source is the lineitem file of ``sf``, read as a stream."""
    base = scratch_path(spark, "taxi_stream")
    src = tv.trips_from_lineitem(
        st.read_stream(spark, sf, tv.table(spark, sf, "lineitem").schema, glob="lineitem.parquet"))
    st.ingest_stream(spark, src, f"{base}/bronze", f"{base}/_ckpt_bronze",
                     metrics=f"{base}/metrics" if upto == "metrics" else None)
    if upto in ("flagged", "top_n"):
        st.flag_stream(spark, f"{base}/bronze", schemas.TRIPS, f"{base}/flagged", f"{base}/_ckpt_flagged")
    if upto in ("weekly", "top_n"):
        st.partials_stream(spark, f"{base}/bronze", schemas.TRIPS, f"{base}/partials", f"{base}/_ckpt_partials", scale=6)
        st.refresh_weekly_from_partials(spark, f"{base}/partials", f"{base}/weekly")
    if upto == "weekly_state":
        st.weekly_state_stream(spark, f"{base}/bronze", schemas.TRIPS, f"{base}/weekly_state",
                               f"{base}/_ckpt_weekly", exact_scale=6)
    if upto == "top_n":
        st.refresh_top_n(spark, f"{base}/flagged", f"{base}/weekly", f"{base}/top_n")
    return base


def _read(spark, sf, name):
    return spark.read.parquet(f"{scenario(spark, sf, name)}/{name}")


@register("stream_bronze", ORACLE["taxi_bronze"])
def q_stream_bronze(spark, sf):
    """T1 + S5 + K7: streamed bronze table (count and exact fare total)."""
    from pyspark.sql import functions as F
    b = st.read_bronze(spark, f"{scenario(spark, sf, 'bronze')}/bronze", schemas.TRIPS)
    return b.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.sum((F.col("fare_amount") * 1000).cast("decimal(18,2)")).cast("double")
                 .alias("fare_total"))


@register("stream_expectation_metrics", ORACLE["expectation_metrics"])
def q_stream_expectation_metrics(spark, sf):
    """P6 in a stream: exact counts over all micro-batches, from the metrics folder."""
    return st.total_counts(spark, f"{scenario(spark, sf, 'metrics')}/metrics").select(
        "expectation", "rows_seen", "rows_kept", "rows_dropped")


@register("stream_flagged_rides", ORACLE["taxi_flagged"])
def q_stream_flagged(spark, sf):
    """Flagged rides streamed from bronze, summarised per (week, zip)."""
    from pyspark.sql import functions as F
    f = _read(spark, sf, "flagged")
    return f.groupBy("week", "zip").agg(
        F.count(F.lit(1)).alias("n_rides"),
        F.sum((F.col("fare_amount") * 1000).cast("decimal(18,2)")).cast("double").alias("fare_total"),
        F.sum(F.col("trip_distance").cast("decimal(18,2)")).cast("double").alias("distance_total"))


@register("stream_weekly_stats", ORACLE["taxi_weekly_stats"])
def q_stream_weekly(spark, sf):
    """T3 + K8: weekly view from the sums and counts that the streamed bronze batches added."""
    return _read(spark, sf, "weekly")


@register("stream_weekly_event_time", ORACLE["taxi_weekly_stats"])
def q_stream_weekly_event_time(spark, sf):
    """T3 (stateful): weekly means kept in the stream's state store, Monday-
    aligned event-time windows, read from the view the stream publishes."""
    return _read(spark, sf, "weekly_state")


@register("stream_top_n", ORACLE["taxi_top_n"])
def q_stream_top_n(spark, sf):
    """T4: gold top-3 view over the streamed silver tables."""
    return _read(spark, sf, "top_n")


__all__ = ["q_taxi"]
