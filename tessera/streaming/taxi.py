"""Taxi medallion flow as Structured Streaming.

* T1 ``ingest_stream``: incremental, append-only ingest of new source files
  with the ``valid_distance`` expectation into a parquet table; the same pass
  counts the rows seen, kept and dropped, exactly, per micro-batch.
* T2 ``flag_stream``: a second stream that reads the bronze table as its
  source, filters suspicious rides and appends them to the silver table.
* T3 ``partials_stream`` and ``refresh_weekly_from_partials``: the weekly
  statistics view from exact sums and counts that each batch adds once;
  ``refresh_weekly`` recomputes the same view over all of bronze.
  ``weekly_stream`` is the event-time alternative: a watermark and a 7-day
  window aligned to Mondays, emitted once a week is final.
* T4 ``refresh_top_n``: the gold view (batch join + top-k; sorting a
  non-aggregated stream is not supported by Spark, and the view is a
  recomputation anyway).

Each stream uses its own checkpoint folder under the shared checkpoint dir and
``trigger(availableNow=True)``: it processes everything new, then stops; a
restart from the checkpoint adds nothing (exactly-once file sink).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from tessera.functions.scalar import true_only
from tessera.operators.quality import expect_or_drop, expectation_counts  # noqa: F401 - the batch form of the counts
from tessera.plans import taxi
from tessera.sources.writers import materialize


DEFAULT_MAX_FILES = 1000


def read_stream(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None,
                max_files: int | None = DEFAULT_MAX_FILES) -> DataFrame:
    """Incremental read of new parquet files under ``path``.

    ``max_files`` bounds one micro-batch (``availableNow`` then drains a large
    backlog in several bounded batches instead of one huge one)."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path).select(*schema.fieldNames())


def write_stream(df: DataFrame, out: str, checkpoint: str, name: str | None = None):
    """K7: append-only parquet sink, exactly-once via the checkpoint."""
    w = (df.writeStream.format("parquet").outputMode("append")
           .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if name:
        w = w.queryName(name)
    return w.start(out)


def ingest_stream(spark: SparkSession, src: DataFrame, out: str, checkpoint: str, metrics: str | None = None):
    """bronze = rows passing ``valid_distance``; with ``metrics`` their counts (P6) go into
    that folder, from the same pass over the same rows.

    Each micro-batch is a folder ``batch=<id>`` of bronze, and one of the counts. A batch that is
    repeated after a failure replaces both, so bronze and counts agree after any number of
    batches, failures and restarts. Readers give the table's schema and select it, as
    ``read_bronze`` and ``read_stream`` do."""
    def publish(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"{taxi.VALID_DISTANCE}_{batch_id}")
        kept, _ = expect_or_drop(batch, taxi.VALID_DISTANCE, taxi.distance_ok(), seen)
        kept.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        if metrics:
            n, dropped = seen.get[f"{taxi.VALID_DISTANCE}_rows"], seen.get[f"{taxi.VALID_DISTANCE}_dropped"]
            write_counts(spark, taxi.VALID_DISTANCE, n, dropped, f"{metrics}/batch={batch_id}")

    bad = F.count_if(~true_only(taxi.distance_ok())).alias(f"{taxi.VALID_DISTANCE}_dropped")
    observed = src.observe(taxi.VALID_DISTANCE, F.count(F.lit(1)).alias(f"{taxi.VALID_DISTANCE}_rows"), bad)  # for its progress
    q = (observed.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def write_counts(spark: SparkSession, name: str, seen: int, dropped: int, path: str) -> None:
    """The counts of one batch as a one-row folder, instead of what it held."""
    one = spark.range(1).select(F.lit(name).alias("expectation"), *[F.lit(v).cast("long").alias(c) for c, v in (
        ("rows_seen", seen), ("rows_kept", seen - dropped), ("rows_dropped", dropped))])
    one.write.mode("overwrite").parquet(path)


def read_bronze(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows that ``ingest_stream`` wrote."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def total_counts(spark: SparkSession, metrics: str) -> DataFrame:
    """Rows seen, kept and dropped over all batches so far."""
    return spark.read.parquet(metrics).groupBy("expectation").agg(
        *[F.sum(c).alias(c) for c in ("rows_seen", "rows_kept", "rows_dropped")])


def flag_stream(spark: SparkSession, bronze_dir: str, schema: T.StructType, out: str,
                checkpoint: str):
    """Silver flagged rides, streamed from the bronze table."""
    q = write_stream(taxi.flagged(read_stream(spark, bronze_dir, schema)), out, checkpoint)
    q.awaitTermination()
    return q


def refresh_weekly(spark: SparkSession, bronze_dir: str, schema: T.StructType, out: str,
                   exact_scale: int | None = None) -> DataFrame:
    """Weekly stats over everything ingested so far (K8 materialize)."""
    materialize(taxi.weekly_stats(read_bronze(spark, bronze_dir, schema), exact_scale), out)
    return spark.read.parquet(out)


def partials_stream(spark: SparkSession, bronze_dir: str, schema: T.StructType, out: str, checkpoint: str,
                    scale: int = 6):
    """T3, kept up to date: each micro-batch of bronze is reduced once to sums and counts per
    week, in a folder of its id, which a repeat replaces. No bronze row is read again."""
    def publish(batch: DataFrame, batch_id: int) -> None:
        taxi.weekly_partials(batch, scale).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    q = (read_stream(spark, bronze_dir, schema).writeStream.foreachBatch(publish)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def refresh_weekly_from_partials(spark: SparkSession, partials_dir: str, out: str) -> DataFrame:
    """The view from the partials of all batches so far (weeks x batches rows)."""
    materialize(taxi.weekly_from_partials(spark.read.parquet(partials_dir).drop("batch")), out)
    return spark.read.parquet(out)


def refresh_top_n(spark: SparkSession, flagged_dir: str, weekly_dir: str, out: str,
                  n: int = 3) -> DataFrame:
    """T4: gold view over the streamed silver tables (K8 materialize)."""
    top = taxi.top_rides(spark.read.parquet(flagged_dir), spark.read.parquet(weekly_dir), n)
    materialize(top, out)
    return spark.read.parquet(out)


def weekly_stream(bronze: DataFrame, delay: str = "1 day", exact_scale: int | None = None
                  ) -> DataFrame:
    """T3, event-time variant: Monday-aligned weekly windows with a watermark.

    The watermark needs a zoned TIMESTAMP, so the naive pickup time is turned
    into an instant without using the session time zone; in append mode rows
    later than the watermark are dropped by Spark.
    ``exact_scale`` gives decimal-exact means (see ``stats.mean_expr``).
    """
    from tessera.operators.stats import mean_expr
    # naive wall time -> the instant with that UTC wall time (no session time
    # zone involved), so windows align to Monday 00:00 of the naive calendar
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", epoch,
                              F.col("tpep_pickup_datetime").cast("timestamp_ntz"))
    ts = F.timestamp_micros(micros)
    day_micros = F.lit(86400 * 1000000)
    week = F.date_from_unix_date(F.floor(F.unix_micros(F.col("w.start")) / day_micros).cast("int"))
    return (bronze.withColumn("_ts", ts).withWatermark("_ts", delay)
                  .groupBy(F.window("_ts", "7 days", "7 days", "4 days").alias("w"))
                  .agg(mean_expr("fare_amount", exact_scale).alias("avg_amount"),
                       mean_expr("trip_distance", exact_scale).alias("avg_distance"))
                  .select(week.alias("week"), "avg_amount", "avg_distance"))


def weekly_state_stream(spark: SparkSession, bronze_dir: str, schema: T.StructType, out: str,
                        checkpoint: str, exact_scale: int | None = None):
    """T3 as a stateful stream: weekly windows kept in the checkpointed state
    store (one row per week: bounded by the time span, not the data volume),
    emitted in complete mode; each micro-batch overwrites the view with the
    current weeks (``foreachBatch`` issues one distributed write per batch)."""
    agg = weekly_stream(read_stream(spark, bronze_dir, schema), exact_scale=exact_scale)

    def publish(batch: DataFrame, _batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    q = (agg.writeStream.outputMode("complete").foreachBatch(publish)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
