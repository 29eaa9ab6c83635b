"""File readers (S1, S2, S3, S6). Every reader takes a declared schema.

Ingest order: a row's position in its landing file is exposed as the column
``_ingest`` = (file path, split start, position inside the split), built from
Spark's ``_metadata`` columns and ``monotonically_increasing_id`` (which is
increasing inside one split). Sorting by it gives file order whatever the
partition layout; it is what "last row of the file wins" (W3) orders by.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tessera.sources.json_arrays import TASK_BYTES, elements

#: Bytes of JSON records that a byte of a compressed file holds, about.
PACKED = 6


def _with_ingest(df: DataFrame) -> DataFrame:
    return df.withColumn("_ingest", F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos")))


def read_csv(spark: SparkSession, path, schema: T.StructType, ingest_order: bool = False,
             date_format: str | None = None) -> DataFrame:
    """CSV with a header row into a typed table (``path`` may be a list).

    Empty fields are null; a literal ``NONE`` stays a string.
    """
    r = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    if date_format:
        r = r.option("dateFormat", date_format)
    df = r.csv(path)
    return _with_ingest(df) if ingest_order else df


def read_json_records(spark: SparkSession, path, schema: T.StructType, ingest_order: bool = False,
                      array_file: bool = True, raw: str | None = None, split: bool | None = None) -> DataFrame:
    """S2 + X11: files that each hold one JSON array of records; with ``array_file=False``
    JSON lines. ``raw`` names a column with each record's own JSON text, unknown fields,
    nulls and numbers included. A file that is no array gives no record, a line or an
    element that is no record gives one of nulls.

    An array file is read whole by one task, or, with ``split``, by many (see
    ``json_arrays``): the same records in the same order. Left out, files are split where
    one is larger than ``spark.sql.files.maxPartitionBytes`` (a compressed one: unpacked, about).
    A task takes small array files together, about ``TASK_BYTES`` of text, so that what it
    shuffles is reduced by key and compressed over many records."""
    paths = path if isinstance(path, str) else list(path)
    largest, total = _sizes(spark, paths) if array_file and not split else (0, 0)
    if array_file and (largest > _split_bytes(spark) if split is None else split):
        rows = elements(spark, paths)
    else:
        text = spark.read.option("wholetext", array_file).text(paths)
        if array_file:
            text = text.coalesce(max(spark.sparkContext.defaultParallelism, total // TASK_BYTES))
        text = text.select("value", F.struct(F.col("_metadata.file_path").alias("file"),
                                             F.col("_metadata.file_block_start").alias("block"),
                                             F.monotonically_increasing_id().alias("line")).alias("at"))
        if array_file:
            rows = text.select("at", F.posexplode(F.from_json("value", "array<string>")).alias("pos", "text"))
        else:
            rows = text.select("at", F.lit(0).alias("pos"), F.col("value").alias("text"))
    rows = rows.select(F.col("text"), F.from_json("text", schema).alias("r"),
                       F.struct("at.file", "at.block", F.struct("at.line", "pos").alias("pos")).alias("_ingest"))
    return rows.select("r.*", *([F.col("text").alias(raw)] if raw else []), *(["_ingest"] if ingest_order else []))


def _split_bytes(spark: SparkSession) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes"))


def _sizes(spark: SparkSession, paths) -> tuple[int, int]:
    """Bytes of text of the largest file and of all (a listing; no file is opened)."""
    packed = F.col("path").rlike(r"\.(gz|bz2|zst|lz4|snappy|deflate)$")
    size = F.when(packed, F.col("length") * PACKED).otherwise(F.col("length"))
    files = spark.read.format("binaryFile").load(paths).coalesce(spark.sparkContext.defaultParallelism)
    row = files.agg(F.max(size), F.sum(size)).first()
    return row[0] or 0, row[1] or 0


def landing_path(base: str, entity: str, run_date, ext: str) -> str:
    """``{base}/{entity}/{entity}_{yyyymmdd}.{ext}`` for one run date."""
    d = run_date if isinstance(run_date, (_dt.date, _dt.datetime)) else \
        _dt.date.fromisoformat(str(run_date))
    return f"{base.rstrip('/')}/{entity}/{entity}_{d.strftime('%Y%m%d')}.{ext}"


def landing_paths(base: str, entity: str, run_dates, ext: str) -> list[str]:
    """S6 for a backfill: one multi-path read instead of a loop of reads."""
    return [landing_path(base, entity, d, ext) for d in run_dates]


def orders_from_rows(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """S3: rows + declared schema; ``order_timestamp`` text parsed after load and ``order_date``
    derived (X3, X4). ``rows`` are literal rows, or a frame of text columns (rows that came as
    text), whose values are cast to the declared types."""
    if isinstance(rows, DataFrame):
        df = rows.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    else:
        df = spark.createDataFrame(rows, schema)
    return (df.withColumn("order_timestamp", F.to_timestamp("order_timestamp"))
              .withColumn("order_date", F.to_date("order_timestamp")))
