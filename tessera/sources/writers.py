"""Sinks (K1-K6, K8).

Writers never read and overwrite the same folder in one job (changes of a table
are written beside it first, see ``sources.tables``). Partitioned writes
repartition by the partition columns first so each partition value is
written by one task, giving one file per partition instead of one per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: CSV with header, no index; time stamps as ISO text."""
    (df.write.mode(mode).option("header", True)
       .option("timestampFormat", TS_FORMAT).option("timestampNTZFormat", TS_FORMAT)
       .csv(path))


def write_json(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none",
               records_per_file: int = 0) -> None:
    """K2: JSON records (one per line), ISO time stamps, nulls kept. A compressed file is
    read by one task: ``records_per_file`` (0: no bound) keeps each small."""
    (df.write.mode(mode).option("ignoreNullFields", False).option("timestampNTZFormat", TS_FORMAT)
       .option("maxRecordsPerFile", records_per_file).json(path, compression=compression))


def write_partitioned(df: DataFrame, path: str, cols: Sequence[str], mode: str = "overwrite",
                      files_per_partition: int | None = None) -> None:
    """K3 / K4: partitioned parquet write (overwrite or append).

    By default the rows are rebalanced by the partition columns (``rebalance``
    hint): AQE keeps each partition value in one task (one file per value)
    when it is small, and splits a value larger than the advisory partition
    size over several tasks, so a partition value holding a third of all rows
    is not written by one task. ``files_per_partition`` instead fixes the
    number of files per value with a hash salt.
    """
    cols = list(cols)
    if files_per_partition and files_per_partition > 1:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_partition))
        df = df.repartition(*[F.col(c) for c in cols], salt)
    elif cols:
        df = df.hint("rebalance", *cols)
    w = df.write.mode(mode)
    (w.partitionBy(*cols) if cols else w).parquet(path)


def truncate_and_load(df: DataFrame, path: str) -> None:
    """K5: empty a staging table and load it: one overwrite."""
    df.write.mode("overwrite").parquet(path)


def write_text_lines(df: DataFrame, path: str) -> None:
    """K6: one text line per row of a single ``value`` column; an empty frame
    writes an empty folder (no line)."""
    df.coalesce(1).write.mode("overwrite").text(path)


def materialize(df: DataFrame, path: str) -> None:
    """K8: materialise a view (recomputed from its inputs) as parquet."""
    df.write.mode("overwrite").parquet(path)
