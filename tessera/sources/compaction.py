"""Compaction of small files inside a plain parquet folder (V7).

Only files below a size are rewritten. They are packed into bins of about the target size
inside their partition folder (their sizes come from ``_metadata``, large files are pruned
before they are opened), each bin becomes one file, a file alone in its bin stays. Large
files keep their names and bytes.

The new files are first written, with the list of the files they replace, to the hidden
folder ``_compaction`` of the table. Then the old files go and the new ones move in. If
that is broken off, the rows are all in the hidden folder and the next compaction (or
``finish``) ends it; repeated steps do nothing twice. One writer at a time; a reader in
between may miss rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

HIDDEN = "_compaction"


def small_files(df: DataFrame, cols: Sequence[str], small_bytes: int, target_bytes: int) -> DataFrame:
    """``(file, bin, *cols)`` of the files to rewrite: those under ``small_bytes`` that share a
    bin with another. A bin ends with the file that takes it to ``target_bytes``. The
    windows run over rows of the file list only."""
    files = df.select(*cols, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    files = files.where(F.col("size") < small_bytes).distinct()
    folder = Window.partitionBy(*cols) if cols else Window.partitionBy(F.lit(0))
    upto = folder.orderBy("file").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    files = files.withColumn("bin", F.floor((F.sum("size").over(upto) - F.col("size")) / target_bytes))
    in_bin = Window.partitionBy(*cols, "bin")
    return files.withColumn("n", F.count(F.lit(1)).over(in_bin)).where("n > 1").select("file", "bin", *cols)


def compact_files(df: DataFrame, path: str, cols: Sequence[str], target_bytes: int = 128 << 20,
                  small_bytes: int | None = None) -> int:
    """Rewrite the small files of the folder ``path``, which ``df`` reads and which is partitioned
    by ``cols``; returns how many files went. ``small_bytes``: half the target if not given."""
    spark, cols, small = df.sparkSession, list(cols), small_bytes or target_bytes // 2
    finish(spark, path)
    hidden = f"{path}/{HIDDEN}"
    small_files(df, cols, small, target_bytes).write.parquet(f"{hidden}/old")
    old = spark.read.parquet(f"{hidden}/old").select(F.col("file").alias("_old"), "bin")
    n = old.count()
    if n:
        rows = df.withColumn("_file", F.col("_metadata.file_path")).where(F.col("_metadata.file_size") < small)
        rows = rows.join(old, F.col("_file") == F.col("_old")).drop("_file", "_old")
        rows.repartition(*cols, "bin").write.partitionBy(*cols, "bin").parquet(f"{hidden}/files")
    finish(spark, path)
    return n


def finish(spark: SparkSession, path: str) -> None:
    """End a compaction whose new files are written; drop one that did not come so far. The
    driver moves and removes files by name, it holds one name at a time."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    hidden = hadoop(f"{path}/{HIDDEN}")
    fs = hidden.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hidden):
        return
    if fs.exists(hadoop(f"{path}/{HIDDEN}/files/_SUCCESS")):
        for row in spark.read.parquet(f"{path}/{HIDDEN}/old").select("file").toLocalIterator():
            fs.delete(hadoop(spark._jvm.java.net.URI(row["file"])), False)
        made = fs.getFileStatus(hadoop(f"{path}/{HIDDEN}/files")).getPath()
        new = fs.listFiles(made, True)
        while new.hasNext():
            file = new.next().getPath()
            if not file.getName().startswith("_"):
                bin_folder = file.getParent()
                place = bin_folder.getParent().toUri().getPath()[len(made.toUri().getPath()):].strip("/")
                folder = hadoop(f"{path}/{place}") if place else hadoop(path)
                fs.mkdirs(folder)
                fs.rename(file, hadoop(folder, f"{bin_folder.getName().replace('=', '-')}-{file.getName()}"))
    fs.delete(hidden, True)
