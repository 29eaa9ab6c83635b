"""Plain parquet tables that keep their earlier states (V4, V5).

Each row has two more columns: ``valid_from``, the version that wrote it, and ``valid_to``,
the version that replaced or deleted it (``OPEN`` while it is current). Both are partition
columns before the table's own, so

* the state as of a version is a filter on partition columns: only folders that hold rows
  of that state are listed and read;
* a change merges intervals: in the partitions that hold a changed row, that row's interval is
  closed and its successor opened, other rows stay as they are. Rows of closed
  intervals are never read or written again by later changes;
* the history is an aggregate over partition columns, which reads no data column.

A version is meant to be a batch, such as a daily load: each has folders of its own, one per
partition value that it touches, and files are never merged across versions.

A small table beside the rows names each version's operation and columns; a version counts
once its line is there, and readers see the rows of versions that count. One writer at a
time. A change is computed beside the table and moved in by one dynamic partition
overwrite. If it is broken off before its line is written, the next write first takes back
what it opened and closed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from tessera.functions.scalar import true_only
from tessera.operators.util import cols_of
from tessera.sources.tables import ParquetTable, exists

#: ``valid_to`` of current rows.
OPEN = 2 ** 31 - 1
INTERVAL = ("valid_to", "valid_from")
OPERATIONS = "version int, operation string, columns string"


@dataclass(frozen=True)
class HistoryTable:
    spark: SparkSession
    path: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()

    # ---- reading -------------------------------------------------------------

    def version(self) -> int | None:
        """The latest version; none before the first write."""
        path = f"{self.path}/operations"
        if not exists(self.spark, path):
            return None
        return self.spark.read.schema(OPERATIONS).parquet(path).agg(F.max("version")).first()[0]

    def read(self) -> DataFrame:
        """The rows of the latest version."""
        return self._rows().read().where(_valid(self.version())).select(*self.schema.fieldNames())

    def as_of(self, version: int) -> DataFrame:
        """V4: the rows and columns of the state after ``version``."""
        line = self._operations().where(F.col("version") == version).first()
        if line is None:
            raise ValueError(f"no version {version} of {self.path}")
        return self._rows().read().where(_valid(version)).select(*line["columns"].split("\n"))

    def history(self) -> DataFrame:
        """V5: each version's operation, how many rows it opened and closed and how many the
        state after it has. The running sum is over one row per version."""
        rows = self._rows().read()
        opened = rows.groupBy(F.col("valid_from").alias("version")).agg(F.count(F.lit(1)).alias("opened"))
        closed = (rows.where(F.col("valid_to") < OPEN).groupBy(F.col("valid_to").alias("version"))
                  .agg(F.count(F.lit(1)).alias("closed")))
        upto = Window.partitionBy(F.lit(0)).orderBy("version").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return (self._operations().select("version", "operation").join(opened, "version", "left")
                .join(closed, "version", "left").na.fill(0, ["opened", "closed"])
                .withColumn("num_rows", F.sum(F.col("opened") - F.col("closed")).over(upto))
                .withColumn("version", F.col("version").cast("long")))

    # ---- writing -------------------------------------------------------------

    def overwrite(self, df: DataFrame) -> HistoryTable:
        """K3: the rows of ``df`` instead of all current ones, whose intervals end."""
        version, df = self._next(), df.select(*self.schema.fieldNames())
        if version == 0:
            self._put(df, version)
        else:
            self._swap(self._open(), F.lit(True), version, lambda _: df)
        return self._done(version, "WRITE")

    def append(self, df: DataFrame, merge_schema: bool = False, as_is: bool = False) -> HistoryTable:
        """K4 / V6: add rows as a version of their own; schema rules and ``as_is`` as in
        ``ParquetTable.append``. No existing file is touched."""
        fields = ParquetTable(self.spark, self.path, self.schema).merged_schema(df.schema, merge_schema)
        grown = HistoryTable(self.spark, self.path, fields, self.partition_by)
        version = self._next()
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in fields if f.name not in df.columns]
        grown._put(df.select("*", *missing), version, as_is)
        return grown._done(version, "WRITE")

    def change(self, cond: str | Column, apply: Callable[[DataFrame], DataFrame], operation: str | None = None
               ) -> HistoryTable:
        """V1 / V2: current rows where ``cond`` is TRUE end; what ``apply`` makes of them (an
        update gives their successors, a delete nothing) begins. Only partitions that
        hold such a row are rewritten. The operation is UPDATE where rows begin, else DELETE."""
        hit = true_only(F.expr(cond) if isinstance(cond, str) else cond)
        version = self._next()
        self._swap(self._open().where(hit), hit, version, apply)
        begun = self._rows().read().where((F.col("valid_to") == OPEN) & (F.col("valid_from") == version))
        return self._done(version, operation or ("DELETE" if begun.isEmpty() else "UPDATE"))

    def merge(self, source: DataFrame, keys) -> HistoryTable:
        """V3: upsert by key (``source`` unique per key). A current row whose successor differs in
        any column ends and the successor begins; equal rows stay as they are, so
        merging the same source again changes nothing. A null key matches no row."""
        keys, names = cols_of(keys), self.schema.fieldNames()
        source = source.select(*names)
        version = self._next()
        theirs = source.select(*[F.col(c).alias(f"_s_{c}") for c in names])
        on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_s_{k}") for k in keys])
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in names])
        changed = self._open().join(theirs, on & ~same, "left_semi").select(*keys, *INTERVAL, *self.partition_by)
        new = source.join(self._open().select(*keys), keys, "left_anti")

        def split(rows: DataFrame) -> DataFrame:
            old = rows.join(theirs, on & ~same, "left_semi")
            stay = rows.join(theirs, on & ~same, "left_anti")
            begin = source.join(old.select(*keys), keys, "left_semi").unionByName(new)
            return stay.unionByName(self._ended(old, version)).unionByName(self._begun(begin, version))

        self._rows()._rewrite(changed.select(*INTERVAL, *self.partition_by), split)
        return self._done(version, "MERGE")

    def compact(self, target_bytes: int = 128 << 20, small_bytes: int | None = None) -> HistoryTable:
        """V7: as in ``ParquetTable``, of all states; a version without changed rows."""
        self._rows().compact(target_bytes, small_bytes)
        return self._done(self._next(), "OPTIMIZE")

    # ---- parts ---------------------------------------------------------------

    def _rows(self) -> ParquetTable:
        part = [*INTERVAL, *self.partition_by]
        data = [f for f in self.schema if f.name not in self.partition_by]
        own = [f for f in self.schema if f.name in self.partition_by]
        interval = [T.StructField(c, T.IntegerType(), True) for c in INTERVAL]
        return ParquetTable(self.spark, f"{self.path}/rows", T.StructType([*data, *interval, *own]), tuple(part))

    def _open(self) -> DataFrame:
        return self._rows().read().where(F.col("valid_to") == OPEN)

    def _operations(self) -> DataFrame:
        return self.spark.read.schema(OPERATIONS).parquet(f"{self.path}/operations")

    def _next(self) -> int:
        """The version to write. What a broken-off attempt at it left is taken back first: rows it
        opened go, rows it closed are open again."""
        last = self.version()
        version, rows = 0 if last is None else last + 1, self._rows()
        if not exists(self.spark, rows.path):
            return version
        closed = (F.col("valid_to") >= version) & (F.col("valid_to") < OPEN)
        stray = rows.read().where(closed | (F.col("valid_from") >= version)).select(*rows.partition_by).distinct()
        if not stray.isEmpty():
            opened = stray.where(closed).withColumn("valid_to", F.lit(OPEN))
            rows._rewrite(stray.unionByName(opened), lambda df: df.where(F.col("valid_from") < version).withColumn(
                "valid_to", F.when(closed, F.lit(OPEN)).otherwise(F.col("valid_to"))))
        return version

    def _done(self, version: int, operation: str) -> HistoryTable:
        line = [(version, operation, "\n".join(self.schema.fieldNames()))]
        self.spark.createDataFrame(line, OPERATIONS).coalesce(1).write.mode("append").parquet(f"{self.path}/operations")
        return self

    def _begun(self, rows: DataFrame, version: int) -> DataFrame:
        return rows.withColumn("valid_from", F.lit(version)).withColumn("valid_to", F.lit(OPEN)).select(
            *self._rows().schema.fieldNames())

    def _ended(self, rows: DataFrame, version: int) -> DataFrame:
        return rows.withColumn("valid_to", F.lit(version)).select(*self._rows().schema.fieldNames())

    def _put(self, df: DataFrame, version: int, as_is: bool = False) -> None:
        """Rows of a new version in folders of their own, so doing it again replaces them."""
        part, rows = self._rows().partition_by, self._begun(df, version)
        ((rows if as_is else rows.hint("rebalance", *part)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*part).parquet(self._rows().path))

    def _swap(self, ending: DataFrame, hit: Column, version: int, apply: Callable[[DataFrame], DataFrame]) -> None:
        def split(rows: DataFrame) -> DataFrame:
            old = rows.where(hit)
            begin = apply(old.select(*self.schema.fieldNames()))
            return (rows.where(~hit).unionByName(self._ended(old, version))
                    .unionByName(self._begun(begin, version)))

        self._rows()._rewrite(ending.select(*INTERVAL, *self.partition_by), split)


def _valid(version: int) -> Column:
    return (F.col("valid_from") <= version) & (F.col("valid_to") > version)
