"""Plain partitioned parquet tables.

A table is a folder, a declared schema and its partition columns. Appends add files;
changes and upserts rewrite only the partitions they touch, with Spark's dynamic partition
overwrite. Which partitions are touched stays a distributed semi-join on the partition
columns (pruned at run time), however many they are. A partition that a change empties
has no rows to overwrite it with, so its folder is removed; the driver sees the names of
emptied partitions only, one at a time.

One writer at a time, as with any plain parquet folder. A change is first written beside
the table and then moved in by partition, so a failed computation leaves the table as it was.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tessera.functions.scalar import true_only
from tessera.operators.keyed import upsert
from tessera.operators.util import cols_of
from tessera.session import scratch_path
from tessera.sources.compaction import compact_files
from tessera.sources.writers import write_partitioned


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of the old type is one of the new, and Spark reads parquet files
    of the old type as the new: whole numbers to longer ones, to double (up to int) or to a
    decimal with room for all digits; float to double; decimals with more digits on
    both sides of the point or one."""
    digits = {T.ByteType: 10, T.ShortType: 10, T.IntegerType: 10, T.LongType: 20}  # as Spark asks for
    whole = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
    if type(old) in whole:
        if type(new) in whole:
            return whole.index(type(new)) > whole.index(type(old))
        if isinstance(new, T.DecimalType):
            return new.precision - new.scale >= digits[type(old)]
        return isinstance(new, T.DoubleType) and not isinstance(old, T.LongType)
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new != old and new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return isinstance(old, T.FloatType) and isinstance(new, T.DoubleType)


@dataclass(frozen=True)
class ParquetTable:
    spark: SparkSession
    path: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()

    def read(self) -> DataFrame:
        """The current rows; columns added later are null in older files."""
        return self.spark.read.schema(self.schema).parquet(self.path).select(*self.schema.fieldNames())

    def overwrite(self, df: DataFrame) -> ParquetTable:
        """K3 / K5: the rows of ``df`` instead of all others."""
        write_partitioned(df.select(*self.schema.fieldNames()), self.path, self.partition_by)
        return self

    def append(self, df: DataFrame, merge_schema: bool = False, as_is: bool = False) -> ParquetTable:
        """K4 / V6: add rows; with ``merge_schema`` new columns join the schema of the
        returned table, and a column whose rows have a wider type takes that type: files
        written before are read in it (see ``widens``) and stay as they are. Other types,
        narrower ones too, are refused. ``as_is`` keeps the frame's own partitions, one file
        each, instead of balancing them."""
        schema = self.merged_schema(df.schema, merge_schema)
        if as_is:
            df.write.mode("append").partitionBy(*self.partition_by).parquet(self.path)
        else:
            write_partitioned(df, self.path, self.partition_by, mode="append")
        return ParquetTable(self.spark, self.path, schema, self.partition_by)

    def compact(self, target_bytes: int = 128 << 20, small_bytes: int | None = None) -> ParquetTable:
        """V7: small files of a partition become few; large files stay as they are."""
        compact_files(self.read(), self.path, self.partition_by, target_bytes, small_bytes)
        return self

    def merged_schema(self, rows: T.StructType, merge_schema: bool) -> T.StructType:
        """The table's schema after an append of such rows; an error where it is refused."""
        came = {f.name: f.dataType for f in rows}
        new = [f for f in rows if f.name not in self.schema.fieldNames()]
        other = [f.name for f in self.schema if came.get(f.name, f.dataType) != f.dataType]
        refused = [c for c in other if not merge_schema or not widens(self.schema[c].dataType, came[c])]
        if refused or (new and not merge_schema):
            raise ValueError(f"schema mismatch: new columns {[f.name for f in new]}, other types in {refused}")
        kept = [T.StructField(f.name, came.get(f.name, f.dataType), f.nullable) for f in self.schema]
        return T.StructType([*kept, *[T.StructField(f.name, f.dataType, True) for f in new]])

    def change(self, cond: str | Column, apply: Callable[[DataFrame], DataFrame]) -> ParquetTable:
        """V1 / V2: ``apply`` (an update or delete) to the partitions with a row where
        ``cond`` is TRUE; a table without partitions is rewritten whole."""
        hit = true_only(F.expr(cond) if isinstance(cond, str) else cond)
        return self._rewrite(self.read().where(hit), apply)

    def merge(self, source: DataFrame, keys) -> ParquetTable:
        """V3 / V9: upsert ``source`` (unique per key). Touched are the partitions that hold
        one of its keys or receive one of its rows, so a row may move."""
        keys = cols_of(keys)
        held = self.read().join(source.select(*keys), keys, "left_semi")
        touched = held.select(*self.partition_by).unionByName(source.select(*self.partition_by))
        return self._rewrite(touched, lambda rows: upsert(rows, source.select(*rows.columns), keys))

    def _rewrite(self, touched: DataFrame, apply: Callable[[DataFrame], DataFrame],
                 among: Column | None = None) -> ParquetTable:
        """``among``: a filter on partition columns that holds for all touched partitions."""
        part = list(self.partition_by)
        side = ParquetTable(self.spark, scratch_path(self.spark, "table-change"), self.schema, self.partition_by)
        if not part:
            side.overwrite(apply(self.read()))
            return self.overwrite(side.read())
        # written once: its small size is known when the joins are planned, so the table's rows are not moved by partition
        touched = touched.select(*part).distinct()
        named = ParquetTable(self.spark, scratch_path(self.spark, "table-touched"), touched.schema)
        touched = named.overwrite(touched).read()
        rows = self.read() if among is None else self.read().where(among)
        side.overwrite(apply(_semi(rows, touched, part, "left_semi")))
        emptied = _semi(touched, side.read().select(*part).distinct(), part, "left_anti")
        names = [r.asDict() for r in emptied.select(*[F.col(c).cast("string") for c in part]).toLocalIterator()]
        # the side files hold one partition value each: they move as they are, without a shuffle
        (side.read().write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*part).parquet(self.path))
        for name in names:
            _remove(self.spark, "/".join([self.path, *[_folder(self.spark, c, name[c]) for c in part]]))
        _remove(self.spark, side.path)
        _remove(self.spark, named.path)
        return self


@dataclass(frozen=True)
class KeyedTable:
    """A table whose rows are dealt over ``buckets`` folders by the hash of their key.

    An incoming key can only be in its own bucket, so an upsert needs no search for the
    keys: it reads and rewrites the buckets that the incoming keys hash to, and no other
    file. The number of buckets is fixed for a table; choose it so that a bucket is
    some hundred MB at the size the table will have.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    buckets: int = 64

    BUCKET = "key_bucket"

    def read(self) -> DataFrame:
        """The current rows."""
        return self._table().read().select(*self.schema.fieldNames())

    def overwrite(self, df: DataFrame) -> KeyedTable:
        """K3 / K5: the rows of ``df`` instead of all others."""
        self._table().overwrite(self._dealt(df))
        return self

    def merge(self, source: DataFrame) -> KeyedTable:
        """Upsert ``source`` (unique per key; null keys are inserted as they are). To the
        driver come the numbers of the touched buckets, at most ``buckets``."""
        touched = self._dealt(source).select(self.BUCKET).distinct()
        numbers = sorted(r[0] for r in touched.collect())
        self._table()._rewrite(touched, lambda rows: self._dealt(upsert(rows.drop(self.BUCKET), source, self.keys)),
                               F.col(self.BUCKET).isin(numbers) if numbers else F.lit(False))
        return self

    def _dealt(self, df: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        return df.select(*self.schema.fieldNames()).withColumn(self.BUCKET, bucket)

    def _table(self) -> ParquetTable:
        schema = T.StructType([*self.schema, T.StructField(self.BUCKET, T.IntegerType(), True)])
        return ParquetTable(self.spark, self.path, schema, (self.BUCKET,))


def _semi(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str) -> DataFrame:
    """Semi- or anti-join on partition values, null equal to null."""
    right = right.select(*[F.col(c).alias(f"_p_{c}") for c in cols])
    return left.join(right, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in cols]), how)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _folder(spark: SparkSession, col: str, value: str | None) -> str:
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return names.getPartitionPathString(col, value)


def _remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
