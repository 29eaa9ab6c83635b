"""Orders table flow (A3) on plain partitioned parquet, or on a table that keeps its history.

Partitioned write -> pruned read -> update -> append with new columns -> update -> delete
-> small files -> compaction of the partitioned table; beside it an unpartitioned raw
table is clustered. Updates and deletes rewrite only the partitions they touch,
compaction only small files.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from tessera.operators.changes import delete_where, update_where
from tessera.operators.filters import read_partition, with_columns
from tessera.functions.scalar import to_day
from tessera.sources.history import HistoryTable
from tessera.sources.tables import ParquetTable

STEPS = ("write", "update1", "append", "update2", "delete", "small", "compact")


def with_order_date(df: DataFrame) -> DataFrame:
    """P13 + X4: derived partition column ``order_date``."""
    return with_columns(df, {"order_date": to_day("order_timestamp")})


def pruned_read(table: ParquetTable, **equals) -> DataFrame:
    """P10: filter on partition columns; the scan lists only matching folders."""
    return read_partition(table.read(), **equals)


def small_files(table: ParquetTable | HistoryTable, n: int, order: Sequence[str] = ("order_id",)
                ) -> ParquetTable | HistoryTable:
    """Append ``n`` copies of the first row under ``order`` (decision F10) as new orders,
    one file each: the state that compaction is for."""
    first = table.read().orderBy(*order).limit(1)
    copies = first.crossJoin(table.spark.range(n)).withColumn(
        "order_id", F.concat(F.lit("demo_"), F.col("id").cast("string"))).drop("id")
    return table.append(copies.repartitionByRange(n, "order_id"), as_is=True)


def steps(spark, path: str, initial: DataFrame, second_batch: DataFrame, partition_by: Sequence[str],
          first_update: str, second_update: str, delete_cond: str, n_small: int = 20,
          kind: type[ParquetTable] | type[HistoryTable] = ParquetTable
          ) -> Iterator[tuple[str, str, ParquetTable | HistoryTable]]:
    """Run the flow on the folder ``path`` as a table of this kind: ``(step, operation, table)``
    after each step. The next step changes the same folder in place."""
    cancel = {"status": "'CANCELLED'"}
    rows = with_order_date(initial)
    schema = T.StructType([*[f for f in rows.schema if f.name not in partition_by],
                           *[rows.schema[c] for c in partition_by]])
    t = kind(spark, path, schema, tuple(partition_by)).overwrite(rows)
    yield "write", "WRITE", t
    t = t.change(first_update, lambda df: update_where(df, first_update, cancel))
    yield "update1", "UPDATE", t
    t = t.append(with_order_date(second_batch), merge_schema=True)
    yield "append", "WRITE", t
    t = t.change(second_update, lambda df: update_where(df, second_update, cancel))
    yield "update2", "UPDATE", t
    t = t.change(delete_cond, lambda df: delete_where(df, delete_cond))
    yield "delete", "DELETE", t
    t = small_files(t, n_small)
    yield "small", "WRITE", t
    yield "compact", "OPTIMIZE", t.compact()
