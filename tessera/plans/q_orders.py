"""Catalogue entries of the orders table (E oracles: the SQL of the expected state
after each step). Each query builds the table up to its own step in a fresh folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tessera import schemas
from tessera import testviews as tv
from tessera.functions.scalar import to_day, to_ts
from tessera.operators.layout import cluster_by, layout_report
from tessera.plans import orders_table
from tessera.plans.catalog import register
from tessera.session import scratch_path
from tessera.sources.files import orders_from_rows
from tessera.sources.history import HistoryTable
from tessera.sources.tables import ParquetTable

SPLIT = "1998-01-01"
PARTITION_BY = ("country",)
UPDATE1 = "order_id IN ('1', '2')"
UPDATE2 = "order_id IN ('3', '5', '14999')"
DELETE = "amount < 5000"
N_SMALL = 20


def _batches(spark, sf):
    o = tv.orders_tbl(spark, sf)
    initial = o.where(F.col("order_timestamp") < F.lit(SPLIT).cast("timestamp_ntz"))
    second = (o.where(F.col("order_timestamp") >= F.lit(SPLIT).cast("timestamp_ntz"))
               .withColumn("payment_method", F.expr(
                   "CASE status WHEN 'F' THEN 'CARD' WHEN 'O' THEN 'UPI' END"))
               .withColumn("coupon_code", F.expr("CASE WHEN amount > 300000 THEN 'NEW50' END")))
    return initial, second


def _steps(spark, sf, kind=ParquetTable):
    initial, second = _batches(spark, sf)
    return orders_table.steps(spark, scratch_path(spark, "orders_table"), initial, second, PARTITION_BY,
                              UPDATE1, UPDATE2, DELETE, n_small=N_SMALL, kind=kind)


def table_at(spark, sf, step: str) -> ParquetTable:
    """The table right after ``step``; later steps are not run."""
    return next(t for name, _, t in _steps(spark, sf) if name == step)


BASE = f"""base AS (SELECT *, CAST(order_timestamp AS DATE) AS order_date FROM orders_tbl),
  v0 AS (SELECT * FROM base WHERE order_timestamp < TIMESTAMP '{SPLIT}'),
  v1 AS (SELECT * REPLACE (CASE WHEN {UPDATE1} THEN 'CANCELLED' ELSE status END AS status) FROM v0),
  v2 AS (SELECT *, CAST(NULL AS VARCHAR) AS payment_method, CAST(NULL AS VARCHAR) AS coupon_code FROM v1
         UNION ALL
         SELECT *, CASE status WHEN 'F' THEN 'CARD' WHEN 'O' THEN 'UPI' END AS payment_method,
                CASE WHEN amount > 300000 THEN 'NEW50' END AS coupon_code
         FROM base WHERE order_timestamp >= TIMESTAMP '{SPLIT}'),
  v3 AS (SELECT * REPLACE (CASE WHEN {UPDATE2} THEN 'CANCELLED' ELSE status END AS status) FROM v2),
  v4 AS (SELECT * FROM v3 WHERE NOT coalesce({DELETE}, false)),
  first_row AS (SELECT * FROM v4 ORDER BY order_id LIMIT 1),
  small AS (SELECT * REPLACE ('demo_' || CAST(i AS VARCHAR) AS order_id)
            FROM first_row CROSS JOIN range({N_SMALL}) t(i)),
  final AS (SELECT * FROM v4 UNION ALL SELECT * EXCLUDE (i) FROM small)"""


def O(body: str) -> str:
    return tv.with_views("", "orders_tbl").rstrip() + ",\n  " + BASE + "\n" + body


@register("orders_with_date", tv.with_views(
    "SELECT order_id, CAST(order_timestamp AS DATE) AS order_date, amount FROM orders_tbl",
    "orders_tbl"))
def q_orders_with_date(spark, sf):
    """P13 + X3 + X4: timestamp text -> timestamp -> derived date."""
    o = tv.orders_tbl(spark, sf)
    text = F.date_format("order_timestamp", "yyyy-MM-dd HH:mm:ss")
    return o.select("order_id", to_day(to_ts(text)).alias("order_date"), "amount")


@register("orders_typed_rows", tv.with_views(
    "SELECT order_id, customer_id, country, amount, currency, status, CAST(order_timestamp AS DATE) AS order_date "
    "FROM orders_tbl", "orders_tbl"))
def q_orders_typed_rows(spark, sf):
    """S3: orders that came as rows of text, typed by the declared schema, their time stamps
    parsed after the load and their dates derived."""
    fields = schemas.ORDERS_TEXT.fieldNames()
    o = tv.orders_tbl(spark, sf).withColumn("order_timestamp", F.date_format("order_timestamp", "yyyy-MM-dd HH:mm:ss"))
    typed = orders_from_rows(spark, o.select(*[F.col(c).cast("string").alias(c) for c in fields]), schemas.ORDERS_TEXT)
    return typed.drop("order_timestamp")


@register("partition_pruned_read", O(
    "SELECT * FROM v0 WHERE country = 'NATION_1' AND order_date BETWEEN DATE '1996-01-01' "
    "AND DATE '1996-12-31'"))
def q_partition_pruned_read(spark, sf):
    """K3 + P10: partitioned write, read back with partition + data filters."""
    df = orders_table.pruned_read(table_at(spark, sf, "write"), country="NATION_1")
    return df.where(F.col("order_date").between(F.lit("1996-01-01").cast("date"),
                                                F.lit("1996-12-31").cast("date")))


@register("table_update", O("SELECT * FROM v1"))
def q_table_update(spark, sf):
    """V1 + P11 + X14 + S4: after ``UPDATE ... WHERE order_id IN (...)``."""
    return table_at(spark, sf, "update1").read()


@register("append_evolve", O("SELECT * FROM v2"))
def q_append_evolve(spark, sf):
    """U2 + V6 + K4: append rows carrying two new columns (old rows: null)."""
    return table_at(spark, sf, "append").read()


@register("append_widened", O(
    """SELECT order_id, CAST(floor(amount) AS DECIMAL(18,2)) AS amount, CAST(n AS BIGINT) AS n, country
       FROM (SELECT *, length(order_id) AS n FROM v0)
       UNION ALL SELECT order_id, CAST(amount AS DECIMAL(18,2)), length(order_id) + 5000000000, country FROM base
       WHERE order_timestamp >= TIMESTAMP '""" + SPLIT + "'"))
def q_append_widened(spark, sf):
    """U2 + V6: whole amounts and int counts, then rows with decimal amounts and counts beyond an
    int: the columns take the wider types, earlier files stay and are read in them."""
    first, second = (x.select("order_id", "amount", "country") for x in _batches(spark, sf))
    first = first.select("order_id", F.floor("amount").cast("int").alias("amount"),
                         F.length("order_id").cast("int").alias("n"), "country")
    second = second.select("order_id", F.col("amount").cast("decimal(18,2)").alias("amount"),
                           (F.length("order_id") + F.lit(5_000_000_000)).alias("n"), "country")
    t = ParquetTable(spark, scratch_path(spark, "orders_widened"), first.schema, ("country",))
    return t.overwrite(first).append(second, merge_schema=True).read()


@register("table_delete", O("SELECT * FROM v4"))
def q_table_delete(spark, sf):
    """V1 + V2: second update, then ``DELETE WHERE amount < 5000``."""
    return table_at(spark, sf, "delete").read()


@register("version_as_of", O("SELECT * FROM v0"))
def q_version_as_of(spark, sf):
    """V4: after an update and an append of rows with more columns, the state of the first
    version: a filter on the rows' intervals, which are partition folders."""
    t = next(t for step, _, t in _steps(spark, sf, HistoryTable) if step == "append")
    return t.as_of(0)


@register("version_history", O(
    """SELECT * FROM (VALUES
         (0, 'WRITE', (SELECT count(*) FROM v0)), (1, 'UPDATE', (SELECT count(*) FROM v1)),
         (2, 'WRITE', (SELECT count(*) FROM v2)), (3, 'UPDATE', (SELECT count(*) FROM v3)),
         (4, 'DELETE', (SELECT count(*) FROM v4)), (5, 'WRITE', (SELECT count(*) FROM final)),
         (6, 'OPTIMIZE', (SELECT count(*) FROM final))) t(version, operation, num_rows)"""))
def q_version_history(spark, sf):
    """V5: the operations of the whole flow and the rows of the state after each, an
    aggregate over the rows' intervals."""
    *_, (_, _, t) = _steps(spark, sf, HistoryTable)
    return t.history().select("version", "operation", "num_rows")


@register("compact_table", O("SELECT * FROM final"))
def q_compact_table(spark, sf):
    """V7: after 20 small files, compaction keeps every row; still partitioned."""
    return table_at(spark, sf, "compact").read()


def _clustered(spark, sf, cols) -> DataFrame:
    """The rows as an unpartitioned raw table, clustered by ``cols`` and read back."""
    t, path = table_at(spark, sf, "small"), scratch_path(spark, "orders_clustered")
    cluster_by(t.read(), cols, 8).write.parquet(path)
    return spark.read.schema(t.schema).parquet(path)


@register("cluster_table", O("SELECT * FROM final"))
def q_cluster_table(spark, sf):
    """V8: clustering the raw table by customer_id keeps every row."""
    return _clustered(spark, sf, ["customer_id"])


@register("cluster_table_zorder", O("SELECT * FROM final"))
def q_cluster_table_zorder(spark, sf):
    """V8, several columns: Z-order clustering, written as files and read back."""
    return _clustered(spark, sf, ["customer_id", "order_date", "amount", "status"])


@register("layout_report", O(
    """SELECT country, 'compact' AS state, count(*) AS n_rows, TRUE AS fewer_files FROM final GROUP BY country
       UNION ALL SELECT country, 'small' AS state, count(*) AS n_rows, NULL AS fewer_files FROM final GROUP BY country"""))
def q_layout_report(spark, sf):
    """K9: files, bytes and rows per partition before and after compaction. The oracle
    compares the rows and that no partition has more files than before."""
    reports = []
    for step, _, t in _steps(spark, sf):
        if step in ("small", "compact"):  # kept, as the next step changes the same files
            report = layout_report(t.read(), ["country"]).withColumn("state", F.lit(step))
            path = scratch_path(spark, "orders_layout")
            report.write.parquet(path)
            reports.append(spark.read.schema(report.schema).parquet(path))
    both = reduce(DataFrame.unionByName, reports)
    before = reports[0].select("country", F.col("n_files").alias("_before"))
    return both.join(before, "country").select(
        "country", "state", "n_rows",
        F.when(F.col("state") == "compact", F.col("n_files") <= F.col("_before")).alias("fewer_files"))
