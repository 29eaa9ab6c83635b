"""Daily shop warehouse load (A4), set-based.

stage (truncate + load, last row of a file wins per key; orders need
quantity > 0) -> transform (clean staging, upsert dimensions, latest row per
order -> fact rows with currency flag and load date -> fact upsert) ->
data-quality report (all must pass) -> volume status (low-volume branch and
anomaly note).

The reference sends one INSERT per landing row; here every step is one
DataFrame job over the whole file (or many dated files at once for a
backfill). Upserts shuffle both sides by key once; nothing goes through the
driver except the final pass/fail boolean of the checks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tessera import schemas
from tessera.functions.scalar import record_json, run_timestamp, utc_wall_time
from tessera.operators.checks import Check, equal_counts, no_nulls, not_empty, run_checks
from tessera.operators.filters import case_flag, clean_staging, positive_quantity
from tessera.operators.keyed import last_per_key, latest_per_key, upsert
from tessera.operators.quality import anomaly_lines, volume_status

LANDING_FIELDS = ["order_id", "order_timestamp", "customer_id", "product_id", "quantity",
                  "total_amount", "currency", "status"]
# Fixed values of the daily load.
MIN_ORDER_THRESHOLD = 10
HOME_CURRENCY = "USD"


def stage_customers(landing: DataFrame, ingest_order: Sequence) -> DataFrame:
    return schemas.conform(last_per_key(landing, "customer_id", ingest_order),
                           schemas.STG_CUSTOMERS)


def stage_products(landing: DataFrame, ingest_order: Sequence) -> DataFrame:
    return schemas.conform(last_per_key(landing, "product_id", ingest_order),
                           schemas.STG_PRODUCTS)


def stage_orders(landing: DataFrame, ingest_order: Sequence) -> DataFrame:
    """Skip rows whose quantity (missing/bad = 0) is not positive, keep the last remaining
    row per order_id, keep the whole record as JSON text: as the reader carried it in
    ``raw_json``, else built from the fields (after the dedupe, from the surviving row)."""
    x = landing if "raw_json" in landing.columns else landing.withColumn("_quantity_text", F.col("quantity"))
    x = positive_quantity(x, "quantity")
    x = last_per_key(x, "order_id", ingest_order)
    if "raw_json" not in landing.columns:
        fields = [F.col("_quantity_text").alias("quantity") if c == "quantity" else F.col(c)
                  for c in LANDING_FIELDS]
        x = x.withColumn("raw_json", record_json(*fields))
    if dict(x.dtypes)["order_timestamp"] == "timestamp":  # an instant (ISO text with zone)
        x = x.withColumn("order_timestamp", utc_wall_time("order_timestamp"))
    return schemas.conform(x, schemas.STG_ORDERS)


def dim_upsert(dim: DataFrame, staged: DataFrame, key: str, schema, run_ts: str | None = None
               ) -> DataFrame:
    """Null keys are no dimension rows (primary key), so a rerun adds none again."""
    src = staged.where(F.col(key).isNotNull()).withColumn("last_updated", run_timestamp(run_ts))
    return schemas.conform(upsert(dim, schemas.conform(src, schema), key), schema)


def fact_rows(stg_clean: DataFrame, load_date) -> DataFrame:
    """``DISTINCT ON (order_id) ORDER BY order_id, order_timestamp DESC`` with
    the currency flag and the run's load date; the record's JSON text, which is no fact
    column, is not moved."""
    latest = latest_per_key(stg_clean.drop("raw_json"), "order_id", "order_timestamp",
                            tie_breakers=["product_id", "quantity", "total_amount"])
    return schemas.conform(
        latest.withColumn("currency_mismatch_flag", case_flag(F.col("currency") != HOME_CURRENCY))
              .withColumn("load_date", F.lit(str(load_date)).cast("date")),
        schemas.FACT_ORDERS)


def transform(stg_orders: DataFrame, stg_customers: DataFrame, stg_products: DataFrame,
              dim_customers: DataFrame, dim_products: DataFrame, fact: DataFrame,
              load_date, run_ts: str | None = None) -> dict[str, DataFrame]:
    clean = clean_staging(stg_orders)
    return {
        "stg_orders": clean,
        "dim_customers": dim_upsert(dim_customers, stg_customers, "customer_id",
                                    schemas.DIM_CUSTOMERS, run_ts),
        "dim_products": dim_upsert(dim_products, stg_products, "product_id",
                                   schemas.DIM_PRODUCTS, run_ts),
        "fact_orders": schemas.conform(upsert(fact, fact_rows(clean, load_date), "order_id"),
                                       schemas.FACT_ORDERS),
    }


def dq_checks(load_date) -> list[Check]:
    """The daily checks: dimension not empty, no null keys in the fact, as many fact rows of the
    load date as staged ones."""
    today = F.col("load_date") == F.lit(load_date).cast("date")
    return [not_empty("dim_customers", "dim_customers_not_empty"),
            no_nulls("fact", ["customer_id", "product_id"], "fact_no_null_keys"),
            equal_counts("fact", today, "staging", F.lit(True), "fact_matches_staging")]


def dq_report(dim_customers: DataFrame, fact: DataFrame, stg_clean: DataFrame, load_date
              ) -> DataFrame:
    """One scan per table."""
    return run_checks({"dim_customers": dim_customers, "fact": fact, "staging": stg_clean}, dq_checks(load_date))


def volume(fact: DataFrame, load_date, threshold: int = MIN_ORDER_THRESHOLD) -> DataFrame:
    return volume_status(fact, load_date, threshold)


def anomaly_note(status: DataFrame) -> DataFrame:
    return anomaly_lines(status)


def empty(spark, schema) -> DataFrame:
    """An empty table of ``schema`` that Catalyst knows is empty (an always-false
    filter becomes an empty local relation), so joins against it are pruned."""
    return (spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name)
                                    for f in schema.fields]).where(F.lit(False)))


TABLES = ("stg_customers", "stg_products", "stg_orders", "dim_customers", "dim_products",
          "fact_orders")
SCHEMA_OF = {"stg_customers": schemas.STG_CUSTOMERS, "stg_products": schemas.STG_PRODUCTS,
             "stg_orders": schemas.STG_ORDERS, "dim_customers": schemas.DIM_CUSTOMERS,
             "dim_products": schemas.DIM_PRODUCTS, "fact_orders": schemas.FACT_ORDERS}

DIM_KEYS = {"dim_customers": "customer_id", "dim_products": "product_id"}
#: Folders of a dimension (of its key's hash); it stays the same for the life of a warehouse.
DIM_BUCKETS = 16


def load_day(spark, warehouse: str, landing_base: str, run_date, run_ts: str | None = None,
             threshold: int = MIN_ORDER_THRESHOLD) -> dict:
    """V9: one daily run, in the order stage -> transform -> checks -> volume (decision
    F15). Every table is a plain parquet table under ``warehouse``; the fact table is
    partitioned by load date, the dimensions by hash of their key, so a load leaves the
    buckets that it brings no key for as they are. A rerun or a backfill of a date upserts
    again instead of adding rows. Raises when a check fails. Returns the DQ report, the volume status and
    the tables, read back from disk, and the loaders' row counts.
    """
    from tessera.operators.quality import require
    from tessera.sources.files import landing_path, read_csv, read_json_records
    from tessera.sources.tables import KeyedTable, ParquetTable, exists
    from tessera.sources.writers import truncate_and_load, write_text_lines

    base = warehouse.rstrip("/")
    t = {n: KeyedTable(spark, f"{base}/{n}", SCHEMA_OF[n], (DIM_KEYS[n],), DIM_BUCKETS) if n in DIM_KEYS else
         ParquetTable(spark, f"{base}/{n}", SCHEMA_OF[n], ("load_date",) if n == "fact_orders" else ())
         for n in TABLES}
    for n in ("dim_customers", "dim_products", "fact_orders"):
        if not exists(spark, t[n].path):
            t[n].overwrite(empty(spark, SCHEMA_OF[n]))

    # stage: truncate + load = one overwrite per staging table
    cust = read_csv(spark, landing_path(landing_base, "customers", run_date, "csv"),
                    schemas.STG_CUSTOMERS, ingest_order=True)
    prod = read_csv(spark, landing_path(landing_base, "products", run_date, "csv"),
                    schemas.STG_PRODUCTS, ingest_order=True)
    ords = read_json_records(spark, landing_path(landing_base, "orders", run_date, "json"),
                             schemas.LANDING_ORDERS, ingest_order=True, raw="raw_json")
    truncate_and_load(stage_customers(cust, ["_ingest"]), t["stg_customers"].path)
    truncate_and_load(stage_products(prod, ["_ingest"]), t["stg_products"].path)
    truncate_and_load(clean_staging(stage_orders(ords, ["_ingest"])), t["stg_orders"].path)
    counts = {n: t[n].read().count() for n in ("stg_customers", "stg_products", "stg_orders")}

    for dim, key in DIM_KEYS.items():
        new = t[dim.replace("dim", "stg")].read().where(F.col(key).isNotNull())
        t[dim].merge(schemas.conform(new.withColumn("last_updated", run_timestamp(run_ts)), SCHEMA_OF[dim]))
    t["fact_orders"].merge(fact_rows(t["stg_orders"].read(), run_date), "order_id")

    fact, stg = t["fact_orders"].read(), t["stg_orders"].read()
    rep = dq_report(t["dim_customers"].read(), fact, stg, run_date)
    require(rep)
    status = volume(fact, run_date, threshold)
    ymd = str(run_date).replace("-", "")
    write_text_lines(anomaly_note(status), f"{base}/anomalies/low_volume_{ymd}")
    return {"report": rep, "status": status, "tables": t, "counts": counts}
