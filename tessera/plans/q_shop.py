"""Catalogue entries of the daily shop load."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import schemas
from tessera import testviews as tv
from tessera.functions.scalar import record_json
from tessera.operators.filters import case_flag, clean_staging
from tessera.operators.keyed import latest_per_key, orphans, upsert
from tessera.operators.quality import all_passed, check_no_nulls, check_unique, report
from tessera.plans import shop_daily as shop
from tessera.plans.catalog import register
from tessera.session import scratch_path
from tessera.sources.tables import ParquetTable
from tessera.sources.writers import write_text_lines

D1, D2 = "2025-01-01", "2025-01-02"
TS1, TS2 = "2025-01-01 06:00:00", "2025-01-02 06:00:00"
CHANGED_SINCE = "2024-10-01"      # customers whose profile changes on day 2
PRICE_CHANGE_FROM = 1500          # products repriced on day 2


def _desc_last(cols):
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


CUST_STG = f"""cust_stg AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
    ORDER BY {_desc_last(tv.SHOP_CUSTOMERS_ORDER)}) AS rn FROM shop_customers) WHERE rn = 1)"""
PROD_STG = f"""prod_stg AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY product_id
    ORDER BY {_desc_last(tv.SHOP_PRODUCTS_ORDER)}) AS rn FROM shop_products) WHERE rn = 1)"""


def ord_stg(name: str, where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT order_id, order_timestamp, customer_id, product_id, quantity,
         CAST(total_amount AS DECIMAL(10,2)) AS total_amount, currency, status FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id
             ORDER BY {_desc_last(tv.SHOP_ORDERS_INGEST)}) AS rn
    FROM (SELECT * REPLACE (coalesce(TRY_CAST(quantity AS INTEGER), 0) AS quantity)
          FROM shop_landing_orders WHERE {where})
    WHERE quantity > 0) WHERE rn = 1)"""


def stg_clean(name: str, src: str) -> str:
    return f"""{name} AS (SELECT * FROM {src}
  WHERE NOT coalesce(quantity <= 0 OR customer_id IS NULL OR product_id IS NULL, false))"""


def fact_rows(name: str, src: str, day: str) -> str:
    return f"""{name} AS (
  SELECT order_id, order_timestamp, customer_id, product_id, quantity, total_amount, currency,
         CASE WHEN currency <> 'USD' THEN TRUE ELSE FALSE END AS currency_mismatch_flag,
         status, DATE '{day}' AS load_date
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_timestamp DESC NULLS FIRST,
          product_id DESC NULLS FIRST, quantity DESC NULLS FIRST, total_amount DESC NULLS FIRST) AS rn
        FROM {src}) WHERE rn = 1)"""


DAY1 = [ord_stg("stg"), stg_clean("stgc", "stg"), fact_rows("fact", "stgc", D1)]


def Q(body: str, views: tuple, *ctes: str) -> str:
    head = tv.with_views("", *views).rstrip()
    return head + "".join(",\n" + c for c in ctes) + "\n" + body


CV, PV, OV = ("shop_customers",), ("shop_products",), ("shop_landing_orders",)


def _stg_customers(spark, sf):
    return shop.stage_customers(tv.shop_customers(spark, sf), tv.SHOP_CUSTOMERS_ORDER)


def _stg_products(spark, sf):
    return shop.stage_products(tv.shop_products(spark, sf), tv.SHOP_PRODUCTS_ORDER)


def _stg_orders(spark, sf, day=None):
    landing = tv.shop_landing_orders(spark, sf)
    if day is not None:
        landing = landing.where(F.col("landing_date") == F.lit(day).cast("date"))
    return shop.stage_orders(landing, tv.SHOP_ORDERS_INGEST)


def _day1_fact(spark, sf):
    clean = clean_staging(_stg_orders(spark, sf))
    empty = shop.empty(spark, schemas.FACT_ORDERS)
    fact = upsert(empty, shop.fact_rows(clean, D1), "order_id")
    return fact, clean


@register("stage_customers", Q("SELECT * FROM cust_stg", CV, CUST_STG))
def q_stage_customers(spark, sf):
    """W3 + S7: staged customers (last landing row per key wins)."""
    return _stg_customers(spark, sf)


@register("stage_products", Q("SELECT * FROM prod_stg", PV, PROD_STG))
def q_stage_products(spark, sf):
    """W3 + S7: staged products."""
    return _stg_products(spark, sf)


@register("stage_orders", Q("SELECT * FROM stg", OV, ord_stg("stg")))
def q_stage_orders(spark, sf):
    """W3 + P8 + X12: staged orders: quantity > 0, last row per order_id."""
    return _stg_orders(spark, sf).drop("raw_json")


@register("stage_clean", Q("SELECT * FROM stgc", OV, ord_stg("stg"), stg_clean("stgc", "stg")))
def q_stage_clean(spark, sf):
    """Staging clean-up with three-valued logic."""
    return clean_staging(_stg_orders(spark, sf)).drop("raw_json")


def _dim_sql(stg: str, key: str, change_where: str, change_set: str) -> str:
    return f"""dim1 AS (SELECT *, TIMESTAMP '{TS1}' AS last_updated FROM {stg}),
  stg2 AS (SELECT * REPLACE ({change_set}) FROM {stg} WHERE {change_where}),
  dim2 AS (SELECT * FROM dim1 WHERE {key} NOT IN (SELECT {key} FROM stg2)
           UNION ALL SELECT *, TIMESTAMP '{TS2}' AS last_updated FROM stg2)"""


@register("dim_customer_upsert", Q("SELECT * FROM dim2", CV, CUST_STG, _dim_sql(
    "cust_stg", "customer_id", f"signup_date >= DATE '{CHANGED_SINCE}'",
    "upper(first_name) AS first_name")))
def q_dim_customer_upsert(spark, sf):
    """J2 + X10: two daily upserts into dim_customers (day 2 changes a subset)."""
    stg = _stg_customers(spark, sf)
    empty = shop.empty(spark, schemas.DIM_CUSTOMERS)
    dim1 = shop.dim_upsert(empty, stg, "customer_id", schemas.DIM_CUSTOMERS, TS1)
    stg2 = (stg.where(F.col("signup_date") >= F.lit(CHANGED_SINCE).cast("date"))
               .withColumn("first_name", F.upper("first_name")))
    return shop.dim_upsert(dim1, stg2, "customer_id", schemas.DIM_CUSTOMERS, TS2)


@register("dim_product_upsert", Q("SELECT * FROM dim2", PV, PROD_STG, _dim_sql(
    "prod_stg", "product_id", f"unit_price >= {PRICE_CHANGE_FROM}",
    "CAST(unit_price + 1.00 AS DECIMAL(10,2)) AS unit_price")))
def q_dim_product_upsert(spark, sf):
    """J2 + X10: two daily upserts into dim_products (day 2 reprices some)."""
    stg = _stg_products(spark, sf)
    empty = shop.empty(spark, schemas.DIM_PRODUCTS)
    dim1 = shop.dim_upsert(empty, stg, "product_id", schemas.DIM_PRODUCTS, TS1)
    stg2 = (stg.where(F.col("unit_price") >= PRICE_CHANGE_FROM)
               .withColumn("unit_price", (F.col("unit_price") + F.lit(1)).cast("decimal(10,2)")))
    return shop.dim_upsert(dim1, stg2, "product_id", schemas.DIM_PRODUCTS, TS2)


LATEST_COLS = ["customer_id", "order_id", "order_timestamp", "line_no", "product_id", "quantity",
               "total_amount"]


@register("latest_order_per_customer", tv.with_views(
    "SELECT DISTINCT ON (customer_id) " + ", ".join(LATEST_COLS) + " FROM shop_landing_orders "
    "ORDER BY customer_id, order_timestamp DESC NULLS FIRST, order_id DESC NULLS FIRST, "
    "line_no DESC NULLS FIRST, product_id DESC NULLS FIRST, quantity DESC NULLS FIRST, "
    "total_amount DESC NULLS FIRST", *OV))
def q_latest_order_per_customer(spark, sf):
    """``DISTINCT ON (customer_id) ORDER BY order_timestamp DESC``."""
    landing = tv.shop_landing_orders(spark, sf)
    return latest_per_key(landing, "customer_id", "order_timestamp",
                          tie_breakers=["order_id", "line_no", "product_id", "quantity",
                                        "total_amount"]).select(*LATEST_COLS)


@register("currency_mismatch", tv.with_views(
    "SELECT order_id, line_no, currency, CASE WHEN currency <> 'USD' THEN TRUE ELSE FALSE END "
    "AS currency_mismatch_flag FROM shop_landing_orders", *OV))
def q_currency_mismatch(spark, sf):
    """``CASE WHEN currency <> 'USD' THEN TRUE ELSE FALSE END``."""
    landing = tv.shop_landing_orders(spark, sf)
    return landing.select("order_id", "line_no", "currency",
                          case_flag(F.col("currency") != "USD").alias("currency_mismatch_flag"))


@register("fact_upsert", Q("SELECT * FROM fact", OV, *DAY1))
def q_fact_upsert(spark, sf):
    """V3 + P14: fact rows of one load date upserted twice (idempotent)."""
    fact, clean = _day1_fact(spark, sf)
    return upsert(fact, shop.fact_rows(clean, D1), "order_id")


@register("daily_fact_backfill", Q(
    "SELECT * FROM f1 WHERE order_id NOT IN (SELECT order_id FROM f2) UNION ALL SELECT * FROM f2",
    OV, ord_stg("s1", f"landing_date = DATE '{D1}'"), stg_clean("c1", "s1"), fact_rows("f1", "c1", D1),
    ord_stg("s2", f"landing_date = DATE '{D2}'"), stg_clean("c2", "s2"), fact_rows("f2", "c2", D2)))
def q_daily_fact_backfill(spark, sf):
    """V9: load day 1, day 2, then rerun day 2: the fact table keeps one
    row per order, the last run wins (decision F18). The fact table is
    partitioned by load date and each load merges into the partitions it
    touches only."""
    table = ParquetTable(spark, scratch_path(spark, "fact_orders"), schemas.FACT_ORDERS, ("load_date",))
    table.overwrite(shop.empty(spark, schemas.FACT_ORDERS))
    for day in (D1, D2, D2):
        rows = ParquetTable(spark, scratch_path(spark, "fact_day"), schemas.FACT_ORDERS)
        rows.overwrite(shop.fact_rows(clean_staging(_stg_orders(spark, sf, day)), day))  # staged once per day
        table.merge(rows.read(), "order_id")
    return table.read()


@register("fk_orphans", Q(
    "SELECT order_id, customer_id FROM fact WHERE customer_id NOT IN (SELECT customer_id FROM shop_customers)",
    ("shop_landing_orders", "shop_customers"), *DAY1))
def q_fk_orphans(spark, sf):
    """Fact rows whose customer is missing from the dimension."""
    fact, _ = _day1_fact(spark, sf)
    return orphans(fact, tv.shop_customers(spark, sf), "customer_id").select("order_id", "customer_id")


@register("fk_orphans_products", Q(
    "SELECT product_id, product_name FROM shop_products p WHERE NOT EXISTS "
    "(SELECT 1 FROM fact f WHERE upper('p' || f.product_id) = upper('P' || p.product_id))",
    ("shop_landing_orders", "shop_products"), *DAY1))
def q_fk_orphans_products(spark, sf):
    """J3, product side with upper-cased keys (decision F14): products that no fact names;
    the two tables write their keys in different case."""
    fact, _ = _day1_fact(spark, sf)
    named = fact.select(F.concat(F.lit("p"), "product_id").alias("key"))
    prods = tv.shop_products(spark, sf).withColumn("key", F.concat(F.lit("P"), "product_id"))
    return orphans(prods, named, "key", normalize=F.upper).select("product_id", "product_name")


JSON_FIELDS = ["order_id", "customer_id", "product_id", "quantity", "total_amount", "currency",
               "status"]


@register("order_raw_json", tv.with_views(
    "SELECT order_id, line_no, CAST(to_json({" + ", ".join(f"'{c}': {c}" for c in JSON_FIELDS)
    + "}) AS VARCHAR) AS raw_json FROM shop_landing_orders", *OV))
def q_order_raw_json(spark, sf):
    """X11: the landing record as JSON text."""
    landing = tv.shop_landing_orders(spark, sf)
    return landing.select("order_id", "line_no", record_json(*JSON_FIELDS).alias("raw_json"))


@register("dq_report", Q(
    f"""SELECT 'dim_customers_not_empty' AS "check", count(*) AS observed, count(*) > 0 AS passed
          FROM cust_stg
        UNION ALL
        SELECT 'fact_no_null_keys', count(*) FILTER (WHERE customer_id IS NULL OR product_id IS NULL),
               count(*) FILTER (WHERE customer_id IS NULL OR product_id IS NULL) = 0 FROM fact
        UNION ALL
        SELECT 'fact_matches_staging', (SELECT count(*) FROM fact WHERE load_date = DATE '{D1}'),
               (SELECT count(*) FROM stgc) = (SELECT count(*) FROM fact WHERE load_date = DATE '{D1}')""",
    ("shop_customers", "shop_landing_orders"), CUST_STG, *DAY1))
def q_dq_report(spark, sf):
    """Q1-Q4 + G6: the day-1 checks (dimension not empty, no null keys,
    staging count = fact count for the load date)."""
    fact, clean = _day1_fact(spark, sf)
    dim = shop.dim_upsert(shop.empty(spark, schemas.DIM_CUSTOMERS), _stg_customers(spark, sf),
                          "customer_id", schemas.DIM_CUSTOMERS, TS1)
    return shop.dq_report(dim, fact, clean, D1)


@register("dq_gate", Q(
    """SELECT (SELECT count(*) > 0 FROM cust_stg)
              AND (SELECT count(*) FILTER (WHERE customer_id IS NULL OR product_id IS NULL) = 0 FROM fact)
              AND (SELECT count(*) FROM stgc) = (SELECT count(*) FROM fact) AS all_passed""",
    ("shop_customers", "shop_landing_orders"), CUST_STG, *DAY1))
def q_dq_gate(spark, sf):
    """Q4: the decision of the gate over the day-1 report."""
    return all_passed(q_dq_report(spark, sf))


@register("key_checks", Q(
    """SELECT 'dim_customers_key' AS "check", count(*) AS observed, count(*) = 0 AS passed
         FROM (SELECT customer_id FROM cust_stg GROUP BY customer_id HAVING count(*) > 1)
       UNION ALL SELECT 'dim_products_key', count(*), count(*) = 0
         FROM (SELECT product_id FROM prod_stg GROUP BY product_id HAVING count(*) > 1)
       UNION ALL SELECT 'fact_key', count(*), count(*) = 0
         FROM (SELECT order_id FROM fact GROUP BY order_id HAVING count(*) > 1)
       UNION ALL SELECT 'landing_key', count(*), count(*) = 0
         FROM (SELECT order_id FROM shop_landing_orders GROUP BY order_id HAVING count(*) > 1)
       UNION ALL SELECT 'fact_key_not_null', count(*) FILTER (WHERE order_id IS NULL),
              count(*) FILTER (WHERE order_id IS NULL) = 0 FROM fact""",
    ("shop_customers", "shop_products", "shop_landing_orders"), CUST_STG, PROD_STG, *DAY1))
def q_key_checks(spark, sf):
    """Primary-key rules of the warehouse (unique, not null); the landing orders break
    them, which staging repairs."""
    fact, _ = _day1_fact(spark, sf)
    return report(check_unique(_stg_customers(spark, sf), ["customer_id"], "dim_customers_key"),
                  check_unique(_stg_products(spark, sf), ["product_id"], "dim_products_key"),
                  check_unique(fact, ["order_id"], "fact_key"),
                  check_unique(tv.shop_landing_orders(spark, sf), ["order_id"], "landing_key"),
                  check_no_nulls(fact, ["order_id"], "fact_key_not_null"))


@register("low_volume_note", Q(
    f"SELECT 'LOW ORDER COUNT DETECTED: ' || CAST(count(*) AS VARCHAR) AS value FROM fact WHERE load_date = DATE '{D1}'",
    OV, *DAY1))
def q_low_volume_note(spark, sf):
    """Q5 + K6, low branch: a threshold above the day's count writes the note; read back."""
    fact, _ = _day1_fact(spark, sf)
    path = scratch_path(spark, "low_volume")
    write_text_lines(shop.anomaly_note(shop.volume(fact, D1, threshold=2 ** 31 - 1)), path)
    return spark.read.text(path)


@register("volume_branch", Q(
    f"SELECT DATE '{D1}' AS load_date, count(*) AS n_orders, CASE WHEN count(*) < 10 "
    f"THEN 'warn_low_volume' ELSE 'normal_end' END AS branch FROM fact WHERE load_date = DATE '{D1}'",
    OV, *DAY1))
def q_volume_branch(spark, sf):
    """Q5 + K6: day-1 order count and the branch it selects (an anomaly note
    is written only for the low-volume branch)."""
    fact, _ = _day1_fact(spark, sf)
    status = shop.volume(fact, D1)
    write_text_lines(shop.anomaly_note(status), scratch_path(spark, "anomalies"))
    return status


@register("landing_stage_orders", Q("SELECT * FROM stg", OV, ord_stg("stg")))
def q_landing_stage_orders(spark, sf):
    """S6 + S2 + K5: the landing orders written as one dated file per load date,
    read back for both dates in one multi-path read, staged, and loaded into
    the staging table with truncate + load (E: equals the staged orders)."""
    from tessera.sources.files import landing_path, landing_paths, read_json_records
    from tessera.sources.writers import truncate_and_load, write_json
    base = scratch_path(spark, "landing")
    landing = tv.shop_landing_orders(spark, sf)
    for day in (D1, D2):
        write_json(landing.where(F.col("landing_date") == F.lit(day).cast("date"))
                   .drop("landing_date"), landing_path(base, "orders", day, "json"))
    schema = landing.drop("landing_date").schema
    read = read_json_records(spark, landing_paths(base, "orders", [D1, D2], "json"), schema,
                             array_file=False)
    stg = f"{base}/stg_orders"
    truncate_and_load(shop.stage_orders(read, tv.SHOP_ORDERS_INGEST), stg)
    return spark.read.schema(schemas.STG_ORDERS).parquet(stg).drop("raw_json")


def _tasks(spark, rows: int) -> int:
    """Tasks of about 250,000 landing rows each."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // 250_000)


def _landing_files(spark, sf, base: str) -> None:
    """The landing files of two days: order records as gzipped JSON array files (all records of an
    order in one file, in ingest order), customers and products as CSV; on day 2 only the
    customers that changed and the products that were repriced come."""
    from tessera.sources.files import landing_path
    from tessera.sources.writers import write_csv
    landing = tv.shop_landing_orders(spark, sf)
    stamp = F.date_format("order_timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("order_timestamp")
    fields = [stamp if c == "order_timestamp" else F.col(c) for c in shop.LANDING_FIELDS]
    place = F.struct(*[F.col(c).cast("int") if c == "quantity" else F.col(c) for c in tv.SHOP_ORDERS_INGEST])
    n = landing.count()
    rows = landing.withColumn("file", F.pmod(F.xxhash64("order_id"), F.lit(max(1, n // 5000))))
    rows = rows.repartition(_tasks(spark, n), "landing_date", "file")  # records are made where they are written
    record = F.struct(place.alias("at"), F.to_json(F.struct(*fields)).alias("r"))
    files = rows.groupBy("landing_date", "file").agg(F.sort_array(F.collect_list(record)).alias("r")).select(
        "landing_date", F.concat(F.lit("["), F.array_join(F.col("r.r"), ","), F.lit("]")).alias("value"))
    cust, prod = tv.shop_customers(spark, sf), tv.shop_products(spark, sf)
    changed = cust.where(F.col("signup_date") >= F.lit(CHANGED_SINCE).cast("date")).withColumn("first_name", F.upper("first_name"))
    repriced = prod.where(F.col("unit_price") >= PRICE_CHANGE_FROM).withColumn(
        "unit_price", (F.col("unit_price") + F.lit(1)).cast("decimal(10,2)"))
    for day, c, p in ((D1, cust, prod), (D2, changed, repriced)):
        write_csv(c, landing_path(base, "customers", day, "csv"))
        write_csv(p, landing_path(base, "products", day, "csv"))
        (files.where(F.col("landing_date") == F.lit(day).cast("date")).select("value")
         .write.option("maxRecordsPerFile", 1).text(landing_path(base, "orders", day, "json"), compression="gzip"))


@register("daily_load", Q(
    """SELECT f.*, d.first_name, d.last_updated, p.unit_price
       FROM (SELECT * FROM f1 WHERE order_id NOT IN (SELECT order_id FROM f2) UNION ALL SELECT * FROM f2) f
       LEFT JOIN cust2 d USING (customer_id) LEFT JOIN prod2 p USING (product_id)""",
    ("shop_customers", "shop_products", "shop_landing_orders"), CUST_STG, PROD_STG,
    _dim_sql("cust_stg", "customer_id", f"signup_date >= DATE '{CHANGED_SINCE}'", "upper(first_name) AS first_name")
    .replace("dim1", "cust1").replace("dim2", "cust2").replace("stg2", "custs2"),
    _dim_sql("prod_stg", "product_id", f"unit_price >= {PRICE_CHANGE_FROM}",
             "CAST(unit_price + 1.00 AS DECIMAL(10,2)) AS unit_price")
    .replace("dim1", "prod1").replace("dim2", "prod2").replace("stg2", "prods2"),
    ord_stg("s1", f"landing_date = DATE '{D1}'"), stg_clean("c1", "s1"), fact_rows("f1", "c1", D1),
    ord_stg("s2", f"landing_date = DATE '{D2}'"), stg_clean("c2", "s2"), fact_rows("f2", "c2", D2)))
def q_daily_load(spark, sf):
    """V9 + J2, the whole daily run on landing files of two days: staging, dimension and fact
    upserts, checks and volume note (``load_day``). The fact with its dimension rows."""
    base, warehouse = scratch_path(spark, "landing_days"), scratch_path(spark, "warehouse")
    _landing_files(spark, sf, base)
    for day, ts in ((D1, TS1), (D2, TS2)):
        t = shop.load_day(spark, warehouse, base, day, ts)["tables"]
    cust = t["dim_customers"].read().select("customer_id", "first_name", "last_updated")
    prod = t["dim_products"].read().select("product_id", "unit_price")
    return t["fact_orders"].read().join(cust, "customer_id", "left").join(prod, "product_id", "left")


@register("landing_array_split", Q(
    "SELECT order_id, line_no, customer_id, status, currency FROM shop_landing_orders", OV))
def q_landing_array_split(spark, sf):
    """The landing orders of both days in one JSON array file, pretty-printed, read by as many
    tasks as it has splits."""
    from tessera.sources.files import read_json_records
    fields = ["order_id", "line_no", "customer_id", "status", "currency"]
    landing = tv.shop_landing_orders(spark, sf).select(*fields)
    record = F.to_json(F.struct(*landing.columns), {"pretty": "true"})
    lines = landing.select(F.lit(1).alias("at"), F.concat(record, F.lit(",")).alias("value"))
    ends = spark.range(2).select((F.col("id") * 2).cast("int").alias("at"), F.when(F.col("id") == 0, "[").otherwise(
        '{"order_id": null}\n]').alias("value"))
    path = scratch_path(spark, "landing_array")
    # records are made by many tasks; the one that writes the file only puts the brackets at its ends
    lines.unionByName(ends).repartition(1).sortWithinPartitions("at").select("value").write.text(path)
    return read_json_records(spark, path, landing.schema, split=True).where("order_id IS NOT NULL")


@register("landing_array_files", Q(
    """SELECT * EXCLUDE (raw_json), CAST(json_extract(raw_json, '$.status') AS VARCHAR) AS raw_status,
              CAST(json_extract(raw_json, '$.line_no') AS INTEGER) AS raw_line,
              contains(raw_json, '"missing":null') AS raw_missing
       FROM (SELECT * FROM stg_raw)""", OV, """stg_raw AS (
  SELECT order_id, order_timestamp, customer_id, product_id, quantity,
         CAST(total_amount AS DECIMAL(10,2)) AS total_amount, currency, status,
         to_json({'status': status, 'line_no': line_no, 'missing': NULL}) AS raw_json FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY """ + _desc_last(tv.SHOP_ORDERS_INGEST) + """) AS rn
    FROM (SELECT * REPLACE (coalesce(TRY_CAST(quantity AS INTEGER), 0) AS quantity) FROM shop_landing_orders)
    WHERE quantity > 0) WHERE rn = 1)"""))
def q_landing_array_files(spark, sf):
    """S2 + X11: the landing orders as gzipped files that hold one JSON array of about 500 records
    each (with a null field and a field that no table has), read back, staged, the whole
    record kept."""
    from tessera.sources.files import read_json_records
    landing = tv.shop_landing_orders(spark, sf).drop("landing_date")
    files = max(1, landing.count() // 500)
    record = F.to_json(F.struct(*landing.columns, F.lit(None).cast("string").alias("missing")), {"ignoreNullFields": "false"})
    path = scratch_path(spark, "landing_arrays")
    # a task writes some hundred files, one row each; records are made where they are written
    (landing.withColumn("file", F.pmod(F.xxhash64(*landing.columns), F.lit(files)))
     .repartition(_tasks(spark, files * 500), "file")
     .groupBy("file").agg(F.concat(F.lit("["), F.array_join(F.collect_list(record), ","), F.lit("]")).alias("value"))
     .select("value").write.option("maxRecordsPerFile", 1).text(path, compression="gzip"))
    read = read_json_records(spark, path, landing.schema, raw="raw_json")
    staged = shop.stage_orders(read, tv.SHOP_ORDERS_INGEST)
    field = lambda name: F.get_json_object("raw_json", f"$.{name}")
    text = F.concat(F.lit('"'), field("status"), F.lit('"'))
    return staged.select(*[c for c in staged.columns if c != "raw_json"], text.alias("raw_status"),
                         field("line_no").cast("int").alias("raw_line"), F.col("raw_json").contains('"missing":null').alias("raw_missing"))
