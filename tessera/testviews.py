"""Map the driver's test tables onto the four domains.

Each domain has a Spark builder and the equivalent DuckDB SQL (a CTE body),
so oracle queries start from exactly the same rows. ``CASE`` columns plant
nulls, because the test tables have none in the columns used.

All joins here are key equi-joins between large tables (lineitem, orders) and
dimension tables whose size grows with the scale factor (supplier, part,
customer), so no side is hinted: AQE broadcasts a side only when its measured
size is under ``spark.sql.autoBroadcastJoinThreshold``, else sort-merge joins
on the key. ``nation`` (25 rows by definition of the schema) is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cte(name: str, body: str) -> str:
    return f"{name} AS ({body})"


def with_views(sql: str, *views: str) -> str:
    """Prefix ``sql`` with the CTEs of the named domain views."""
    ctes = [VIEW_SQL[v] for v in views]
    return ("WITH " + ",\n".join(ctes) + "\n" + sql) if ctes else sql


# --- sales: lineitem x supplier x part x orders ---------------------------------

def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    # the largest side first: lines move to their orders before they carry any names
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
           .join(p, li.l_partkey == p.p_partkey)
           .join(s, li.l_suppkey == s.s_suppkey))
    promo = F.when(F.col("l_discount") == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("DISC"), F.round(F.col("l_discount") * 100).cast("int").cast("string")))
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        F.col("l_suppkey").alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.col("l_shipdate").alias("date"),
        F.col("l_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(F.col("l_tax") == 0, F.lit(None).cast("double")).otherwise(
            F.col("l_quantity")).alias("quantity"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("double")).otherwise(
            F.col("l_extendedprice")).alias("unit_price"),
        F.col("l_extendedprice").alias("total"),
        F.col("o_custkey").alias("customer_id"),
        promo.alias("promo_code"))


SALES_SQL = _cte("sales", """
  SELECT l_orderkey * 10 + l_linenumber AS transaction_id,
         l_suppkey AS store_id, s_name AS store_name, l_shipdate AS date,
         l_partkey AS product_id, p_name AS product_name,
         CASE WHEN l_tax = 0 THEN NULL ELSE l_quantity END AS quantity,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END AS unit_price,
         l_extendedprice AS total, o_custkey AS customer_id,
         CASE WHEN l_discount = 0 THEN NULL
              ELSE 'DISC' || CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) END AS promo_code
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
                JOIN part ON l_partkey = p_partkey
                JOIN orders ON l_orderkey = o_orderkey""")

# "Input order" of sales rows for keep-first: a total order over the row.
SALES_ORDER = ["date", "product_id", "store_id", "quantity", "unit_price", "total",
               "customer_id", "promo_code"]
SALES_ORDER_SQL = ", ".join(f"{c} ASC NULLS FIRST" for c in SALES_ORDER)


# --- trips: lineitem ------------------------------------------------------------

def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_shipdate").alias("tpep_pickup_datetime"),
        (F.col("l_suppkey") % 10).cast("int").alias("pickup_zip"),
        (F.col("l_partkey") % 10).cast("int").alias("dropoff_zip"),
        (F.col("l_extendedprice") / 1000).alias("fare_amount"),
        (F.col("l_quantity") - 5).alias("trip_distance"))


def trips_from_lineitem(li: DataFrame) -> DataFrame:
    """Same mapping for an already-open lineitem frame (batch or stream)."""
    return li.select(
        F.col("l_shipdate").alias("tpep_pickup_datetime"),
        (F.col("l_suppkey") % 10).cast("int").alias("pickup_zip"),
        (F.col("l_partkey") % 10).cast("int").alias("dropoff_zip"),
        (F.col("l_extendedprice") / 1000).alias("fare_amount"),
        (F.col("l_quantity") - 5).alias("trip_distance"))


TRIPS_SQL = _cte("trips", """
  SELECT l_shipdate AS tpep_pickup_datetime,
         CAST(l_suppkey % 10 AS INTEGER) AS pickup_zip,
         CAST(l_partkey % 10 AS INTEGER) AS dropoff_zip,
         l_extendedprice / 1000 AS fare_amount,
         l_quantity - 5 AS trip_distance
  FROM lineitem""")


# --- orders_tbl: orders x customer x nation ------------------------------------

CURRENCY_SQL = "CASE n_nationkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'INR' ELSE 'GBP' END"


def orders_tbl(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey)
    return j.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_orderdate").alias("order_timestamp"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("n_name").alias("country"),
        F.col("o_totalprice").alias("amount"),
        F.expr(CURRENCY_SQL).alias("currency"),
        F.col("o_orderstatus").alias("status"))


ORDERS_TBL_SQL = _cte("orders_tbl", f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderdate AS order_timestamp,
         CAST(o_custkey AS VARCHAR) AS customer_id, n_name AS country,
         o_totalprice AS amount, {CURRENCY_SQL} AS currency, o_orderstatus AS status
  FROM orders JOIN customer ON o_custkey = c_custkey
              JOIN nation ON c_nationkey = n_nationkey""")


# --- shop: customer / part / lineitem x orders -----------------------------------

def shop_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
    return j.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.concat(F.lower(F.col("c_name")), F.lit("@example.com")).alias("email"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int"))
         .alias("signup_date"),
        F.col("n_name").alias("country"))


SHOP_CUSTOMERS_SQL = _cte("shop_customers", """
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS first_name,
         c_mktsegment AS last_name, lower(c_name) || '@example.com' AS email,
         CAST(DATE '2024-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS signup_date,
         n_name AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey""")

# ingest order of landing customers / products: by key, then all columns
SHOP_CUSTOMERS_ORDER = ["customer_id", "first_name", "last_name", "email", "signup_date", "country"]


def shop_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"))


SHOP_PRODUCTS_SQL = _cte("shop_products", """
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
         p_type AS category, CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price
  FROM part""")

SHOP_PRODUCTS_ORDER = ["product_id", "product_name", "category", "unit_price"]


def shop_landing_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing order records: several lines per ``order_id`` with different
    time stamps, so latest-per-key does real work. ``quantity`` stays text, as
    read from JSON, and is parsed by the loader (X12)."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_shipdate").alias("order_timestamp"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        (F.col("l_quantity") - 5).cast("int").cast("string").alias("quantity"),
        F.col("l_extendedprice").alias("total_amount"),
        F.when(F.col("l_discount") >= 0.05, F.lit("USD")).otherwise(F.lit("EUR")).alias("currency"),
        F.col("o_orderstatus").alias("status"),
        F.col("l_linenumber").alias("line_no"),
        F.when(F.col("l_returnflag") == "N", F.lit("2025-01-01")).otherwise(F.lit("2025-01-02"))
         .cast("date").alias("landing_date"))


SHOP_LANDING_ORDERS_SQL = _cte("shop_landing_orders", """
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_shipdate AS order_timestamp,
         CAST(o_custkey AS VARCHAR) AS customer_id, CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(CAST(l_quantity - 5 AS INTEGER) AS VARCHAR) AS quantity,
         l_extendedprice AS total_amount,
         CASE WHEN l_discount >= 0.05 THEN 'USD' ELSE 'EUR' END AS currency,
         o_orderstatus AS status, l_linenumber AS line_no,
         CASE WHEN l_returnflag = 'N' THEN DATE '2025-01-01' ELSE DATE '2025-01-02' END AS landing_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")

# ingest position of landing orders (a total order over the record)
SHOP_ORDERS_INGEST = ["line_no", "order_timestamp", "product_id", "quantity", "total_amount",
                      "currency"]


# --- events: planted text for coercion -------------------------------------------

def events_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns with planted junk: every tenth ``event_id`` 'junk', every
    seventh '' (empty), else the value's / time stamp's text."""
    e = table(spark, sf_dir, "events")
    bad = (F.when(F.col("event_id") % 10 == 0, F.lit("junk"))
             .when(F.col("event_id") % 7 == 0, F.lit("")))
    return e.select(
        "event_id",
        F.coalesce(bad, F.col("value").cast("string")).alias("value_text"),
        F.coalesce(bad, F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss")).alias("ts_text"))


EVENTS_TEXT_SQL = _cte("events_text", """
  SELECT event_id,
         CASE WHEN event_id % 10 = 0 THEN 'junk' WHEN event_id % 7 = 0 THEN ''
              ELSE CAST(value AS VARCHAR) END AS value_text,
         CASE WHEN event_id % 10 = 0 THEN 'junk' WHEN event_id % 7 = 0 THEN ''
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts_text
  FROM events""")


VIEW_SQL = {
    "sales": SALES_SQL, "trips": TRIPS_SQL, "orders_tbl": ORDERS_TBL_SQL,
    "shop_customers": SHOP_CUSTOMERS_SQL, "shop_products": SHOP_PRODUCTS_SQL,
    "shop_landing_orders": SHOP_LANDING_ORDERS_SQL, "events_text": EVENTS_TEXT_SQL,
}

