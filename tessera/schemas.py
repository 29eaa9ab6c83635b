"""Declared table schemas of the four domains.

Every reader takes one of these; schema inference is never relied on.
Ids of the shop domain are strings because the landing data carries text ids
(``o1001``, ``C001``, ``p001``) even though the warehouse DDL says INT.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I, TS, DT, B = (T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(),
                         T.TimestampType(), T.DateType(), T.BooleanType())
NTZ = T.TimestampNTZType()  # naive date-time (pandas datetime64 without zone)
MONEY = T.DecimalType(10, 2)


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# --- sales (retail CSV) -------------------------------------------------------
# The CSV is read with every column as text, then coerced with "bad -> null".
SALES_TEXT = _schema(*[(c, S, True) for c in (
    "transaction_id", "store_id", "store_name", "date", "product_id", "product_name",
    "quantity", "unit_price", "total", "customer_id", "promo_code")])

SALES = _schema(
    ("transaction_id", L, True), ("store_id", L, True), ("store_name", S, True),
    ("date", NTZ, True), ("product_id", L, True), ("product_name", S, True),
    ("quantity", D, True), ("unit_price", D, True), ("total", D, True),
    ("customer_id", L, True), ("promo_code", S, True))

# --- trips (taxi) --------------------------------------------------------------
TRIPS = _schema(
    ("tpep_pickup_datetime", NTZ, True), ("pickup_zip", I, True), ("dropoff_zip", I, True),
    ("fare_amount", D, True), ("trip_distance", D, True))

# --- orders table (fixed: names must match) ----------------------------------------------------
ORDERS_TEXT = _schema(
    ("order_id", S, False), ("order_timestamp", S, False), ("customer_id", S, False),
    ("country", S, False), ("amount", D, False), ("currency", S, False), ("status", S, False))

ORDERS_EVOLVED_TEXT = T.StructType(ORDERS_TEXT.fields + [
    T.StructField("payment_method", S, True), T.StructField("coupon_code", S, True)])

ORDERS = _schema(
    ("order_id", S, False), ("order_timestamp", TS, True), ("customer_id", S, False),
    ("country", S, False), ("amount", D, False), ("currency", S, False), ("status", S, False),
    ("order_date", DT, True))

# --- shop warehouse ------------------------------------------------------------
STG_CUSTOMERS = _schema(
    ("customer_id", S, True), ("first_name", S, True), ("last_name", S, True),
    ("email", S, True), ("signup_date", DT, True), ("country", S, True))

STG_PRODUCTS = _schema(
    ("product_id", S, True), ("product_name", S, True), ("category", S, True),
    ("unit_price", MONEY, True))

# Landing JSON: quantity is read as text so a bad or missing value becomes 0.
LANDING_ORDERS = _schema(
    ("order_id", S, True), ("order_timestamp", TS, True), ("customer_id", S, True),
    ("product_id", S, True), ("quantity", S, True), ("total_amount", D, True),
    ("currency", S, True), ("status", S, True))

# Warehouse time stamps are naive (Postgres TIMESTAMP without zone): the
# landing instant is converted to UTC wall time on load.
STG_ORDERS = _schema(
    ("order_id", S, True), ("order_timestamp", NTZ, True), ("customer_id", S, True),
    ("product_id", S, True), ("quantity", I, True), ("total_amount", MONEY, True),
    ("currency", S, True), ("status", S, True), ("raw_json", S, True))

DIM_CUSTOMERS = T.StructType(STG_CUSTOMERS.fields + [T.StructField("last_updated", NTZ, True)])
DIM_PRODUCTS = T.StructType(STG_PRODUCTS.fields + [T.StructField("last_updated", NTZ, True)])

FACT_ORDERS = _schema(
    ("order_id", S, True), ("order_timestamp", NTZ, True), ("customer_id", S, True),
    ("product_id", S, True), ("quantity", I, True), ("total_amount", MONEY, True),
    ("currency", S, True), ("currency_mismatch_flag", B, True), ("status", S, True),
    ("load_date", DT, True))

SCHEMAS = {
    "sales": SALES, "sales_text": SALES_TEXT, "trips": TRIPS, "orders": ORDERS,
    "orders_text": ORDERS_TEXT, "orders_evolved_text": ORDERS_EVOLVED_TEXT,
    "stg_customers": STG_CUSTOMERS, "stg_products": STG_PRODUCTS, "stg_orders": STG_ORDERS,
    "landing_orders": LANDING_ORDERS, "dim_customers": DIM_CUSTOMERS,
    "dim_products": DIM_PRODUCTS, "fact_orders": FACT_ORDERS,
}


def conform(df, schema: T.StructType):
    """Select and cast ``df`` to ``schema`` (write-time conformance, S7).

    Columns missing from ``df`` are added as typed nulls.
    """
    from pyspark.sql import functions as F
    have = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])
