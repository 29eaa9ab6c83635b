"""Catalogue entries of the sales flow."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import testviews as tv
from tessera.functions.scalar import to_number_or_null, to_timestamp_or_null
from tessera.operators.changes import concat
from tessera.operators.clean import clean_sales
from tessera.operators.filters import between, greater_than, not_equal_count, where_equals
from tessera.operators.keyed import first_per_key
from tessera.operators.stats import (describe_exact, distinct_lists, group_mean, group_sum,
                                     mean_of, median_of, row_count, top_group)
from tessera.operators.synth import draw_sql, synth_sales
from tessera.operators.util import attach_row
from tessera.plans import sales as sales_flow
from tessera.plans.catalog import register
from tessera.session import scratch_path
from tessera.sources.files import read_csv, read_json_records
from tessera.sources.writers import write_csv, write_json
from tessera import schemas

ORDER = tv.SALES_ORDER
ORDER_SQL = tv.SALES_ORDER_SQL

MED_SQL = "med AS (SELECT median(unit_price) AS m FROM sales)"
FILLED_SQL = """filled AS (
  SELECT transaction_id, store_id, coalesce(store_name, 'Unknown Store') AS store_name, date,
         product_id, coalesce(product_name, 'Unknown Product') AS product_name,
         coalesce(quantity, 1.0) AS quantity, coalesce(unit_price, m) AS unit_price, total,
         customer_id, coalesce(promo_code, 'NONE') AS promo_code
  FROM sales CROSS JOIN med)"""
CLEAN_SQL = f"""clean AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, quantity * unit_price AS computed_total,
           coalesce(quantity * unit_price > 1000.0, false) AS is_high_value,
           row_number() OVER (PARTITION BY transaction_id ORDER BY {ORDER_SQL}) AS rn
    FROM filled) WHERE rn = 1)"""
NB_CLEAN_SQL = f"""nb AS (
  SELECT * EXCLUDE (rn, total) , quantity * unit_price AS total FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY
      date ASC NULLS FIRST, product_id ASC NULLS FIRST, store_id ASC NULLS FIRST,
      quantity ASC NULLS FIRST, unit_price ASC NULLS FIRST, quantity * unit_price ASC NULLS FIRST,
      customer_id ASC NULLS FIRST, promo_code ASC NULLS FIRST) AS rn
    FROM filled) WHERE rn = 1)"""


def S(body: str, *ctes: str) -> str:
    head = tv.with_views("", "sales").rstrip()
    return head + ("".join(",\n" + c for c in ctes)) + "\n" + body


def _sales(spark, sf):
    return tv.sales(spark, sf)


def _clean(spark, sf):
    return clean_sales(_sales(spark, sf), ORDER, high_value=1000.0)


def _nb_clean(spark, sf):
    return sales_flow.notebook_clean(_sales(spark, sf), ORDER)


@register("clean_sales", S("SELECT * FROM clean", MED_SQL, FILLED_SQL, CLEAN_SQL))
def q_clean_sales(spark, sf):
    """The ETL transform (median before dedupe)."""
    return _clean(spark, sf)


@register("coerce_types", tv.with_views(
    "SELECT event_id, TRY_CAST(value_text AS DOUBLE) AS value, "
    "TRY_CAST(ts_text AS TIMESTAMP) AS ts FROM events_text", "events_text"))
def q_coerce_types(spark, sf):
    """X1 + X2: text with planted junk / empty values -> typed, bad -> null."""
    e = tv.events_text(spark, sf)
    return e.select("event_id", to_number_or_null("value_text").alias("value"),
                    to_timestamp_or_null("ts_text").alias("ts"))


@register("sales_by_store", S("SELECT * FROM sales WHERE store_name = 'Supplier#000000001'"))
def q_sales_by_store(spark, sf):
    """P1 (string): rows of one store name."""
    return where_equals(_sales(spark, sf), "store_name", "Supplier#000000001")


@register("sales_by_store_id", S("SELECT * FROM sales WHERE store_id = 2"))
def q_sales_by_store_id(spark, sf):
    """P1 (int): rows of one store id."""
    return where_equals(_sales(spark, sf), "store_id", 2)


@register("sales_date_range", S(
    "SELECT * FROM sales WHERE date >= TIMESTAMP '1996-01-02' AND date <= TIMESTAMP '1996-01-05'"))
def q_sales_date_range(spark, sf):
    """Closed date range (upper bound is midnight of the last day)."""
    return between(_sales(spark, sf), "date", "1996-01-02", "1996-01-05")


@register("sales_high_value", S("SELECT * FROM sales WHERE total > 95000.0"))
def q_sales_high_value(spark, sf):
    """Total above a threshold."""
    return greater_than(_sales(spark, sf), "total", 95000.0)


@register("store_revenue", S(
    "SELECT store_name, coalesce(CAST(sum(CAST(total AS DECIMAL(38,2))) AS DOUBLE), 0.0) AS total "
    "FROM sales WHERE store_name IS NOT NULL GROUP BY store_name"))
def q_store_revenue(spark, sf):
    """G1: revenue per store (exact decimal sum)."""
    return group_sum(_sales(spark, sf), "store_name", "total", "total", exact_scale=2)


@register("avg_basket", S(
    "SELECT CAST(sum(CAST(total AS DECIMAL(38,2))) AS DOUBLE) / CAST(count(total) AS DOUBLE) "
    "AS avg_basket FROM sales"))
def q_avg_basket(spark, sf):
    """Mean basket value."""
    return mean_of(_sales(spark, sf), "total", "avg_basket", exact_scale=2)


@register("avg_basket_by_store", S(
    "SELECT store_name, CAST(sum(CAST(total AS DECIMAL(38,2))) AS DOUBLE) / "
    "CAST(count(total) AS DOUBLE) AS avg_basket FROM sales WHERE store_name IS NOT NULL "
    "GROUP BY store_name"))
def q_avg_basket_by_store(spark, sf):
    """Mean basket per store."""
    return group_mean(_sales(spark, sf), "store_name", "total", "avg_basket", exact_scale=2)


DESCRIBE_COLS = ["quantity", "unit_price", "total", "customer_id", "date"]


def _describe_sql() -> str:
    parts = []
    for c in DESCRIBE_COLS:
        is_t = c == "date"
        v = f"(epoch_us({c}) / 1000000.0)" if is_t else f"CAST({c} AS DOUBLE)"
        r = 3 if is_t else 6
        std = "CAST(NULL AS DOUBLE)" if is_t else f"round(stddev_samp({v}), {r})"
        parts.append(
            f"SELECT '{c}' AS column_name, CAST(count({v}) AS DOUBLE) AS count, "
            f"CAST(sum(CAST({v} AS DECIMAL(38,6))) AS DOUBLE) / CAST(count({v}) AS DOUBLE) AS mean, "
            f"{std} AS std, min({v}) AS min, "
            f"round(quantile_cont({v}, 0.25), {r}) AS q25, round(quantile_cont({v}, 0.5), {r}) AS q50, "
            f"round(quantile_cont({v}, 0.75), {r}) AS q75, max({v}) AS max FROM sales")
    return S(" UNION ALL ".join(parts))


@register("describe_sales", _describe_sql())
def q_describe_sales(spark, sf):
    """Exact describe (count, mean, std, min, quartiles, max); datetime
    as epoch seconds. Means are exact (decimal sums); std and quartiles are
    rounded for the check (6 places; 3 for epoch seconds)."""
    d = describe_exact(_sales(spark, sf), DESCRIBE_COLS, exact_scale=6)

    def rnd(c):
        return F.when(F.col("column") == "date", F.round(c, 3)).otherwise(F.round(c, 6))
    return d.select(F.col("column").alias("column_name"), "count", "mean",
                    rnd("std").alias("std"), "min", rnd("q25").alias("q25"),
                    rnd("q50").alias("q50"), rnd("q75").alias("q75"), "max")


@register("median_price", S("SELECT median(unit_price) AS median FROM sales"))
def q_median_price(spark, sf):
    """Exact median of unit_price (nulls ignored)."""
    return median_of(_sales(spark, sf), "unit_price", "median")


@register("top_product", S(
    "SELECT product_name, CAST(sum(CAST(quantity AS DECIMAL(38,2))) AS DOUBLE) AS total_quantity "
    "FROM nb WHERE product_name IS NOT NULL GROUP BY product_name "
    "ORDER BY total_quantity DESC, product_name LIMIT 1", MED_SQL, FILLED_SQL, NB_CLEAN_SQL))
def q_top_product(spark, sf):
    """O3: product sold the most (total quantity) after the notebook clean-up."""
    return top_group(_nb_clean(spark, sf), "product_name", "quantity", "total_quantity",
                     exact_scale=2)


@register("promo_count", S(
    "SELECT count(*) AS n_promo FROM nb WHERE promo_code <> 'NONE'",
    MED_SQL, FILLED_SQL, NB_CLEAN_SQL))
def q_promo_count(spark, sf):
    """Transactions with a promo code (after the NONE fill)."""
    return not_equal_count(_nb_clean(spark, sf), "promo_code", "NONE", "n_promo")


@register("engagement_score", S(
    """SELECT transaction_id, quantity, total, promo_code, promo_used_flag,
              round_even((quantity * 0.4::DOUBLE + total * 0.5::DOUBLE
                          + promo_used_flag * 2.0::DOUBLE) * 100.0::DOUBLE, 0) / 100.0::DOUBLE
              AS engagement_score
       FROM (SELECT *, CASE WHEN promo_code <> 'NONE' THEN 1 ELSE 0 END AS promo_used_flag FROM nb)""",
    MED_SQL, FILLED_SQL, NB_CLEAN_SQL))
def q_engagement_score(spark, sf):
    """Promo flag and half-even rounded engagement score."""
    e = sales_flow.engagement(_nb_clean(spark, sf))
    return e.select("transaction_id", "quantity", "total", "promo_code", "promo_used_flag",
                    "engagement_score")


@register("dedupe_sales", S(
    f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id "
    f"ORDER BY {ORDER_SQL}) AS rn FROM sales) WHERE rn = 1"))
def q_dedupe_sales(spark, sf):
    """Keep the first row per transaction_id (raw rows, no fill)."""
    return first_per_key(_sales(spark, sf), ["transaction_id"], ORDER)


@register("distinct_dims", S(
    "SELECT DISTINCT 'store_id' AS dim, CAST(store_id AS VARCHAR) AS value FROM sales "
    "UNION SELECT DISTINCT 'store_name', store_name FROM sales "
    "UNION SELECT DISTINCT 'product_id', CAST(product_id AS VARCHAR) FROM sales "
    "UNION SELECT DISTINCT 'product_name', product_name FROM sales "
    "UNION SELECT DISTINCT 'promo_code', coalesce(promo_code, 'NONE') FROM sales"))
def q_distinct_dims(spark, sf):
    """Distinct stores, products and promo codes (missing promo -> NONE)."""
    return distinct_lists(_sales(spark, sf), ["store_id", "store_name", "product_id", "product_name", "promo_code"],
                          {"promo_code": "NONE"})


@register("row_counts", S(
    "SELECT (SELECT count(*) FROM sales) AS n_raw, (SELECT count(*) FROM clean) AS n_clean",
    MED_SQL, FILLED_SQL, CLEAN_SQL))
def q_row_counts(spark, sf):
    """Shape before and after cleaning."""
    raw = row_count(_sales(spark, sf), "n_raw")
    clean = row_count(_clean(spark, sf), "n_clean")
    return attach_row(raw, clean)


def _synth_sql(n: int = 1000) -> str:
    r = {s: draw_sql("i", s) for s in range(8)}
    return f"""
  start AS (SELECT coalesce(max(transaction_id), -1) + 1 AS s FROM sales),
  stores AS (SELECT store_id, store_name,
                    row_number() OVER (ORDER BY store_id NULLS FIRST, store_name NULLS FIRST) - 1 AS idx
             FROM (SELECT DISTINCT store_id, store_name FROM sales)),
  pnames AS (SELECT product_name, row_number() OVER (ORDER BY product_name) - 1 AS idx
             FROM (SELECT DISTINCT product_name FROM sales WHERE product_name IS NOT NULL)),
  pids AS (SELECT product_name, product_id FROM (
             SELECT product_name, product_id, row_number() OVER (PARTITION BY product_name
                    ORDER BY {ORDER_SQL}) AS rn FROM sales WHERE product_name IS NOT NULL) WHERE rn = 1),
  prods AS (SELECT pnames.product_name, idx, product_id FROM pnames JOIN pids USING (product_name)),
  promos AS (SELECT promo_code, row_number() OVER (ORDER BY promo_code) - 1 AS idx
             FROM (SELECT DISTINCT coalesce(promo_code, 'NONE') AS promo_code FROM sales)),
  gen AS (SELECT i, {", ".join(f"{r[s]} AS r{s}" for s in range(8))} FROM range({n}) t(i)),
  synth AS (
    SELECT start.s + gen.i AS transaction_id, stores.store_id, stores.store_name,
           CAST(printf('2025-10-%02d', 1 + r5 % 28) AS TIMESTAMP) AS date,
           prods.product_id, prods.product_name,
           CAST(1 + r3 % 10 AS DOUBLE) AS quantity,
           CAST(50 + r4 % 1451 AS DOUBLE) / 100.0::DOUBLE AS unit_price,
           round_even(CAST(1 + r3 % 10 AS DOUBLE) * (CAST(50 + r4 % 1451 AS DOUBLE) / 100.0::DOUBLE)
                      * 100.0::DOUBLE, 0) / 100.0::DOUBLE AS total,
           2001 + r7 % 3000 AS customer_id, promos.promo_code
    FROM gen CROSS JOIN start
         JOIN stores ON stores.idx = r0 % (SELECT count(*) FROM stores)
         JOIN prods ON prods.idx = r2 % (SELECT count(*) FROM prods)
         JOIN promos ON promos.idx = r6 % (SELECT count(*) FROM promos))"""


@register("synth_sales", S("SELECT * FROM synth", _synth_sql()))
def q_synth_sales(spark, sf):
    """1,000 seeded rows after the highest transaction id."""
    return synth_sales(spark, _sales(spark, sf), 1000, ORDER)


@register("sales_concat", S("SELECT * FROM sales UNION ALL SELECT * FROM synth", _synth_sql()))
def q_sales_concat(spark, sf):
    """Original rows + generated rows, by column name, duplicates kept."""
    s = _sales(spark, sf)
    return concat(s, synth_sales(spark, s, 1000, ORDER))


@register("csv_roundtrip", S("SELECT * FROM sales"))
def q_csv_roundtrip(spark, sf):
    """K1 + S1: write sales as CSV with header, read back with the declared
    text schema and coerce (E: equals the source rows)."""
    path = scratch_path(spark, "csv_roundtrip")
    write_csv(_sales(spark, sf), path)
    back = read_csv(spark, path, schemas.SALES_TEXT)
    return back.select(
        *[to_number_or_null(c, t).alias(c) for c, t in
          [("transaction_id", "bigint"), ("store_id", "bigint")]],
        "store_name", to_timestamp_or_null("date").alias("date"),
        to_number_or_null("product_id", "bigint").alias("product_id"), "product_name",
        *[to_number_or_null(c).alias(c) for c in ("quantity", "unit_price", "total")],
        to_number_or_null("customer_id", "bigint").alias("customer_id"), "promo_code")


@register("json_roundtrip", S("SELECT * FROM clean", MED_SQL, FILLED_SQL, CLEAN_SQL))
def q_json_roundtrip(spark, sf):
    """K2 + S2: the ETL load: cleaned rows as JSON records (nulls kept), read
    back with the declared schema (E: equals the cleaned rows)."""
    clean = _clean(spark, sf)
    path = scratch_path(spark, "json_roundtrip")
    write_json(clean, path, compression="gzip", records_per_file=500_000)  # names repeat in every record
    return read_json_records(spark, path, clean.schema, array_file=False)
