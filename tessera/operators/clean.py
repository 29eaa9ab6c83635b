"""Type coercion, missing-value fills, sales cleaning.

Order of steps follows the reference ETL: coerce -> fill (the median is taken
on the coerced input, before duplicates are dropped) -> derive -> dedupe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tessera.functions.scalar import MISSING, missing_to_null, to_number_or_null, to_timestamp_or_null
from tessera.operators.keyed import first_per_key
from tessera.operators.stats import exact_quantiles
from tessera.operators.util import attach_row


def coerce(df: DataFrame, timestamps: Sequence[str] = (), numbers: dict[str, str] | None = None,
           missing: Sequence[str] = ()) -> DataFrame:
    """Force types with "bad value -> null"; text fields that are one of ``missing``
    become null first.

    Text columns are parsed with ``try_to_timestamp`` / ``try_cast``; columns
    that already have a type are cast, which is a no-op for the same type.
    """
    numbers = numbers or {}
    dtypes = dict(df.dtypes)
    if missing:
        df = df.withColumns({c: missing_to_null(c, missing) for c, t in dtypes.items() if t == "string"})
    out = {}
    for c in timestamps:
        out[c] = to_timestamp_or_null(F.col(c)) if dtypes[c] == "string" else F.col(c)
    for c, t in numbers.items():
        out[c] = to_number_or_null(F.col(c), t)
    return df.withColumns(out) if out else df


def fill_missing(df: DataFrame, values: dict) -> DataFrame:
    """Replace nulls by constants, per column (``fillna({...})``)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def fill_median(df: DataFrame, col: str, approx: bool = False) -> DataFrame:
    """Replace nulls by the column median (nulls ignored).

    The median is a one-row aggregate attached with a broadcast join, so the
    plan stays lazy: no value is collected to the driver.
    """
    med = exact_quantiles(df, col, [0.5], names=["_median"], approx=approx)
    return (attach_row(df, med)
            .withColumn(col, F.coalesce(F.col(col), F.col("_median")))
            .drop("_median"))


SALES_NUMBERS = {"quantity": "double", "unit_price": "double", "total": "double",
                 "customer_id": "bigint"}
# key columns pandas reads as integers; text input (CSV) is typed the same way
SALES_KEYS = {"transaction_id": "bigint", "store_id": "bigint", "product_id": "bigint"}

# Fixed values of the sales clean-up (defaults that must match the reference).
SALES_FILLS = {"quantity": 1.0, "promo_code": "NONE", "product_name": "Unknown Product",
               "store_name": "Unknown Store"}


def clean_sales(df: DataFrame, order: Sequence, high_value: float = 1000.0,
                recompute_total: bool = False, approx_median: bool = False) -> DataFrame:
    """The sales ``transform``: coerce, fill, derive, dedupe.

    * ``computed_total = quantity * unit_price`` and
      ``is_high_value = computed_total > high_value``;
      ``recompute_total=True`` also overwrites ``total`` (the notebook variant,
      which recomputes every total, decision F1).
    * duplicates on ``transaction_id`` keep the first row under ``order``
      (a total order standing for input order).
    """
    x = coerce(df, timestamps=["date"], numbers={**SALES_KEYS, **SALES_NUMBERS}, missing=MISSING)
    x = fill_missing(x, {"quantity": SALES_FILLS["quantity"]})
    x = fill_median(x, "unit_price", approx=approx_median)
    x = fill_missing(x, {k: v for k, v in SALES_FILLS.items() if k != "quantity"})
    x = x.withColumn("computed_total", F.col("quantity") * F.col("unit_price"))
    if recompute_total:
        x = x.withColumn("total", F.col("computed_total"))
    x = x.withColumn("is_high_value", F.coalesce(F.col("computed_total") > F.lit(high_value),
                                                 F.lit(False)))
    return first_per_key(x, ["transaction_id"], order)
