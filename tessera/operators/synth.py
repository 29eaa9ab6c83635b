"""Seeded synthetic sales rows.

Rows are generated with ``spark.range(n)`` (distributed) and every random
draw is a pure integer function of (row index, column slot, seed): the first 48 bits of
the MD5 of ``row:slot:seed``. Draws of different rows and slots are independent, any
engine can repeat them (no ``rand()``), and reruns give the same rows.
Choices from existing values use the sorted distinct lists numbered by
:func:`dense_index` and an equi-join on the drawn index; AQE broadcasts a list
only when its measured size is small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tessera.operators.stats import dense_index
from tessera.session import ensure_checkpoint_dir
from tessera.operators.util import attach_row

# Fixed parameters of the generator (ranges of the generated values).
QTY_RANGE = (1, 10)
PRICE_CENTS_RANGE = (50, 1500)
DAY_RANGE = (1, 28)
CUSTOMER_RANGE = (2001, 5000)
SLOTS = 8  # random draws per row


def draw(i: Column, slot: int, seed: int = 0) -> Column:
    key = F.concat(i.cast("string"), F.lit(f":{slot}:{seed}"))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("long")


def draw_sql(i: str, slot: int, seed: int = 0) -> str:
    return f"CAST('0x' || substr(md5(CAST({i} AS VARCHAR) || ':{slot}:{seed}'), 1, 12) AS BIGINT)"


def _pick(gen: DataFrame, choices: DataFrame, slot_col: str, size_col: str) -> DataFrame:
    """Join each generated row with the choice whose index = draw mod size."""
    g = gen.withColumn("_want", F.pmod(F.col(slot_col), F.col(size_col)))
    return g.join(choices, g["_want"] == choices["idx"], "inner").drop("_want", "idx")


def synth_sales(spark, sales: DataFrame, n: int, order: Sequence[str], seed: int = 0,
                independent_store: bool = False) -> DataFrame:
    """Q6: ``n`` new rows after the highest ``transaction_id``.

    Stores, product names and promo codes (missing -> ``NONE``) are drawn from
    the existing distinct values; a product's id is that of the first row
    (under ``order``) carrying the name (J4). By default a store id and name
    are drawn as a pair; ``independent_store`` draws the name separately, as
    the original generator did (decision F2).
    """
    # One pass over the input: grouping sets give the store pairs (or stores and
    # names), product names with their first id, promo codes and the highest id
    # in a single Expand + partially aggregated shuffle; the small result is
    # materialised once and every list is read from it.
    store_sets = [["store_id"], ["store_name"]] if independent_store else [["store_id", "store_name"]]
    sets = store_sets + [["product_name", "product_id"], ["promo_code"], []]
    keys = ["store_id", "store_name", "product_name", "promo_code"]
    # the "first row" order is taken on the raw columns, before the NONE fill; terms after the
    # product's id decide between rows of one product only
    order = list(order)
    before = order[:order.index("product_id")] if "product_id" in order else order
    src = sales.withColumns({f"_o{i}": F.col(o) for i, o in enumerate(before)})
    src = src.withColumn("promo_code", F.coalesce("promo_code", F.lit("NONE")))
    if len(before) == 1:  # plain numbers: a hash aggregate, which sorts no row
        least = [F.min("_o0").alias("_least"), F.max(F.col("_o0").isNull()).alias("_null")]
        rank = F.when(~F.col("_null"), F.col("_least"))  # nulls come first
    else:
        least = [F.min(F.struct(*[F.col(f"_o{i}") for i in range(len(before))]) if before else F.lit(0)).alias("_least")]
        rank = F.col("_least")
    ensure_checkpoint_dir(spark)
    g = (src.groupingSets(sets, *keys, "product_id")
            .agg(F.grouping_id().alias("_gid"), F.max("transaction_id").alias("_max_id"), *least)
            .checkpoint(eager=True))

    def gid(*grouped):
        every = [*keys, "product_id"]
        return sum(1 << (len(every) - 1 - i) for i, k in enumerate(every) if k not in grouped)

    start = g.where(F.col("_gid") == gid()).select(
        (F.coalesce(F.col("_max_id"), F.lit(-1)) + 1).alias("_start"))
    # number every list in one pass: within each grouping set the columns it
    # does not group by are null, so the key orders by the grouped columns
    names_of = F.col("_gid") == gid("product_name", "product_id")
    lists = g.where((F.col("_gid") != gid()) & ~(names_of & F.col("product_name").isNull()))
    numbered = dense_index(lists, keys, by=["_gid"], few_groups=True)  # <= 5 grouping sets

    def part(*grouped):
        return numbered.where(F.col("_gid") == gid(*grouped)).select(*grouped, "idx")

    if independent_store:
        stores, names = part("store_id"), part("store_name")
    else:
        stores = part("store_id", "store_name")
    pids = g.where(names_of).groupBy("product_name").agg(F.min_by("product_id", F.struct(rank, "product_id")).alias("product_id"))
    prods = numbered.where(names_of).select("product_name", "idx").join(pids, "product_name")
    promos = part("promo_code")

    def size(df: DataFrame, alias: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(alias))

    gen = spark.range(n).withColumnRenamed("id", "i")
    gen = gen.select("i", *[draw(F.col("i"), s, seed).alias(f"r{s}") for s in range(SLOTS)])
    gen = attach_row(gen, start)
    gen = attach_row(gen, size(stores, "_ns"))
    gen = attach_row(gen, size(prods, "_np"))
    gen = attach_row(gen, size(promos, "_nc"))
    out = _pick(gen, stores, "r0", "_ns")
    if independent_store:
        out = _pick(attach_row(out, size(names, "_nn")), names, "r1", "_nn")
    out = _pick(out, prods, "r2", "_np")
    out = _pick(out, promos, "r6", "_nc")
    qlo, qhi = QTY_RANGE
    plo, phi = PRICE_CENTS_RANGE
    dlo, dhi = DAY_RANGE
    clo, chi = CUSTOMER_RANGE
    qty = (F.lit(qlo) + F.pmod(F.col("r3"), F.lit(qhi - qlo + 1))).cast("double")
    price = (F.lit(plo) + F.pmod(F.col("r4"), F.lit(phi - plo + 1))) / F.lit(100.0)
    day = F.lit(dlo) + F.pmod(F.col("r5"), F.lit(dhi - dlo + 1))
    return out.select(
        (F.col("_start") + F.col("i")).alias("transaction_id"),
        "store_id", "store_name",
        F.format_string("2025-10-%02d", day).try_cast("timestamp_ntz").alias("date"),
        "product_id", "product_name",
        qty.alias("quantity"), price.alias("unit_price"),
        (F.rint(qty * price * 100) / 100).alias("total"),
        (F.lit(clo) + F.pmod(F.col("r7"), F.lit(chi - clo + 1))).alias("customer_id"),
        "promo_code")
