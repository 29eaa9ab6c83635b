"""Retail sales flow (A1): extract -> transform -> load, plus the notebook's
filters, statistics and scoring.

``run_etl`` is the mini ETL: read the CSV as text with a declared schema,
clean it (``clean_sales``: coerce, fill, derive ``computed_total`` and
``is_high_value``, dedupe), write JSON records. ``notebook_clean`` is the
notebook's own clean-up, which overwrites ``total`` (decision F1).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera import schemas
from tessera.functions.scalar import flag01, round_half_even, weighted_sum
from tessera.operators.clean import clean_sales
from tessera.sources.files import read_csv
from tessera.sources.writers import write_json

# Fixed value of the engagement score (weights of quantity, total, promo flag).
SCORE_WEIGHTS = (0.4, 0.5, 2.0)


def notebook_clean(sales: DataFrame, order: Sequence) -> DataFrame:
    return clean_sales(sales, order, recompute_total=True).drop("computed_total", "is_high_value")


def engagement(clean: DataFrame) -> DataFrame:
    """Promo flag and ``round((0.4*qty + 0.5*total + 2*flag), 2)``
    with numpy's half-to-even rounding."""
    wq, wt, wp = SCORE_WEIGHTS
    flag = flag01(F.col("promo_code") != F.lit("NONE"))
    x = clean.withColumn("promo_used_flag", flag)
    score = weighted_sum([(wq, "quantity"), (wt, "total"), (wp, "promo_used_flag")])
    return x.withColumn("engagement_score", round_half_even(score, 2))


def run_etl(spark: SparkSession, csv_path: str, out_path: str, order: Sequence,
            high_value: float = 1000.0) -> DataFrame:
    """extract -> transform -> load; returns the cleaned frame (lazy)."""
    raw = read_csv(spark, csv_path, schemas.SALES_TEXT)
    clean = clean_sales(raw, order, high_value=high_value)
    write_json(clean, out_path)
    return clean
