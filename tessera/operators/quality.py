"""Expectations and data-quality checks.

Checks are expressed as data: each check is a one-row frame
``(check, observed, passed)``; the report is their union, and only the final
all-pass decision (one boolean) reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tessera.functions.scalar import true_only
from tessera.operators.util import attach_row


def expect_or_drop(df: DataFrame, name: str, cond: Column,
                   observation: Observation | str | None = None):
    """Keep rows where ``cond`` is TRUE, drop the rest (null counts as a
    violation), and count both in the same pass with ``observe``.

    Returns ``(kept_df, observation)``; ``observation.get`` holds
    ``{name}_rows`` and ``{name}_dropped`` after the first action. Works on
    batch and streaming frames (for a stream pass a name, read the metrics from
    the query's progress). The filter sits above the ``observe`` node, so it
    is not pushed into the scan: the counts must see every row.
    """
    obs = observation if observation is not None else Observation(f"expect_{name}")
    observed = df.observe(obs, F.count(F.lit(1)).alias(f"{name}_rows"),
                          F.count_if(~true_only(cond)).alias(f"{name}_dropped"))
    return observed.where(true_only(cond)), obs


def expectation_counts(df: DataFrame, name: str, cond: Column) -> DataFrame:
    """P6 as a frame: one row with rows seen, kept and dropped by ``cond``."""
    ok = true_only(cond)
    return df.agg(F.lit(name).alias("expectation"),
                  F.count(F.lit(1)).alias("rows_seen"),
                  F.count_if(ok).alias("rows_kept"),
                  F.count_if(~ok).alias("rows_dropped"))


def count_violations(df: DataFrame, bad: Column, alias: str = "n_invalid") -> DataFrame:
    """Rows for which ``bad`` is TRUE."""
    return df.agg(F.count_if(true_only(bad)).alias(alias))


def _check(name: str, observed: Column, passed: Column) -> list[Column]:
    return [F.lit(name).alias("check"), observed.cast("long").alias("observed"),
            passed.alias("passed")]


def check_not_empty(df: DataFrame, name: str = "not_empty") -> DataFrame:
    """Q1: table has at least one row."""
    n = F.count(F.lit(1))
    return df.agg(*_check(name, n, n > 0))


def check_no_nulls(df: DataFrame, cols, name: str = "no_null_keys") -> DataFrame:
    """Q2: no row has a null in any of ``cols``."""
    any_null = None
    for c in cols:
        x = F.col(c).isNull()
        any_null = x if any_null is None else any_null | x
    n = F.count_if(any_null)
    return df.agg(*_check(name, n, n == 0))


def check_unique(df: DataFrame, cols, name: str = "unique_key") -> DataFrame:
    """Primary-key rule: no two rows share a key (``observed``: keys that repeat)."""
    repeats = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    n = F.count(F.lit(1))
    return repeats.agg(*_check(name, n, n == 0))


def check_counts(stg: DataFrame, fact: DataFrame, load_date, name: str = "fact_matches_staging"
                 ) -> DataFrame:
    """Q3: staging row count equals fact rows of ``load_date``."""
    a = stg.agg(F.count(F.lit(1)).alias("n_stg"))
    b = fact.where(F.col("load_date") == F.lit(load_date).cast("date")).agg(
        F.count(F.lit(1)).alias("n_fact"))
    both = attach_row(a, b)
    return both.select(*_check(name, F.col("n_fact"), F.col("n_stg") == F.col("n_fact")))


def report(*checks: DataFrame) -> DataFrame:
    """Union of one-row checks."""
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def all_passed(report_df: DataFrame) -> DataFrame:
    """Q4 as data: one row, true only if every check passed (an undecided
    check, passed = null, fails: plain ``bool_and`` would ignore it)."""
    return report_df.agg(F.bool_and(true_only(F.col("passed"))).alias("all_passed"))


def require(report_df: DataFrame) -> None:
    """Q4: raise when any check failed. Only one boolean reaches the driver."""
    ok = all_passed(report_df).first()[0]
    if not ok:
        raise ValueError("DATA QUALITY FAILED")


def volume_status(fact: DataFrame, load_date, threshold: int = 10) -> DataFrame:
    """Q5: count of fact rows for ``load_date`` and the branch it selects."""
    n = F.count(F.lit(1))
    return (fact.where(F.col("load_date") == F.lit(load_date).cast("date"))
                .agg(F.lit(load_date).cast("date").alias("load_date"), n.alias("n_orders"))
                .withColumn("branch", F.when(F.col("n_orders") < threshold,
                                             F.lit("warn_low_volume")).otherwise(F.lit("normal_end"))))


def anomaly_lines(status: DataFrame) -> DataFrame:
    """K6 body: one text line per low-volume status row, none otherwise. Fixed: the text."""
    return (status.where(F.col("branch") == "warn_low_volume")
                  .select(F.format_string("LOW ORDER COUNT DETECTED: %d", F.col("n_orders"))
                          .alias("value")))
