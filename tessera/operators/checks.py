"""Many data-quality checks in one scan of each table.

A check names the counts it needs and how it judges them. ``run_checks`` collects the counts of
all checks by table, takes them in one aggregate per table and judges the one-row results;
``failing_rows`` names the rows that break the row-wise checks, again in one scan per table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tessera.functions.scalar import true_only
from tessera.operators.util import attach_row


@dataclass(frozen=True)
class Check:
    """``counts``: (table, row condition) of each count; ``judge``: the verdict on the counts, of
    which the first is reported; ``rows_fail``: the first condition is what a row must not meet."""

    name: str
    counts: tuple[tuple[str, Column], ...]
    judge: Callable[..., Column]
    rows_fail: bool = False


def not_empty(table: str, name: str) -> Check:
    """Q1: the table has a row."""
    return Check(name, ((table, F.lit(True)),), lambda n: n > 0)


def no_row(table: str, bad: Column, name: str) -> Check:
    """No row meets the condition (unknown is no)."""
    return Check(name, ((table, bad),), lambda n: n == 0, rows_fail=True)


def no_nulls(table: str, cols: Sequence[str], name: str) -> Check:
    """Q2: no row has a null in any of the columns."""
    return no_row(table, reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols]), name)


def equal_counts(table: str, cond: Column, other: str, other_cond: Column, name: str) -> Check:
    """Q3: as many rows of one table meet its condition as of the other; the first is reported."""
    return Check(name, ((table, cond), (other, other_cond)), lambda a, b: a == b)


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """``(check, observed, passed)``, one row per check, from one aggregate per table named."""
    wanted: dict[str, list[Column]] = {}
    for i, check in enumerate(checks):
        for j, (table, cond) in enumerate(check.counts):
            wanted.setdefault(table, []).append(F.count_if(true_only(cond)).alias(f"n{i}_{j}"))
    counted = reduce(attach_row, [tables[t].agg(*counts) for t, counts in wanted.items()])
    rows = [F.struct(F.lit(c.name).alias("check"), F.col(f"n{i}_0").alias("observed"),
                     c.judge(*[F.col(f"n{i}_{j}") for j in range(len(c.counts))]).alias("passed"))
            for i, c in enumerate(checks)]
    return counted.select(F.inline(F.array(*rows)))


def failing_rows(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """``(check, table, row)`` of each row that breaks a row-wise check; ``row`` is its JSON text,
    nulls included. Tables without such a check are not read."""
    found = []
    for name, df in tables.items():
        bad = [F.when(true_only(c.counts[0][1]), F.lit(c.name)) for c in checks if c.rows_fail and c.counts[0][0] == name]
        if bad:
            row = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
            found.append(df.select(F.explode(F.array_compact(F.array(*bad))).alias("check"),
                                   F.lit(name).alias("table"), row.alias("row")))
    if not found:
        raise ValueError("no row-wise check on any of the tables")
    return reduce(DataFrame.unionByName, found)
