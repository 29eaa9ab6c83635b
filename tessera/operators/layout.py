"""File layout: report, compaction, clustering (K9, V7, V8).

* ``layout_report`` counts files and bytes per partition from the hidden
  ``_metadata`` columns: a distributed aggregate, no file listing on the
  driver.
* ``compact`` rebalances a table by its partition columns (AQE): one file
  per partition value, several advisory-sized files for a very large value.
* ``cluster_by`` range-partitions on the clustering column(s) and sorts inside
  each file, so parquet min/max statistics of each file cover a narrow range
  and a point lookup skips most files. For several columns the sort key is a
  Z-order (bit-interleaved) value built from native expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def layout_report(df: DataFrame, partition_cols: Sequence[str] = ()) -> DataFrame:
    """K9: files, bytes and rows per partition (from ``_metadata``)."""
    cols = list(partition_cols)
    x = df.select(*cols, F.col("_metadata.file_path").alias("_f"),
                  F.col("_metadata.file_size").alias("_s"))
    per_file = x.groupBy(*cols, "_f").agg(F.max("_s").alias("_s"), F.count(F.lit(1)).alias("_n"))
    return per_file.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_files"),
                                       F.sum("_s").alias("n_bytes"),
                                       F.sum("_n").alias("n_rows"))


def compact(df: DataFrame, partition_cols: Sequence[str] = (), files: int | None = None) -> DataFrame:
    """V7: same rows, few files. Partitioned: rebalance by the partition columns, so each
    partition value is one file unless it exceeds AQE's advisory partition size, in
    which case it becomes several files of about that size. ``files``: that many slices
    of about equal size, by ranges of the partition columns and a row hash, so a hot
    value is split over several; unpartitioned, exactly that many files."""
    cols = list(partition_cols)
    if files:
        return df.repartitionByRange(files, *cols, F.xxhash64(*df.columns)) if cols else df.repartition(files)
    return df.hint("rebalance", *cols) if cols else df.hint("rebalance")


#: Rows sampled, on average, to place the range bounds of the clustering columns (layout only).
BOUND_SAMPLE = 10_000


def _range_bounds(df: DataFrame, cols: Sequence[str], ranges: int) -> list[list]:
    """For each column at most ``ranges - 1`` ascending values that cut it into ranges of about
    equal size: quantiles of one random sample of rows, taken in a single scan of the
    clustering columns (its share follows from the row count, so its size does not grow)."""
    share = min(1.0, BOUND_SAMPLE / max(1, df.count()))
    rows = df.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)]).sample(share, seed=1).collect()
    bounds = []
    for i in range(len(cols)):
        values = sorted(r[i] for r in rows if r[i] is not None and r[i] == r[i])
        bounds.append(sorted({values[len(values) * k // ranges] for k in range(1, ranges)}) if values else [])
    return bounds


def _range_number(c: Column, bounds: list, dtype: T.DataType) -> Column:
    """How many of the ascending bounds are not above the value (null: none), by halving."""
    def between(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(c >= F.lit(bounds[mid]).cast(dtype), between(mid + 1, hi)).otherwise(between(lo, mid))

    return between(0, len(bounds))


def hilbert_table(n: int) -> tuple[list[int], int]:
    """State table of the ``n``-dimensional Hilbert curve. A state is the corner at which the
    curve enters a cell and the axis it leaves along (Hamilton's rules). Entry ``state *
    2**n + corner`` holds ``step << bits | next state``, where step counts along the curve;
    also returns ``bits``."""
    size = 1 << n
    gray = lambda i: i ^ i >> 1
    inverse = {gray(i): i for i in range(size)}
    trailing = lambda i: (~i & i + 1).bit_length() - 1  # noqa: E731 - trailing set bits
    left = lambda x, k: (x << k % n | x >> (n - k % n)) & size - 1  # noqa: E731 - rotation of n bits
    entry = lambda w: 0 if w == 0 else gray(2 * ((w - 1) // 2))
    axis = lambda w: 0 if w == 0 else trailing(w - 1 if w % 2 == 0 else w) % n
    bits, out = (n * size - 1).bit_length(), []
    for state in range(n * size):
        e, d = divmod(state, n)
        for corner in range(size):
            w = inverse[left(corner ^ e, n - (d + 1) % n)]
            after = (e ^ left(entry(w), d + 1)) * n + (d + axis(w) + 1) % n
            out.append(w << bits | after)
    return out, bits


def _curve_key(df: DataFrame, cols: Sequence[str], curve: str) -> Column:
    """Place of a row's range numbers on a Hilbert curve or in Z-order. Range bounds are
    quantiles, so outliers and long shared prefixes do not empty the ranges. 6 bits a
    column up to 10 columns, fewer beyond (the Hilbert curve takes up to 6 columns)."""
    bits = max(1, min(6, 62 // len(cols)))
    numbers = [_range_number(F.col(c), bounds, df.schema[c].dataType).cast("long")
               for c, bounds in zip(cols, _range_bounds(df, cols, 1 << bits), strict=True)]
    n = len(cols)
    numbers = F.array(*numbers)  # evaluated once a row, as the source of the fold below

    def corner(x: Column, b: int) -> Column:  # bit b of each column
        bit = [F.shiftright(F.get(x, F.lit(i)), b).bitwiseAND(F.lit(1)) * (1 << (n - 1 - i)) for i in range(n)]
        return sum(bit[1:], bit[0])

    corners = F.element_at(F.transform(F.array(numbers), lambda x: F.array(
        *[corner(x, b) for b in range(bits - 1, -1, -1)])), 1)
    if curve == "zorder":
        return F.aggregate(corners, F.lit(0).cast("long"), lambda key, c: key * (1 << n) + c)
    if n > 6:
        raise ValueError("a Hilbert key takes at most 6 columns")
    table, low = hilbert_table(n)
    steps = F.array(*[F.lit(x).cast("long") for x in table])

    def step(key: Column, c: Column) -> Column:  # key: place so far, then the state in the low bits
        state = key.bitwiseAND(F.lit((1 << low) - 1))
        return F.shiftleft(F.shiftright(key, low), low + n) + F.get(steps, (state * (1 << n) + c).cast("int"))

    return F.shiftright(F.aggregate(corners, F.lit(0).cast("long"), step), low)


def cluster_by(df: DataFrame, cols: Sequence[str], files: int, curve: str = "hilbert") -> DataFrame:
    """V8: range-partition into ``files`` files on the clustering key and sort within each.
    One column: the column itself; several: their place on a Hilbert curve (neighbours on
    it are neighbours in every column) or, with ``curve="zorder"``, in Z-order. A row hash
    ends the range key, so one value with many rows spreads over several files."""
    cols, tie = list(cols), F.xxhash64(*df.columns)
    if len(cols) == 1:
        return df.repartitionByRange(files, F.col(cols[0]), tie).sortWithinPartitions(cols[0])
    return (df.withColumn("_z", _curve_key(df, cols, "zorder" if len(cols) > 6 else curve))
            .repartitionByRange(files, F.col("_z"), tie).sortWithinPartitions("_z").drop("_z"))
