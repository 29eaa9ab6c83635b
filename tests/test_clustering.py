"""Hilbert keys and range bounds of several clustering columns."""

import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import layout


def _walk(n, bits):
    """Cells in the order of the state table."""
    table, low = layout.hilbert_table(n)
    place = {}
    for cell in np.ndindex(*[1 << bits] * n):
        state, at = 0, 0
        for b in range(bits - 1, -1, -1):
            corner = sum((cell[i] >> b & 1) << (n - 1 - i) for i in range(n))
            step = table[state * (1 << n) + corner]
            at, state = at << n | step >> low, step & (1 << low) - 1
        place[at] = cell
    return [place[k] for k in sorted(place)]


@pytest.mark.parametrize("n, bits", [(1, 4), (2, 1), (2, 5), (3, 3), (4, 2), (5, 2), (6, 1)])
def test_hilbert_curve_moves_one_step_at_a_time(n, bits):
    cells = np.array(_walk(n, bits))
    assert len(cells) == 1 << n * bits
    assert (np.abs(np.diff(cells, axis=0)).sum(axis=1) == 1).all()


def test_key_expression_equals_the_walk(spark):
    n, bits = 3, 6
    rows = [tuple(map(int, c)) for c in np.random.default_rng(2).integers(0, 64, (500, n))]
    full = rows + [(v, v, v) for v in range(64) for _ in range(20)]
    df = spark.createDataFrame(full, "a long, b long, c long")
    x = df.withColumn("k", layout._curve_key(df, ["a", "b", "c"], "hilbert")).collect()
    bounds = layout._range_bounds(df, ["a", "b", "c"], 64)
    number = lambda v, i: sum(v >= q for q in bounds[i])
    table, low = layout.hilbert_table(n)
    for r in x:
        state, at, cell = 0, 0, [number(r[i], i) for i in range(n)]
        for b in range(bits - 1, -1, -1):
            step = table[state * 8 + sum((cell[i] >> b & 1) << (n - 1 - i) for i in range(n))]
            at, state = at << n | step >> low, step & (1 << low) - 1
        assert r["k"] == at


def _files_hit(spark, path, column, width):
    """Files whose value range meets a query window, averaged over the windows."""
    import pyarrow.parquet as pq
    ranges = []
    for f in glob.glob(path + "/part-*"):
        values = pq.read_table(f, columns=[column]).column(0).to_numpy()
        ranges.append((values.min(), values.max()))
    return np.mean([sum(lo <= q + width and hi >= q for lo, hi in ranges) for q in np.arange(0, 1, 0.01)])


def test_hilbert_reads_fewer_files_than_zorder(spark, tmp_dir):
    df = spark.range(40_000).select(F.rand(1).alias("a"), F.rand(2).alias("b"))
    hit = {}
    for curve in ("hilbert", "zorder"):
        path = os.path.join(tmp_dir, curve)
        layout.cluster_by(df, ["a", "b"], 24, curve=curve).write.parquet(path)
        hit[curve] = _files_hit(spark, path, "a", 0.0) + _files_hit(spark, path, "b", 0.0)
        assert spark.read.parquet(path).count() == 40_000
    assert hit["hilbert"] < hit["zorder"] < 48


def test_bounds_of_all_columns_come_from_one_scan(spark):
    df = spark.createDataFrame([(i % 10, float(i), None if i % 3 else "x" * (i % 50), None) for i in range(1000)],
                               "a int, b double, s string, n long").withColumn("d", F.lit("2024-01-01").cast("date"))
    bounds = layout._range_bounds(df, df.columns, 8)
    assert bounds[0] == list(range(10))[1::1][:len(bounds[0])] or len(bounds[0]) <= 7
    assert len(bounds[1]) == 7 and bounds[3] == [] and len(bounds[4]) == 1
    got = layout.cluster_by(df, ["a", "b", "s", "n", "d"], 4)
    assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    wide = df.select(*[F.col("b").alias(f"c{i}") for i in range(8)])
    assert layout.cluster_by(wide, wide.columns, 3).count() == 1000
