"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

#: Rows a side may have before it is no longer broadcast (rows of a few longs:
#: a few tens of MB). Beyond it the same join runs as a shuffle join.
BROADCAST_ROWS = 500_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, each with as many underscores before it as it takes to differ from
    ``df``'s columns (whatever their case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts the
    lineage, survives lost executors and computes the plan once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint ``df`` (cheap to count: read back from a written table) for broadcast
    when its measured row count is under the bound; otherwise leave it to a shuffle
    join, whose skewed partitions AQE splits."""
    return F.broadcast(df) if len(df.limit(rows + 1).select(F.lit(1)).take(rows + 1)) <= rows else df


def pieces(batches: Iterator[pa.RecordBatch], n_bytes: int = 4 << 20,
           rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one step works on about ``n_bytes`` of data: long
    texts come a few at a time, whatever the session's batch size."""
    for batch in batches:
        step = max(1, min(rows, int(batch.num_rows * n_bytes / max(1, batch.nbytes))))
        for k in range(0, batch.num_rows, step):
            yield batch.slice(k, step)


class IdStore:
    """Remembers the id sequence of each 64-bit key, at most about ``memory`` keys at a time."""

    def __init__(self, memory: int):
        self.memory = memory
        self._empty = (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32))
        self.known = self._empty

    def look_up(self, key: np.ndarray, make: Callable[[np.ndarray], list[list[int]]]
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Offset and number of ids in the returned store for each of the different keys;
        ``make`` gives the sequences of those (by index) that are new."""
        have, offset, n, store = self.known if len(self.known[0]) <= self.memory else self._empty
        pos = np.searchsorted(have, key)
        seen = have[np.minimum(pos, len(have) - 1)] == key if len(have) else np.zeros(len(key), bool)
        if not seen.all():
            new = np.flatnonzero(~seen)
            ids = make(new)
            more = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter((x for row in ids for x in row), np.int32, int(more.sum()))
            have = np.concatenate([have, key[new]])
            offset = np.concatenate([offset, len(store) + np.cumsum(more) - more])
            n, store = np.concatenate([n, more]), np.concatenate([store, flat])
            order = np.argsort(have, kind="stable")
            have, offset, n = have[order], offset[order], n[order]
            pos = np.searchsorted(have, key)
        self.known = (have, offset, n, store)
        return offset[pos], n[pos], store


def run_keys(symbol: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of symbols that starts at ``at``; the runs (with what a zero
    symbol fills) follow each other without gaps."""
    place = (np.arange(at[0], at[0] + int(length.sum())) - np.repeat(at, length)).astype(np.uint64)
    x = symbol[at[0]:at[0] + len(place)].astype(np.uint64)
    mixed = (x + (place << np.uint64(24)) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    mixed[x == 0] = 0
    return np.add.reduceat(mixed, at - at[0])


def first_places(which: np.ndarray, different: int) -> np.ndarray:
    """First place of each of the different values in the factorised array."""
    first = np.empty(different, np.int64)
    first[which[::-1]] = np.arange(len(which))[::-1]
    return first


def union_labels(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the sets of ``a[i]`` and ``b[i]`` in the label array ``parent`` (each
    label points to the smallest index of its set; kept fully compressed)."""
    while True:
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        low, high = np.minimum(ra[apart], rb[apart]), np.maximum(ra[apart], rb[apart])
        np.minimum.at(parent, high, low)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def connected_components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """``edges (src, dst)`` of one orderable type -> ``(id, component)`` for each id on
    an edge; the component is the smallest id reachable.

    Alternating large-star and small-star rounds. A node's neighbourhood is only
    ever reduced to its minimum (map-side combined) and joined back, never gathered,
    so a hub is a skewed join that AQE splits. Each round is written to the shared
    folder, so a lost executor costs one round at most. Self-loops and nulls are
    ignored; an empty input gives an empty result.
    """
    e = materialize(edges.select(F.greatest("src", "dst").alias("src"),
                                 F.least("src", "dst").alias("dst"))
                    .where("src <> dst").distinct(), name)
    seen = _state(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m"))
        large = (both.join(low, "src").where("dst > src")
                 .select(F.col("dst").alias("src"), F.col("m").alias("dst")).distinct())
        large = materialize(large, name)
        low = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = (large.join(low, "src").where("dst <> m").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
                 .unionByName(low.select("src", F.col("m").alias("dst"))).distinct())
        e = materialize(small, name)
        now = _state(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("src").alias("id"), F.col("dst").alias("component")).unionByName(
        e.select(F.col("dst").alias("id"), F.col("dst").alias("component")).distinct())


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("src", "dst")),
                       F.sum(F.xxhash64("dst", "src").cast("decimal(38,0)"))).first())
