"""Near-duplicate documents by SimHash and a hierarchical index in Gray order.

1. Each text becomes one 64-bit fingerprint (majority bits of its shingles' XXH64).
2. Equal fingerprints collapse to one row. At most 2,080 different fingerprints lie
   within two bits of a given one, so copies cannot make a group of pairs.
3. Different fingerprints are cut into blocks of equal size by Gray rank (neighbours in
   Gray order share long bit patterns). A block's node holds the bits all its members
   share; these nodes are the index's upper part (a bounded number of rows) and route
   each fingerprint to the later blocks whose shared bits differ in few enough places.
4. Inside a block the members' index goes on: groups of consecutive fingerprints share
   a masked pattern, groups of groups again. A search adds up the differences on the
   way down and drops a whole group once the sum is too large, or once everything
   below is already linked to the searching fingerprint.
5. A block hands on a spanning forest, not pairs; components follow from all forests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, materialize, pieces, union_labels

ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
TOP = np.uint64(1 << 63)


# ---- fingerprints ---------------------------------------------------------------

def shingle_hashes(text: bytes, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each ``words``-word shingle of the ASCII-lower-cased UTF-8 text."""
    parts = text.lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    h = xxhash.xxh64_intdigest
    joined = b" ".join(parts)
    if len(parts) <= words:
        return np.array([h(joined, seed)], np.uint64)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    end = np.cumsum(size + 1) - 1
    start = (end - size)[:len(parts) - words + 1].tolist()
    return np.array([h(joined[s:e], seed) for s, e in zip(start, end[words - 1:].tolist())], np.uint64)


def majority_bits(hashes: np.ndarray) -> int:
    """The integer whose bit is set where over half of the hashes have it set."""
    n, total = len(hashes), np.zeros(64, np.int64)
    for k in range(0, n, 65_280):
        bits = np.unpackbits(hashes[k:k + 65_280].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        lanes = bits.view(np.uint64)  # eight one-byte counters to a word: 255 rows cannot overflow
        for j in range(0, len(lanes), 255):
            total += lanes[j:j + 255].sum(axis=0, dtype=np.uint64).view(np.uint8)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Position of each value in the reflected Gray sequence (prefix xor of its bits)."""
    r = fp.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """``docs (doc_id, text)`` -> ``(doc_id, th, fp, rank)``: the text's hash, the fingerprint
    as a signed long and its Gray rank, shifted so that signed order is rank order. Null
    text: empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            fp = np.array([majority_bits(shingle_hashes(t or b"", words)) for t in b.column(2).to_pylist()],
                          np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(fp.view(np.int64)),
                 pa.array((gray_rank(fp) ^ TOP).view(np.int64))], ["doc_id", "th", "fp", "rank"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text"), F.col("text").cast("binary")).mapInArrow(
        run, "doc_id long, th long, fp long, rank long")


# ---- the index ------------------------------------------------------------------

class GrayIndex:
    """Tree over nodes in Gray order. A node is a mask of bits that everything below
    it shares, and their pattern; leaves given as plain values share all 64 bits."""

    def __init__(self, low: np.ndarray, high: np.ndarray, fanout: int = 16):
        """``low``/``high``: bitwise and / or of what each bottom node covers."""
        self.fanout, levels = fanout, [(low, high)]
        while len(levels[-1][0]) > fanout:
            cut = np.arange(0, len(levels[-1][0]), fanout)
            levels.append((np.bitwise_and.reduceat(levels[-1][0], cut), np.bitwise_or.reduceat(levels[-1][1], cut)))
        self.pattern = [lo for lo, _ in levels]
        masks = [~(lo ^ hi) for lo, hi in levels]
        self.rest = [m.copy() for m in masks]  # bits a node adds to those of the node above
        for k in range(len(levels) - 1):
            self.rest[k] &= ~masks[k + 1][np.arange(len(masks[k])) // fanout]

    def search(self, queries: np.ndarray, max_bits: int, label: np.ndarray | None = None,
               bottom: np.ndarray | None = None, first: np.ndarray | None = None,
               most: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query index, bottom node index) where the shared bits differ in at most
        ``max_bits`` places. ``label``/``bottom``: set labels of the queries and of the
        bottom nodes; a group that lies in the query's own set is dropped. ``first``:
        only bottom nodes from that index on. Works on at most about ``most`` entries
        at a time, depth first."""
        top, f = len(self.pattern) - 1, self.fanout
        lows, highs = [bottom], [bottom]
        if bottom is not None:
            for _ in range(top):
                cut = np.arange(0, len(lows[-1]), f)
                lows.append(np.minimum.reduceat(lows[-1], cut))
                highs.append(np.maximum.reduceat(highs[-1], cut))
        width = len(self.pattern[top])
        span = max(1, most // width)
        stack = [(top, np.repeat(np.arange(k, min(k + span, len(queries))), width),
                  np.tile(np.arange(width), min(span, len(queries) - k)), None)
                 for k in range(0, len(queries), span)]
        while stack:
            level, q, node, diff = stack.pop()
            if len(q) > 2 * most:
                stack += [(level, q[k:k + most], node[k:k + most], diff[k:k + most]) for k in range(0, len(q), most)]
                continue
            d = np.bitwise_count((queries[q] ^ self.pattern[level][node]) & self.rest[level][node])
            diff = d if diff is None else diff + d
            keep = diff <= max_bits
            if first is not None:
                keep &= (node + 1) * f ** level > first[q]
            if bottom is not None:
                keep &= (lows[level][node] != label[q]) | (highs[level][node] != label[q])
            q, node, diff = q[keep], node[keep], diff[keep]
            if not len(q):
                continue
            if level == 0:
                yield q, node
                continue
            below = (node[:, None] * f + np.arange(f)).ravel()
            there = below < len(self.pattern[level - 1])
            stack.append((level - 1, np.repeat(q, f)[there], below[there], np.repeat(diff, f)[there]))


def link_within(members: np.ndarray, visitors: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest, as (value, root value), of the graph that links members with
    each other and visitors with members at ``max_bits`` or fewer differing bits."""
    members = members[np.argsort(gray_rank(members), kind="stable")]
    m = len(members)
    both = np.concatenate([members, visitors])
    parent = np.arange(len(both))
    near = np.flatnonzero(np.bitwise_count(members[1:] ^ members[:-1]) <= max_bits)
    union_labels(parent, near, near + 1)
    index = GrayIndex(members, members)
    step = max(2048, -(-len(both) // 16))
    for k in range(0, len(both), step):
        found = index.search(both[k:k + step], max_bits, parent[k:k + step].copy(), parent[:m].copy())
        for q, node in found:
            union_labels(parent, q + k, node)
    child = np.flatnonzero(parent != np.arange(len(both)))
    return both[child], both[parent[child]]


def similar_links(values: DataFrame, max_bits: int, blocks: int = 64, block_rows: int = 1 << 20,
                  max_blocks: int = 8192) -> DataFrame:
    """``values (fp, rank)``, different fingerprints in a written table -> forest edges
    ``(src, dst)`` that connect exactly what chains of links connect.

    At least ``blocks`` blocks, more once they would hold over ``block_rows``, at most
    ``max_blocks``: the driver holds one row per block, its Gray-rank bound and its node.
    """
    blocks = max(blocks, min(max_blocks, -(-values.count() // block_rows)))
    cuts = values.agg(F.percentile_approx("rank", [i / blocks for i in range(1, blocks)],
                                          20 * blocks + 1000)).first()[0] or []
    bound = np.unique(np.array(cuts, np.int64))

    def assign(batches):
        for b in batches:
            block = np.searchsorted(bound, b.column(1).to_numpy(zero_copy_only=False), side="left")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(block.astype(np.int32))], ["fp", "block"])

    nodes = (values.select("fp", "rank").mapInArrow(assign, "fp long, block int").groupBy("block")
             .agg(F.bit_and("fp").alias("low"), F.bit_or("fp").alias("high")).orderBy("block").collect())
    block = np.array([r["block"] for r in nodes], np.int32)
    low, high = (np.array([r[c] for r in nodes], np.int64).view(np.uint64) for c in ("low", "high"))

    def route(batches):
        index = GrayIndex(low, high)
        for b in pieces(batches, rows=8192):
            fp, rank = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            own = np.searchsorted(block, np.searchsorted(bound, rank, side="left"))
            for q, node in index.search(fp.view(np.uint64), max_bits, first=own):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node.astype(np.int32)), pa.array(fp[q]), pa.array(own[q] == node)],
                    ["block", "fp", "member"])

    def inside(table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy().view(np.uint64)
        member = table.column("member").to_numpy(zero_copy_only=False).astype(bool)
        src, dst = link_within(fp[member], fp[~member], max_bits)
        return pa.table({"src": src.view(np.int64), "dst": dst.view(np.int64)})

    return (values.select("fp", "rank").mapInArrow(route, "block int, fp long, member boolean")
            .groupBy("block").applyInArrow(inside, "src long, dst long"))


def components(docs: DataFrame, words: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """The fingerprint table, and ``(fp, component)`` of each different fingerprint; the
    component is its smallest fingerprint as a signed long."""
    fps = materialize(fingerprints(docs, words), "simhash")
    values = materialize(fps.select("fp", "rank").distinct(), "simhash-values")
    edges = materialize(similar_links(values, max_bits), "simhash-edges")
    comp = connected_components(edges, "simhash-cc").withColumnRenamed("id", "fp")
    return fps, values.select("fp").join(comp, "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with ``doc_id`` and ``text`` -> one row per input row:
    ``(doc_id, fingerprint, component_id)``.

    * Fingerprints link at ``max_bits`` or fewer differing bits; ``component_id`` is the
      smallest ``doc_id`` reachable over chains of links.
    * Null text counts as empty; a text without words has fingerprint zero and links
      like any other. Repeated rows come back as often as they came.
    * A null ``doc_id`` never names a component; its row gets the smallest non-null id
      reachable, or null.
    * Other columns are ignored, whatever their names. Empty input: empty result.
    """
    fps, comp = components(docs, words, max_bits)
    named = fps.groupBy("fp").agg(F.min("doc_id").alias("rep")).join(comp, "fp")
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    owner = named.join(least, "component").select("fp", "component_id")
    return fps.join(owner, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` (needs ``doc_id`` and ``text``) with one row of each component: the one
    with the smallest non-null ``doc_id``, then the smallest text hash; a component
    without ids keeps the row of the smallest text hash. Of rows that repeat both, one
    stays. All columns as in ``docs``. Empty input: empty result."""
    fps, comp = components(docs, words, max_bits)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    first = (fps.groupBy("fp").agg(F.min(order).alias("first"), F.count("*").alias("n")).join(comp, "fp")
             .groupBy("component").agg(F.min("first").alias("first")))
    first = materialize(first.select(F.col("first.doc_id").alias("__id"), F.col("first.th").alias("__th")),
                        "simhash-first")
    kept = docs.join(first, docs["doc_id"].cast("long").eqNullSafe(first["__id"])
                     & F.xxhash64(docs["text"]).eqNullSafe(first["__th"]), "left_semi")
    repeats = fps.groupBy("doc_id", "th").count().where("count > 1").join(
        first, fps["doc_id"].eqNullSafe(first["__id"]) & fps["th"].eqNullSafe(first["__th"]), "left_semi")
    return kept if repeats.isEmpty() else kept.dropDuplicates(["doc_id", "text"])
