"""Near-duplicate documents by MinHash signatures, banding and verified links.

1. A document is the set of its word shingles. ``bands * rows`` universal hashes of the
   shingles are minimised; a band of ``rows`` minima is one bucket key, one byte of each
   minimum is kept as the signature. Documents of equal sets are one node.
2. In each bucket all members meet one pivot, not each other. The different pairs of a node
   and a pivot, met in many bands or one, are told apart by sizes and signatures; those
   that may link are verified on their full sets. Components follow from verified links.
3. Similarity is not transitive: two members may link with each other and not with the
   pivot. The members of all buckets of one pivot are its group, and a group that
   still holds several components is compared in full: its largest component with the
   others, in blocks of bounded text that hand on spanning forests, again by signature
   and then by full sets. Members far from the pivot are not compared with those linked to
   it (Jaccard distances obey the triangle inequality). Where many blocks would be needed,
   further pivots join most of the group's components first.
4. So every two nodes of a bucket are in the end in one component, verified against each
   other or proven unlike, and no bucket's pairs are ever written out.
5. Components: alternating large-star and small-star rounds. Joins on keys that may be hot
   deal a hot key's rows over as many tasks as its measured count needs.

Two sets of similarity 0.8 share no bucket with probability 0.672 ** 40 = 1.3e-7 at the
default 40 bands of 5 minima (at 0.85: 6e-11). Signatures leave a pair unverified only six
standard deviations below the threshold.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialize, pieces

BANDS, ROWS = 40, 5

#: Rows of one key that one task takes in a join; more are dealt over several tasks. At
#: most ``MOST_HOT`` keys are counted as hot (the line rises with the number of rows).
HOT_ROWS, MOST_HOT = 1000, 50_000

#: Text bytes of one side of a block in the full comparison, and how many blocks a member
#: may be in on average before a group's components are first joined by further pivots.
BLOCK_BYTES, FEW_TIMES = 1 << 20, 3

#: Word hashes that a task keeps.
KEEP_WORDS = 200_000

LINKED, UNSURE, APART, TO_VERIFY = 0, 1, 2, 3


# ---- sets and signatures --------------------------------------------------------

def shingles(text: bytes | None, words: int) -> list[bytes]:
    """All ``words``-word shingles of the ASCII-lower-cased UTF-8 text, space-joined; a
    shorter text's whole word sequence is the only one; no words: none."""
    parts = text.lower().split() if text else []
    if not parts:
        return []
    joined = b" ".join(parts)
    if len(parts) <= words:
        return [joined]
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    end = np.cumsum(size + 1) - 1
    start = (end - size)[:len(parts) - words + 1].tolist()
    return [joined[s:e] for s, e in zip(start, end[words - 1:].tolist(), strict=True)]


class Minima:
    """``n`` strongly universal hashes ``(a * x + b mod 2**64) >> 32`` of 32-bit values."""

    def __init__(self, n: int):
        number = lambda kind: np.array([xxhash.xxh64_intdigest(f"{kind}{k}") for k in range(n)], np.uint64)
        self.a, self.b = number("a") | np.uint64(1), number("b")
        self.step = max(1, (1 << 15) // n)
        self.work = np.empty((self.step, n), np.uint64)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """The least value of each hash over the different 64-bit shingle hashes."""
        x = hashes & np.uint64(0xFFFFFFFF)
        least = np.full(len(self.a), 0xFFFFFFFFFFFFFFFF, np.uint64)
        for k in range(0, len(x), self.step):
            part = x[k:k + self.step, None]
            work = self.work[:len(part)]
            np.multiply(part, self.a, out=work)
            work += self.b
            np.minimum(least, work.min(axis=0), out=least)
        return (least >> np.uint64(32)).astype("<u4")  # the minimum's high half is the halves' minimum


class Words(dict):
    """Hash of each word met so far; forgotten when too many."""

    def __missing__(self, word: bytes) -> int:
        out = self[word] = xxhash.xxh64_intdigest(word)
        return out


def set_hashes(text: bytes | None, words: int, known: Words) -> np.ndarray:
    """Sorted 64-bit hashes of the text's different shingles, mixed from its words' hashes."""
    parts = text.lower().split() if text else []
    h = np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))
    if len(known) > KEEP_WORDS:
        known.clear()
    n = min(words, len(h))
    if not n:
        return h
    x = h[:len(h) - n + 1].copy()
    for k in range(1, n):
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x9E3779B97F4A7C15)
        x += h[k:len(h) - n + 1 + k]
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return np.unique(x)


def sketches(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """``docs (doc_id, text)`` -> ``(doc_id, text, n, k1, k2, sig, buckets)``: the size of the
    shingle set, its 128-bit hash, the signature and the bucket keys."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minima, known = Minima(bands * rows), Words()
        for b in pieces(batches):
            n, key, sig, buckets = [], [], [], []
            for t in b.column(1).to_pylist():
                h = set_hashes(t, words, known)
                n.append(len(h))
                key.append(xxhash.xxh3_128_digest(h.tobytes()))
                least = minima.of(h)
                sig.append(least.astype(np.uint8).tobytes())
                data = least.tobytes()
                buckets += [xxhash.xxh64_intdigest(data[k:k + 4 * rows], k) for k in range(0, len(data), 4 * rows)]
            k = np.frombuffer(b"".join(key), np.int64).reshape(-1, 2)
            buckets = pa.ListArray.from_arrays(pa.array(np.arange(0, bands * len(n) + 1, bands), pa.int32()),
                                               pa.array(np.array(buckets, np.uint64).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(k[:, 0]), pa.array(k[:, 1]),
                 pa.array(sig, pa.binary()), buckets], ["doc_id", "text", "n", "k1", "k2", "sig", "buckets"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(
        run, "doc_id long, text binary, n long, k1 long, k2 long, sig binary, buckets array<long>")


# ---- joins on keys that may be hot ------------------------------------------------

def join_hot(rows: DataFrame, table: DataFrame, keys: list[str], total: int, by: str) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has each key once and says in its column
    ``many`` (dropped) how many of the ``total`` rows have it. The rows of a key with more
    than ``line`` are dealt by the column ``by`` over copies of its table row; the list of
    these keys, at most ``MOST_HOT`` rows, is broadcast. The join itself is a merge at every
    size: what it moves grows in proportion."""
    line = max(HOT_ROWS, total // MOST_HOT)
    copies = F.ceil(F.col("many") / line)
    hot = table.where(F.col("many") > line).select(*keys, copies.alias("deals"))
    dealt = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "deal", F.pmod(F.xxhash64(by), F.coalesce("deals", F.lit(1).cast("long")))).drop("deals")
    spread = table.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), copies.cast("long") - 1))).drop("many")
    return dealt.join(spread.hint("merge"), [*keys, "deal"]).drop("deal")


# ---- components -------------------------------------------------------------------

def star_components(edges: DataFrame) -> DataFrame:
    """``edges (a, b)`` of longs -> ``(node, component)`` of each node on an edge; the
    component is the smallest node reachable. Large-star and small-star rounds alternate
    until nothing changes, each written to the shared folder. No neighbourhood is gathered:
    a node's edges are reduced to minimum and count, and hubs are dealt over tasks."""
    e = materialize(edges.select(F.greatest("a", "b").alias("src"), F.least("a", "b").alias("dst"))
                    .where("src <> dst").distinct(), "minhash-cc")
    seen = _state(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = (both.groupBy("src").agg(F.min("dst").alias("m"), F.count("*").alias("many"))
               .withColumn("m", F.least("src", "m")))
        large = materialize(join_hot(both, low, ["src"], 2 * seen[0], "dst").where("dst > src")
                            .select(F.col("dst").alias("src"), F.col("m").alias("dst")).distinct(), "minhash-cc")
        low = large.groupBy("src").agg(F.min("dst").alias("m"), F.count("*").alias("many"))
        small = (join_hot(large, low, ["src"], 2 * seen[0], "dst").where("dst <> m")
                 .select(F.col("dst").alias("src"), F.col("m").alias("dst"))
                 .unionByName(low.select("src", F.col("m").alias("dst"))).distinct())
        e = materialize(small, "minhash-cc")
        now = _state(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(
        e.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct())


def _state(e: DataFrame) -> tuple:
    """Number of edges and an order-free hash of them."""
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("src", "dst")),
                       F.sum(F.xxhash64("dst", "src").cast("decimal(38,0)"))).first())


# ---- pairs ------------------------------------------------------------------------

def signature_bounds(percent: int, size: int) -> tuple[float, float]:
    """Shares of equal signature bytes below which two sets are surely below the similarity
    threshold, and surely so unlike that no set can link with both (Jaccard distances add
    up: twice the threshold's distance). Surely: six standard deviations."""
    def below(p: float) -> float:
        return p - 6 * math.sqrt(p * (1 - p) / size)

    t = percent / 100
    return below(t), below(max(0.0, 2 * t - 1))


def may_link(equal: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int, bound: float) -> np.ndarray:
    """Whether sets of sizes ``n`` and ``m`` with this share of equal signature bytes may link."""
    return (equal >= bound) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))


def judge_by_signature(pairs: DataFrame, percent: int) -> DataFrame:
    """``pairs (node, pivot, n, sig, pivot_n, pivot_sig)`` -> ``(node, pivot, kind)``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, rows=10_000):
            get = lambda name: b.column(b.schema.get_field_index(name))  # noqa: E731, B023
            sig, other = (np.frombuffer(b"".join(get(x).to_pylist()), np.uint8).reshape(b.num_rows, -1)
                          for x in ("sig", "pivot_sig"))
            n, m = (get(x).to_numpy() for x in ("n", "pivot_n"))
            equal = (sig == other).mean(axis=1)
            bound, near = signature_bounds(percent, sig.shape[1])
            kind = np.where(may_link(equal, n, m, percent, bound), TO_VERIFY, UNSURE).astype(np.int32)
            kind[(equal < near) | (100 * np.minimum(n, m) < (2 * percent - 100) * np.maximum(n, m))] = APART
            yield pa.RecordBatch.from_arrays([get("node"), get("pivot"), pa.array(kind)], ["node", "pivot", "kind"])

    return pairs.mapInArrow(run, "node long, pivot long, kind int")


def similar(a: set[bytes], b: set[bytes], percent: int) -> bool:
    both = len(a & b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def verify(pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """``pairs (node, pivot, text, pivot_text)`` -> ``(node, pivot, kind)`` from the full sets.
    Rows of one pivot mostly come together, so its set is kept for the next row."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, of_last = None, set()
        for b in pieces(batches):
            kinds = []
            get = lambda name: b.column(b.schema.get_field_index(name))  # noqa: E731, B023
            for pivot, text, other in zip(*(get(x).to_pylist() for x in ("pivot", "text", "pivot_text")), strict=True):
                if pivot != last:
                    last, of_last = pivot, set(shingles(other, words))
                kinds.append(LINKED if similar(set(shingles(text, words)), of_last, percent) else UNSURE)
            yield pa.RecordBatch.from_arrays([get("node"), get("pivot"), pa.array(kinds, pa.int32())],
                                             ["node", "pivot", "kind"])

    return pairs.mapInArrow(run, "node long, pivot long, kind int")


@dataclass
class Member:
    node: int
    component: int
    n: int
    sig: np.ndarray
    text: bytes


def block_links(first: list[Member], rest: list[Member], words: int, percent: int) -> Iterator[tuple[int, int]]:
    """Links that join components of a block: the ``first`` members are compared with each other
    and with the ``rest``, by signature and size, then, while their components are still
    apart, on their full sets. The links given are a spanning forest."""
    every = first + rest
    sig, n = np.stack([r.sig for r in every]), np.array([r.n for r in every])
    sets, root = {}, {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    def of(k: int) -> set[bytes]:
        if k not in sets:
            sets[k] = set(shingles(every[k].text, words))
        return sets[k]

    bound, _ = signature_bounds(percent, sig.shape[1])
    for k, r in enumerate(first):
        equal = (sig[k + 1:] == sig[k]).mean(axis=1)
        for j in (np.flatnonzero(may_link(equal, n[k + 1:], n[k], percent, bound)) + k + 1).tolist():
            other = every[j]
            if find(r.component) != find(other.component) and similar(of(k), of(j), percent):
                root[find(r.component)] = find(other.component)
                yield r.node, other.node


# ---- linking ------------------------------------------------------------------------

class Linker:
    """Components of the nodes of ``table`` (sketches with a column ``row``), one node per
    class of equal sets: the row named in ``classes (node)``."""

    def __init__(self, table: DataFrame, classes: DataFrame, words: int, percent: int, rounds: int, block_bytes: int):
        self.words, self.percent, self.rounds, self.block_bytes = words, percent, rounds, block_bytes
        # a set that is linked with another has so many members that one more or less is allowed
        may = 100 * F.col("n") >= percent * (F.col("n") + 1)
        self.nodes = table.where(may).join(broadcast_if_small(classes.select("node")), F.col("row") == F.col("node"))
        self.components = table.sparkSession.createDataFrame([], "node long, component long")  # of linked nodes

    def run(self) -> DataFrame:
        pairs = materialize(self.bucket_pairs(), "minhash-pairs")
        met = pairs.select("node").unionByName(pairs.select(F.col("pivot").alias("node"))).distinct()
        # from here on only nodes that met another: their texts are moved more than once
        self.nodes = materialize(self.nodes.select("node", "n", "sig", "text").join(
            broadcast_if_small(materialize(met, "minhash-met")), "node", "left_semi"), "minhash-met-texts")
        kinds = self.judge(pairs)
        self.merge(kinds)
        groups = kinds.withColumnRenamed("pivot", "group").join(
            self.nodes.select("node", F.length("text").alias("bytes")).hint("merge"), "node")
        groups = materialize(groups, "minhash-groups")
        for k in range(self.rounds):
            rows, plan, light = self.open_groups(groups)
            if light:
                break
            self.merge(self.judge(materialize(self.further_pivots(rows, k), "minhash-pairs")))
        else:
            rows, plan, _ = self.open_groups(groups)
        self.merge_links(self.compare_in_full(rows, plan))
        return self.components

    def bucket_pairs(self) -> DataFrame:
        """Different ``(node, pivot)`` of all buckets; the pivot is the bucket's least node."""
        spread = self.nodes.select("node", F.explode("buckets").alias("bucket"))
        several = materialize(spread.groupBy("bucket").agg(F.min("node").alias("pivot"), F.count("*").alias("many"))
                              .where("many > 1"), "minhash-buckets")
        total = several.agg(F.sum("many")).first()[0] or 0
        members = join_hot(spread, several, ["bucket"], total, "node")
        return members.where("node <> pivot").select("node", "pivot").distinct()

    def judge(self, pairs: DataFrame) -> DataFrame:
        """``(node, pivot, kind)`` of each pair."""
        by_sig = materialize(judge_by_signature(self.with_both(pairs, "n", "sig"), self.percent), "minhash-judged")
        likely = by_sig.where(F.col("kind") == TO_VERIFY).select("node", "pivot")
        verified = materialize(verify(self.with_both(likely, "text"), self.words, self.percent), "minhash-verified")
        return by_sig.where(F.col("kind") != TO_VERIFY).unionByName(verified)

    def with_both(self, pairs: DataFrame, *columns: str) -> DataFrame:
        """``pairs`` with the columns of the node, and as ``pivot_...`` those of the pivot."""
        own = self.nodes.select("node", *columns)
        many = pairs.groupBy("pivot").agg(F.count("*").alias("many"))
        pivots = many.join(own.toDF("pivot", *(f"pivot_{c}" for c in columns)).hint("merge"), "pivot")
        return join_hot(pairs.join(own.hint("merge"), "node"), pivots, ["pivot"], pairs.count(), "node")

    def merge(self, kinds: DataFrame) -> None:
        self.merge_links(kinds.where(F.col("kind") == LINKED).select(F.col("node").alias("a"), F.col("pivot").alias("b")))

    def merge_links(self, links: DataFrame) -> None:
        self.components = star_components(links.unionByName(self.components.toDF("a", "b")))

    def open_groups(self, groups: DataFrame) -> tuple[DataFrame, DataFrame, bool]:
        """The rows of the groups with several components; how each is cut, ``(group, many, main,
        parts, near, more)``: its main component (the one with the most text) and into
        how many parts its other members go, the main one's that are linked to the pivot
        (``near``) and its rest (``more``); and whether that deals few rows twice."""
        rows = (groups.join(self.components, "node", "left")
                .withColumn("component", F.coalesce("component", "node")))
        rows = materialize(rows, "minhash-open")
        near = F.when(F.col("kind") == LINKED, F.col("bytes")).otherwise(0)
        each = rows.groupBy("group", "component").agg(
            F.sum("bytes").alias("bytes"), F.count("*").alias("n"), F.sum(near).alias("near"))
        plan = each.groupBy("group").agg(
            F.max(F.struct("bytes", "component", "n", "near")).alias("main"), F.sum("bytes").alias("bytes"),
            F.sum("n").alias("many"), F.count("*").alias("components")).where("components > 1")
        small = F.col("bytes") <= self.block_bytes  # one block

        def cut(total: Column) -> Column:
            return F.ceil(total / self.block_bytes).cast("long")

        near, whole = F.col("main.near"), F.col("main.bytes")
        plan = materialize(plan.select(
            "group", "many", F.col("main.component").alias("main"), F.col("main.n").alias("main_n"),
            F.when(small, 1).otherwise(F.greatest(cut(F.col("bytes") - whole), F.lit(1))).alias("parts"),
            F.when(small, 0).otherwise(cut(near)).alias("near"),
            F.when(small, 0).otherwise(cut(whole - near)).alias("more")), "minhash-plan")
        others = F.col("many") - F.col("main_n")
        dealt, n = plan.agg(F.sum(others * (F.col("parts") + F.col("near") + F.col("more")) + F.col("main_n") * F.col("parts")),
                            F.sum("many")).first()
        return rows, plan.drop("main_n"), not n or dealt <= FEW_TIMES * n

    def further_pivots(self, rows: DataFrame, k: int) -> DataFrame:
        """``(node, pivot)`` of another pivot in each open group, taken by hash, and the members that
        are not in its component."""
        order = F.struct(F.xxhash64("node", F.lit(k)).alias("h"), "node", "component")
        pivots = rows.groupBy("group").agg(
            F.min(order).alias("first"), F.min("component").alias("low"), F.max("component").alias("high"),
            F.count("*").alias("many")).where("low <> high")
        pivots = materialize(pivots.select("group", F.col("first.node").alias("pivot"),
                                           F.col("first.component").alias("of_pivot"), "many"), "minhash-pivots")
        return (join_hot(rows, pivots, ["group"], rows.count(), "node")
                .where("component <> of_pivot").select("node", "pivot").distinct())

    def compare_in_full(self, rows: DataFrame, plan: DataFrame) -> DataFrame:
        """Links ``(a, b)`` between members of a group that are in different components. Each two
        parts that are to be compared make a block ``(lo, hi)``: two parts of the others, or
        one of them and, numbered after them, one of the main component."""
        dealt = join_hot(rows, plan, ["group"], rows.count(), "node")
        is_main, is_near = F.col("component") == F.col("main"), F.col("kind") == LINKED
        alone = F.col("near") + F.col("more") == 0  # one block for the whole group
        upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(1), F.col(n).cast("int"))).otherwise(
            F.array().cast("array<int>"))
        part = F.pmod(F.xxhash64("node", F.lit(1)), F.when(~is_main, F.col("parts")).when(is_near, F.col("near"))
                      .otherwise(F.col("more"))).cast("int")
        after = F.col("parts").cast("int")  # the main component's parts: the near ones, then the rest

        def block(lo: Column, hi: Column) -> Column:
            return F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))

        with_others = F.transform(upto("parts"), lambda q: block(F.least("part", q - 1), F.greatest("part", q - 1)))
        with_near = F.transform(upto("near"), lambda q: block(F.col("part"), after + q - 1))
        with_more = F.transform(upto("more"), lambda q: block(F.col("part"), after + F.col("near").cast("int") + q - 1))
        own = after + F.col("part") + F.when(is_near, 0).otherwise(F.col("near").cast("int"))
        of_main = F.transform(upto("parts"), lambda p: block(p - 1, own))
        blocks = (F.when(alone, F.array(block(F.lit(0), F.lit(0)))).when(is_main, of_main)
                  .when(F.col("kind") == APART, F.concat(with_others, with_more))
                  .otherwise(F.concat(with_others, with_near, with_more)))
        blocks = (dealt.withColumn("part", F.when(~alone, part)).withColumn("block", F.explode(blocks))
                  .select("group", "block.lo", "block.hi", (~is_main).alias("first"), "node", "component"))
        words, percent = self.words, self.percent

        def inside(table: pa.Table) -> pa.Table:
            sides: tuple[list, list] = [], []
            for r in table.select(["first", "node", "component", "n", "sig", "text"]).to_pylist():
                sides[not r["first"]].append(Member(r["node"], r["component"], r["n"],
                                                    np.frombuffer(r["sig"], np.uint8), r["text"]))
            links = list(block_links(*sides, words, percent)) if sides[0] else []
            return pa.table({"a": pa.array([x for x, _ in links], pa.int64()),
                             "b": pa.array([x for _, x in links], pa.int64())})

        return (blocks.join(self.nodes.hint("merge"), "node")
                .groupBy("group", "lo", "hi").applyInArrow(inside, "a long, b long"))


def near_duplicates(docs: DataFrame, words: int = 2, percent: int = 80, bands: int = BANDS, rows: int = ROWS,
                    rounds: int = 4, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``doc_id`` and ``text`` -> one row per input row:
    ``(doc_id, n_shingles, component_id, kept)``.

    * Two documents are linked when 100 * intersection >= ``percent`` * union of their sets of
      ``words``-word shingles; ``component_id`` is the smallest ``doc_id`` reachable, ``kept``
      says that it is the row's own. Every link is verified on the full sets; a set's size
      and the classes of equal sets rest on 64- and 128-bit hashes of its shingles.
    * A null or blank text has the empty set and is linked with nothing, not even with its
      like: its component is its own id.
    * Rows are told apart, not ids: rows of one id may be in several components. Repeated
      rows are equal sets, so all of them come back in one component. A null id never names
      a component; a component without ids has a null id and all its rows are kept.
    * Other columns are ignored, whatever their names. Empty input: empty result.
    """
    table = materialize(sketches(docs, words, bands, rows)
                        .withColumn("row", F.monotonically_increasing_id()), "minhash-sketches")
    full = table.where("n > 0").select("doc_id", "n", "row", "k1", "k2")
    classes = materialize(full.groupBy("k1", "k2").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("least"), F.count("*").alias("many")), "minhash-classes")
    found = Linker(table, classes, words, percent, rounds, block_bytes).run()
    owned = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    owned = materialize(owned.withColumnRenamed("many", "copies"), "minhash-owned")
    names = owned.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("many"))
    owned = join_hot(owned, names, ["component"], owned.count(), "node").select(
        "k1", "k2", "component_id", F.col("copies").alias("many"))
    out = join_hot(full, owned, ["k1", "k2"], full.count(), "row").select("doc_id", "n", "component_id").unionByName(
        table.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
