"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs are quantised on a logarithmic scale; a count of level j puts
its key's levels 1 to j into a Bloom filter. A count is read back by probing level 1, 2, ...
until one is missing. The filter consists of segments by key, each sized by what falls
into it and built in one task from all partial counts of its keys.

    P(w)      = c(w) / (N + V) for known words, V / (N + V) for the unknown (Witten-Bell)
    P(w | u)  = l(u) c(uw) / c(u) + (1 - l(u)) P(w)

with l(u) = C / (C + T): of all histories with the level of u, C pairs and T different
pairs were seen. Counts come from the filter, N, V, C and T are exact sums.

The filter is broadcast; ``max_bytes`` bounds it, so from about one thousand million levels
a gigabyte on (8 bits a level) its error rate rises instead of its size. No n-gram is left
out. ``base_score`` needs exact counts: the ``HEAVY`` most frequent words are broadcast, all
others, of which none has much more than 1/``HEAVY`` of the tokens, are joined by a shuffle.
Words are identified by 64 bits of XXH64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, pieces

BASE, BITS, HASHES, SEGMENTS = 1.5, 8, 5, 1024
#: Words whose exact counts are broadcast (16 bytes each).
HEAVY = 400_000
#: Different keys a task collects before it hands on their partial counts.
FLUSH = 1 << 21

U64 = np.uint64
END, START = U64(xxhash.xxh64_intdigest(b" end")), U64(xxhash.xxh64_intdigest(b" start"))
_EDGE = np.unique(np.ceil(BASE ** np.arange(110)))  # smallest count of each level
_EDGE = _EDGE[_EDGE < 2 ** 62]
ESTIMATE = np.append(0.0, (_EDGE[:-1] + _EDGE[1:] - 1) / 2)


def levels_of(count: np.ndarray) -> np.ndarray:
    return np.searchsorted(_EDGE, count, side="right")


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def pair_key(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(before * U64(0x9E3779B97F4A7C15) + mix(word))


# ---- the filter -----------------------------------------------------------------

def _two_hashes(key: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix(key + U64(level * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF))
    return h & U64(0xFFFFFFFF), (h >> U64(32)) | U64(1)


def _place(a: np.ndarray, b: np.ndarray, i: int, bits: np.ndarray | np.uint64) -> np.ndarray:
    """The i-th bit of a key in a segment of ``bits`` (below 2^32) bits."""
    return ((a + U64(i) * b & U64(0xFFFFFFFF)) * bits) >> U64(32)


def build_segment(key: np.ndarray, count: np.ndarray, max_bytes: int) -> bytes:
    """Bits of one segment from its different keys and their counts."""
    level = levels_of(count)
    size = int(min(max_bytes, max(8, -(-int(level.sum()) * BITS // 8))))
    bits = np.zeros(size * 8, bool)
    for j in range(1, int(level.max(initial=0)) + 1):
        at = key[level >= j]
        a, b = _two_hashes(at, j)
        for i in range(HASHES):
            bits[_place(a, b, i, U64(size * 8))] = True
    return np.packbits(bits, bitorder="little").tobytes()


@dataclass
class Filter:
    data: np.ndarray
    first: np.ndarray  # first byte of each segment, and the end

    @staticmethod
    def of(rows: pa.Table) -> Filter:
        """From an Arrow table (segment, bits); a segment without keys is one zero word."""
        part = dict(zip(rows.column("segment").to_pylist(), rows.column("bits"), strict=True))
        parts = [part[s].as_buffer() if s in part else bytes(8) for s in range(SEGMENTS)]
        return Filter(np.frombuffer(b"".join(parts), np.uint8),
                      np.append(0, np.cumsum([len(p) for p in parts])).astype(U64))

    def levels(self, key: np.ndarray) -> np.ndarray:
        """Quantised count of each key: probes of level after level until one fails."""
        out, at = np.zeros(len(key), np.int64), np.arange(len(key))
        segment = key >> U64(54)
        first, bits = self.first[segment], (self.first[segment + U64(1)] - self.first[segment]) * U64(8)
        level = 0
        while len(at) and level + 2 < len(ESTIMATE):
            level += 1
            a, b = _two_hashes(key[at], level)
            for i in range(HASHES):
                place = _place(a, b, i, bits[at])
                hit = (self.data[first[at] + (place >> U64(3))] >> (place & U64(7)).astype(np.uint8) & 1).astype(bool)
                at, a, b = at[hit], a[hit], b[hit]
            out[at] += 1
        return out


class Partial:
    """Partial counts of keys in one task; ``tag`` is a small number per key."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, key: np.ndarray, tag: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        which, different = pd.factorize(key)
        count = np.bincount(which, minlength=len(different))
        first = np.zeros(len(different), np.uint8)
        if tag is not None:
            first[which] = tag
        self.parts.append((np.asarray(different, U64), count, first))
        self.size += len(different)
        if self.size >= FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        """One row per segment with all its keys, counts and tags."""
        if not self.parts:
            return
        key, count, tag = merge_counts(*(np.concatenate(x) for x in zip(*self.parts, strict=True)))
        self.parts, self.size = [], 0
        cut = np.searchsorted(key >> U64(54), np.arange(SEGMENTS + 1, dtype=U64))
        rows = [s for s in range(SEGMENTS) if cut[s] < cut[s + 1]]
        pack = lambda x, kind: pa.array([x[cut[s]:cut[s + 1]].astype(kind).tobytes() for s in rows], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pack(key, "<u8"), pack(count, "<u4"),
                                          pack(tag, "u1")], ["segment", "keys", "counts", "tags"])


def merge_counts(key: np.ndarray, count: np.ndarray, tag: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    key, count, tag = key[order], count[order], tag[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(key) else count, tag[first]


PARTIAL = "segment int, keys binary, counts binary, tags binary"


def segment_counts(table: pa.Table) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    join = lambda c, kind: np.frombuffer(b"".join(table.column(c).to_pylist()), kind)
    return (table.column("segment")[0].as_py(),
            *merge_counts(join("keys", "<u8"), join("counts", "<u4").astype(np.int64), join("tags", "u1")))


# ---- tokens ---------------------------------------------------------------------

def tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' tokens in turn, the end of each included, and their numbers."""
    h, end, flat = xxhash.xxh64_digest, END.astype(">u8").tobytes(), []
    count = np.empty(len(texts), np.int64)
    for i, t in enumerate(texts):
        words = t.lower().split() if t else []
        flat += map(h, words)
        flat.append(end)
        count[i] = len(words) + 1
    return np.frombuffer(b"".join(flat), ">u8").astype(U64), count


def histories(word: np.ndarray, count: np.ndarray) -> np.ndarray:
    before = np.empty(len(word), U64)
    before[1:] = word[:-1]
    before[np.cumsum(count) - count] = START
    return before


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 7 == 2, F.lit(False))


# ---- model and scores -----------------------------------------------------------

@dataclass
class Model:
    words: Filter
    pairs: Filter
    n_tokens: int
    n_words: int
    n_docs: int
    estimated: float  # sum of the words' counts as read from the filter
    weight: np.ndarray  # l(u) by level of u
    ratio: np.ndarray  # read / true pair counts by level of u
    heavy: np.ndarray
    heavy_count: np.ndarray

    def log10(self, word: np.ndarray, count: np.ndarray) -> np.ndarray:
        """log10 P of each text."""
        before = histories(word, count)
        which, different = pd.factorize(pair_key(before, word))
        first = np.empty(len(different), np.int64)
        first[which[::-1]] = np.arange(len(which))[::-1]
        w_at, w_key = pd.factorize(word)
        w_level = self.words.levels(mix(np.asarray(w_key, U64)))[w_at]
        h_level = np.empty(len(word), np.int64)
        h_level[1:] = w_level[:-1]
        h_level[before == START] = levels_of(np.array([self.n_docs]))[0]
        c, h = ESTIMATE[w_level[first]], h_level[first]
        known = self.estimated + self.n_words
        single = np.where(c > 0, c, max(1, self.n_words)) / max(1, known)
        pair = ESTIMATE[self.pairs.levels(np.asarray(different, U64))]
        share = np.minimum(1, pair / np.maximum(1, ESTIMATE[h] * self.ratio[h]))
        p = self.weight[h] * share + (1 - self.weight[h]) * single
        return np.bincount(np.repeat(np.arange(len(count)), count), weights=np.log10(p)[which], minlength=len(count))


def _partials(docs: DataFrame, words: Filter | None, n_docs: int) -> DataFrame:
    """Partial counts of words, or of word pairs tagged with their history's level."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partial, words = Partial(), shared.value
        for b in pieces(batches):
            word, count = tokens(b.column(0).to_pylist())
            if words is None:
                yield from partial.add(word)
                continue
            before = histories(word, count)
            at, key = pd.factorize(before)
            key = np.asarray(key, U64)
            level = words.levels(mix(key))
            level[key == START] = levels_of(np.array([n_docs]))[0]
            yield from partial.add(pair_key(before, word), level[at].astype(np.uint8))
        yield from partial.flush()

    return docs.select(F.col("text").cast("binary")).mapInArrow(run, PARTIAL)


def fit(docs: DataFrame, max_bytes: int = 128 << 20) -> tuple[Model, DataFrame]:
    """Model of all texts of ``docs``, and the table ``(h, c)`` of exact word counts."""
    quarter = max(64, max_bytes // 4 // SEGMENTS)

    def exact(table: pa.Table) -> pa.Table:
        _, key, count, _ = segment_counts(table)
        return pa.table({"h": key.view(np.int64), "c": count})

    counts = materialize(_partials(docs, None, 0).groupBy("segment").applyInArrow(exact, "h long, c long"), "lm-words")

    def build_words(table: pa.Table) -> pa.Table:
        key = mix(table.column("h").to_numpy().view(U64))
        count = table.column("c").to_numpy()
        segment = int(key[0] >> U64(54))
        return pa.table({"segment": pa.array([segment], pa.int32()),
                         "bits": pa.array([build_segment(key, count, quarter)], pa.binary())})

    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    end = counts.where(F.col("h") == int(END.view(np.int64))).select("c").first()
    by_level = counts.groupBy("c").agg(F.count("*").alias("n"))

    def estimate(batches):
        total = 0.0
        for b in batches:
            c, k = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            total += float((ESTIMATE[levels_of(c)] * k).sum())
        yield pa.RecordBatch.from_arrays([pa.array([total])], ["s"])

    estimated = by_level.mapInArrow(estimate, "s double").agg(F.sum("s")).first()[0] or 0.0

    def key_of(batches):
        for b in batches:
            key = mix(b.column(0).to_numpy(zero_copy_only=False).view(U64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array((key >> U64(54)).astype(np.int32))],
                                             ["h", "c", "segment"])

    words = Filter.of(counts.mapInArrow(key_of, "h long, c long, segment int").groupBy("segment").applyInArrow(
        build_words, "segment int, bits binary").toArrow())
    n_docs = end["c"] if end else 0
    # the words above the count that about HEAVY words exceed: no global sort, no top-k heap
    above = counts.agg(F.percentile_approx("c", max(0.0, 1 - HEAVY / max(1, v)), 10_000)).first()[0] if v > HEAVY else 0
    top = counts.where(F.col("c") > (above or 0)).toArrow().sort_by("h")

    def build_pairs(table: pa.Table) -> pa.Table:
        segment, key, count, tag = segment_counts(table)
        size = lambda x: np.bincount(tag, weights=x, minlength=128).tolist()
        return pa.table({"segment": pa.array([segment], pa.int32()),
                         "bits": pa.array([build_segment(key, count, 3 * quarter)], pa.binary()),
                         "seen": pa.array([size(count)]), "kinds": pa.array([size(np.ones(len(key)))]),
                         "read": pa.array([size(ESTIMATE[levels_of(count)])])})

    rows = _partials(docs, words, n_docs).groupBy("segment").applyInArrow(
        build_pairs, "segment int, bits binary, seen array<double>, kinds array<double>, read array<double>").toArrow()
    seen, kinds, read = (np.sum(rows.column(c).to_pylist() or [[0.0] * 128], axis=0) for c in ("seen", "kinds", "read"))
    return Model(words, Filter.of(rows), n, v, n_docs, estimated, seen / np.maximum(1, seen + kinds),
                 np.where(seen > 0, read / np.maximum(1, seen), 1.0), top.column("h").to_numpy(),
                 top.column("c").to_numpy()), counts


def score(docs: DataFrame, max_bytes: int = 128 << 20) -> DataFrame:
    """``docs`` (needs ``doc_id`` and ``text``) -> one row per input row: ``(doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score)``.

    * Learns from rows that are not held out; a null ``doc_id`` never is.
    * Tokens: ASCII-lower-cased words, then one end; a null or empty text is the end alone.
    * With nothing to learn from, every token is unknown and both scores are 0 or less.
    * Repeated rows count and come back as often as they came; other columns are ignored.
      Empty input: empty result.
    """
    model, counts = fit(docs.where(~held_out(F.col("doc_id"))), max_bytes)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    base = float(np.log10(model.n_tokens + model.n_words + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, row = shared.value, TaskContext.get().partitionId() << 33
        for b in pieces(batches):
            word, count = tokens(b.column(2).to_pylist())
            n, total = len(count), m.log10(word, count)
            owner = np.repeat(np.arange(n), count)
            signed = word.view(np.int64)
            at, key = pd.factorize(signed)
            key = np.asarray(key, np.int64)
            place = np.minimum(np.searchsorted(m.heavy, key), max(0, len(m.heavy) - 1))
            is_heavy = m.heavy[place] == key if len(m.heavy) else np.zeros(len(key), bool)
            c = np.where(is_heavy, m.heavy_count[place], 0) if len(m.heavy) else np.zeros(len(key), np.int64)
            heavy = is_heavy[at]
            known = np.bincount(owner[heavy], minlength=n)
            part = np.bincount(owner, weights=np.log10(c + 1.0)[at], minlength=n)
            light = signed[~heavy]
            n_light = np.append(0, np.cumsum(count - known)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.arange(row, row + n)), pa.array(count), pa.array(known),
                 pa.array(part), pa.array(total), pa.ListArray.from_arrays(pa.array(n_light), pa.array(light))],
                ["doc_id", "held_out", "row", "n_tokens", "known", "part", "score", "light"])
            row += n

    done = materialize(
        docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"),
                    F.col("text").cast("binary")).mapInArrow(
            run, "doc_id long, held_out boolean, row long, n_tokens long, known long, part double, score double, "
                 "light array<long>"), "lm-docs")
    rest = (done.select("row", F.explode("light").alias("h")).groupBy("row", "h").agg(F.count("*").alias("tf"))
            .join(counts, "h").groupBy("row").agg(F.sum("tf").alias("more"),
                                                  F.sum(F.col("tf") * F.log10(F.col("c") + 1)).alias("add")))
    zero = F.lit(0)
    return done.drop("light").join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", zero)).alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        (F.col("part") + F.coalesce("add", F.lit(0.0)) - F.col("n_tokens") * base).alias("base_score"), "score")
