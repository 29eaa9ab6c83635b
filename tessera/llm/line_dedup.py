"""Fuzzy line deduplication: SimHash, pigeonhole blocks, edit similarity, components.

A line is normalised (lower case, every run of characters that are no letters or digits
becomes one space) and gets a 64-bit SimHash of its different words. Two lines link when their
SimHashes differ in at most ``max_bits`` places and the edit similarity of the normalised
lines, 1 - distance / longer length, reaches ``similarity``. Of each connected group the
occurrence with the smallest (doc_id, text hash, line number) stays.

Equal normalised lines collapse before anything is compared, equal SimHashes too. Blocks
with equal bits yield a spanning forest, not pairs; only lines of the few candidate groups
carry their text to the edit check, and a large candidate group is checked in parts.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, connected_components, free_names, materialize, pieces, union_labels
from .simhash_near import link_within

#: Lines of one candidate group that one task compares with each other; values of one
#: block key beyond which the Gray-order index searches them instead of their pairs.
PART_LINES, CROWD = 2000, 1024

_OTHER = re.compile(r"[\W_]+")
_ASCII = {c: " " for c in range(128) if not chr(c).isalnum()}
#: Of each code point: 1 letter or digit, 0 other, 2 not looked up yet.
_KIND = np.full(0x110000, 2, np.uint8)


def normalise(line: str) -> str:
    if line.isascii():  # the same without a regular expression
        return " ".join(line.lower().translate(_ASCII).split())
    return _OTHER.sub(" ", line.lower()).strip()


def features(norm: str) -> list[str]:
    """The different words of a normalised line: one often repeated word must not decide
    all bits, or lines of common words would all be candidates of each other."""
    return list(set(norm.split(" ")))


def majority(hashes: np.ndarray, which: np.ndarray, size: np.ndarray) -> np.ndarray:
    """SimHash of each run of ``size`` words (at least one): the majority of the bits of
    ``hashes[which]``."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    lanes = np.ascontiguousarray(bits.view(np.uint64).T)  # one-byte counters; runs of at most 255 words cannot overflow
    runs = -(-size // 255)
    first = np.cumsum(runs) - runs
    start = np.cumsum(size) - size
    cut = np.repeat(start - 255 * first, runs) + 255 * np.arange(runs.sum())
    part = np.stack([np.add.reduceat(lane[which], cut) for lane in lanes], axis=1).view(np.uint8)
    total = np.add.reduceat(part, first, axis=0, dtype=np.int64)
    return np.packbits(2 * total > size[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def simhashes(lines: list[list[str]]) -> np.ndarray:
    """SimHash of each word list (at least one word each): majority of the words' XXH64 bits."""
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    place: dict[str, int] = {}
    which = [place.setdefault(w, len(place)) for words in lines for w in words]
    return majority(np.array([xxhash.xxh64_intdigest(w) for w in place], np.uint64), np.array(which), size)


def _in_words(code: np.ndarray) -> np.ndarray:
    kind = _KIND[code]
    if (kind == 2).any():
        new = np.unique(code[kind == 2])
        _KIND[new] = [chr(c).isalnum() for c in new.tolist()]
        kind = _KIND[code]
    return kind.view(bool)


def normal_lines(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """Of all lines with letters or digits: the text's place in ``texts``, the line's number
    (from 0), what ``normalise`` makes of the line (UTF-8) and the SimHash of its ``features``.

    One pass over the characters of all texts: each word, followed by one blank, is a value of
    an Arrow array, so that each different word is hashed once."""
    raw = b"\n".join(texts) + b"\n"
    if raw.isascii():
        code = np.frombuffer(raw.lower(), np.uint8)
    else:
        code = np.frombuffer(raw.decode("utf-8", "replace").lower().encode("utf-32-le"), np.uint32)
    word = _in_words(code)
    behind = np.flatnonzero(word[:-1] & ~word[1:]) + 1
    words = np.diff(np.searchsorted(behind, np.flatnonzero(code == 10), side="right"), prepend=0)
    line = np.flatnonzero(words)
    if not len(line):
        return line, line, [], np.empty(0, np.uint64)
    n_lines = np.array([t.count(b"\n") + 1 for t in texts])
    row = np.repeat(np.arange(len(texts)), n_lines)[line]
    pos = line - (np.cumsum(n_lines) - n_lines)[row]
    words = words[line]
    keep, code = word.copy(), code.copy()
    keep[behind], code[behind] = True, 32
    code = code[keep]
    data = code.tobytes() if code.itemsize == 1 else code.tobytes().decode("utf-32-le").encode()
    end = np.append(0, np.flatnonzero(np.frombuffer(data, np.uint8) == 32) + 1)
    found = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(end) - 1, [None, pa.py_buffer(end), pa.py_buffer(data)]).dictionary_encode()
    different = [w[:-1] for w in found.dictionary.to_numpy(zero_copy_only=False)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, different), np.uint64, len(different))
    has = np.repeat(np.arange(len(line)), words) * len(hashes) + found.indices.to_numpy()
    has.sort()
    has = has[np.append(True, has[1:] != has[:-1])]  # each word of a line once
    size = np.diff(np.searchsorted(has, np.arange(len(line) + 1) * len(hashes)))
    last = np.cumsum(words)
    norms = [data[i:j - 1] for i, j in zip(end[last - words].tolist(), end[last].tolist(), strict=True)]
    return row, pos, norms, majority(hashes, has % len(hashes), size)


def at_least(a: str, b: str) -> int:
    """A lower bound of the distance: characters that one string has more often."""
    more, fewer = Counter(a), Counter(b)
    return max((more - fewer).total(), (fewer - more).total())


def at_most(a: str, b: str) -> int:
    """An upper bound of the distance: words equal from both ends stay, then the words that
    both rests have once, in their longest common order, and so on between those; the cost is
    that of replacing what is left."""
    x, y = a.split(" "), b.split(" ")
    total, todo = 0, [(0, len(x), 0, len(y))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and x[i] == y[j]:
            i, j = i + 1, j + 1
        while i < m and j < n and x[m - 1] == y[n - 1]:
            m, n = m - 1, n - 1
        chain = _anchors(x[i:m], y[j:n]) if i < m and j < n else []
        if not chain:  # each word counts with one blank
            total += max(sum(map(len, x[i:m])) + m - i, sum(map(len, y[j:n])) + n - j)
            continue
        k, q = i, j
        for p, r in chain:
            todo.append((k, i + p, q, j + r))
            k, q = i + p + 1, j + r + 1
        todo.append((k, m, q, n))
    return total


def _anchors(x: list[str], y: list[str]) -> list[tuple[int, int]]:
    """Places of the words that both lists have once, in their longest common order."""
    once_x, once_y = Counter(x), Counter(y)
    place_y = {w: k for k, w in enumerate(y)}
    common = [(i, place_y[w]) for i, w in enumerate(x) if once_x[w] == 1 and once_y.get(w) == 1]
    tails: list[int] = []  # place in y of the last anchor of the best chain of each length
    last: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(common):
        at = bisect_left(tails, j)
        back.append(last[at - 1] if at else -1)
        if at == len(tails):
            tails.append(j)
            last.append(k)
        else:
            tails[at], last[at] = j, k
    chain, k = [], last[-1] if last else -1
    while k >= 0:
        chain.append(common[k])
        k = back[k]
    return chain[::-1]


def within_edits(a: str, b: str, limit: int) -> bool:
    """Whether the Levenshtein distance is at most ``limit``: by the two bounds where they
    decide it, else exactly (bit-parallel columns)."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > limit:
        return False
    if limit and at_most(a, b) <= limit:
        return True
    if at_least(a, b) > limit:
        return False
    k, n = 0, min(len(a), len(b))
    while k < n and a[k] == b[k]:
        k += 1
    a, b, n = a[k:], b[k:], n - k
    k = 0
    while k < n and a[-1 - k] == b[-1 - k]:
        k += 1
    if k:
        a, b = a[:-k], b[:-k]
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b) <= limit
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, score, left = full, 0, len(a), len(b)
    for c in b:
        eq = at.get(c, 0)
        level = (((eq & up) + up) ^ up) | eq
        plus, minus = down | full & ~(level | up), up & level
        score += bool(plus & last) - bool(minus & last)
        left -= 1
        if score - left > limit:
            return False
        plus, minus, eq = plus << 1 | 1, minus << 1, eq | down
        up, down = (minus | ~(eq | plus)) & full, plus & eq & full
    return score <= limit


def line_table(docs: DataFrame) -> DataFrame:
    """``docs (doc_id, text)`` -> one row per line with letters or digits:
    ``(doc_id, th, pos, key, sim, norm)``; ``th``: the text's hash, ``key``: 128-bit
    digest of the normalised line, ``sim``: its SimHash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, n_bytes=1 << 20):
            row, pos, norms, sims = normal_lines([t or b"" for t in b.column(2).to_pylist()])
            if not norms:
                continue
            at = pa.array(row)
            key = [hashlib.blake2b(x, digest_size=16).digest() for x in norms]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), b.column(1).take(at), pa.array(pos.astype(np.int32)), pa.array(key, pa.binary()),
                 pa.array(sims.view(np.int64)), pa.array(norms, pa.string())],
                ["doc_id", "th", "pos", "key", "sim", "norm"])

    return docs.select("doc_id", "th", F.col("text").cast("binary")).mapInArrow(
        run, "doc_id long, th long, pos int, key binary, sim long, norm string")


def block_links(values: DataFrame, max_bits: int, shared: int = 2) -> DataFrame:
    """``values (sim)``, different -> forest edges ``(src, dst)`` of the graph at
    ``max_bits`` or fewer differing bits.

    The 64 bits are cut into ``max_bits + shared`` blocks: two values that near agree on
    at least ``shared`` whole blocks (pigeonhole), so each choice of ``shared`` blocks is
    an equi-join key (``64 * shared / blocks`` bits; raise ``shared`` with the number of
    values). Values go to their keys' deals packed, nine bytes for each choice."""
    n = max_bits + shared
    edge = [64 * i // n for i in range(n + 1)]
    masks = np.array([sum(((1 << edge[i + 1]) - (1 << edge[i])) for i in chosen)
                      for chosen in combinations(range(n), shared)], np.uint64)

    def keys(batches):
        for b in pieces(batches, rows=1 << 16):
            sim = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            choice = np.repeat(np.arange(len(masks), dtype=np.uint8), len(sim))
            every = np.tile(sim, len(masks))
            h = ((every & masks[choice]) + choice) * np.uint64(0x9E3779B97F4A7C15)
            deal = (h ^ h >> np.uint64(32)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(54)
            order = np.argsort(deal, kind="stable")
            cut = np.searchsorted(deal[order], np.arange(1025, dtype=np.uint64))
            choice, every = choice[order], every[order]
            some = np.flatnonzero(cut[1:] > cut[:-1]).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), *[pa.array([x[cut[d]:cut[d + 1]].tobytes() for d in some], pa.binary())
                                               for x in (choice, every)]], ["deal", "choices", "sims"])

    def links(table: pa.Table) -> pa.Table:
        choice = np.frombuffer(b"".join(table.column("choices").to_pylist()), np.uint8)
        sim = np.frombuffer(b"".join(table.column("sims").to_pylist()), np.uint64)
        bits = sim & masks[choice]
        order = np.lexsort((bits, choice))
        choice, bits, sim = choice[order], bits[order], sim[order]
        new = np.ones(len(sim), bool)
        new[1:] = (choice[1:] != choice[:-1]) | (bits[1:] != bits[:-1])
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(sim)))
        group = np.cumsum(new) - 1
        src, dst = [sim[:0]], [sim[:0]]
        at, d = np.flatnonzero(size[group] <= CROWD), 1
        while len(at):  # pairs at distance d in the sorted run; who has none at d has none beyond
            at = at[at + d < len(sim)]
            at = at[group[at] == group[at + d]]
            near = at[np.bitwise_count(sim[at] ^ sim[at + d]) <= max_bits]
            src.append(sim[near])
            dst.append(sim[near + d])
            d += 1
        for s, m in zip(start[size > CROWD].tolist(), size[size > CROWD].tolist(), strict=True):
            x, y = link_within(sim[s:s + m], sim[:0], max_bits)
            src.append(x)
            dst.append(y)
        src, dst = np.concatenate(src), np.concatenate(dst)
        ids, at = np.unique(np.concatenate([src, dst]), return_inverse=True)
        parent = np.arange(len(ids))
        union_labels(parent, at[:len(src)], at[len(src):])
        child = np.flatnonzero(parent != np.arange(len(ids)))
        return pa.table({"src": ids[child].view(np.int64), "dst": ids[parent[child]].view(np.int64)})

    return (values.select("sim").mapInArrow(keys, "deal int, choices binary, sims binary")
            .groupBy("deal").applyInArrow(links, "src long, dst long"))


def edit_links(lines: DataFrame, max_bits: int, similarity: float, part_lines: int = PART_LINES) -> DataFrame:
    """``lines (comp, key, sim, norm)`` -> forest edges ``(src, dst)`` between keys of a
    candidate group that pass both checks. A group of more than ``part_lines`` is
    checked as pairs of parts of about that size, each pair a task of its own."""
    size = lines.groupBy("comp").count().select(
        "comp", F.ceil(F.col("count") / part_lines).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    dealt = (lines.join(size, "comp").withColumn("part", part)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("comp", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"),
                     "key", "sim", "norm"))

    def check(group: pa.Table) -> Iterator[tuple[bytes, bytes]]:
        if len(group) < 2:
            return
        key, norm = group.column("key").to_pylist(), group.column("norm").to_pylist()
        sim = group.column("sim").to_numpy().view(np.uint64)
        root, size = np.arange(len(key)), np.array([len(x) for x in norm])
        for i in range(len(key) - 1):
            near = np.flatnonzero((np.bitwise_count(sim[i + 1:] ^ sim[i]) <= max_bits) & (root[i + 1:] != root[i])
                                  & (abs(size[i + 1:] - size[i]) <= (1 - similarity) * np.maximum(size[i + 1:], size[i]) + 1e-9))
            for j in (near + i + 1).tolist():
                longer = max(len(norm[i]), len(norm[j]))
                if root[i] != root[j] and within_edits(norm[i], norm[j], _edits(longer, similarity)):
                    root[root == max(root[i], root[j])] = min(root[i], root[j])
        for c in np.flatnonzero(root != np.arange(len(key))).tolist():
            yield key[c], key[root[c]]

    def checked(rows: pa.Table, cut: list[int]) -> pa.RecordBatch:
        links = [e for s, t in zip(cut[:-1], cut[1:], strict=True) for e in check(rows.slice(s, t - s))]
        return pa.RecordBatch.from_arrays([pa.array([e[k] for e in links], pa.binary()) for k in (0, 1)], ["src", "dst"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last group of a batch may go on in the next one
        for b in batches:
            rows = pa.Table.from_batches([b])
            rows = rows if held is None else pa.concat_tables([held, rows])
            ids = [rows.column(c).to_numpy() for c in ("comp", "p", "q")]
            cut = [0, *(np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in ids])) + 1).tolist()]
            yield checked(rows, cut)
            held = rows.slice(cut[-1])
        if held is not None:
            yield checked(held, [0, len(held)])

    return (dealt.repartition("comp", "p", "q").sortWithinPartitions("comp", "p", "q")
            .mapInArrow(run, "src binary, dst binary"))


def _edits(longer: int, similarity: float) -> int:
    return int((1 - similarity) * longer + 1e-9)


def repeated_lines(docs: DataFrame, max_bits: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs (doc_id, th, text)`` -> ``(doc_id, th, dropped)`` for texts that lose lines:
    the sorted numbers (from 0) of lines whose group keeps an earlier occurrence."""
    lines = materialize(line_table(docs), "lines")
    place = F.struct("doc_id", "th", "pos")
    groups = materialize(lines.groupBy("key").agg(
        F.min(place).alias("first"), F.min("sim").alias("sim"), F.count("*").alias("n")), "line-groups")
    sims = materialize(groups.groupBy("sim").agg(F.count("*").alias("n_keys")), "line-sims")
    edges = materialize(block_links(sims, max_bits), "line-edges")
    comp = connected_components(edges, "line-cc").withColumnRenamed("id", "sim")
    several = sims.where("n_keys > 1").select("sim", F.col("sim").alias("component")).join(comp, "sim", "left_anti")
    wanted = materialize(comp.unionByName(several), "line-candidates")
    cand = groups.join(broadcast_if_small(wanted), "sim").select(F.col("component").alias("comp"), "key", "first")
    cand = materialize(cand, "line-candidate-keys")
    texts = lines.alias("l").join(broadcast_if_small(cand).alias("c"), "key").where(
        F.struct("l.doc_id", "l.th", "l.pos").eqNullSafe(F.col("c.first"))).select("comp", "key", "sim", "norm")
    verified = materialize(edit_links(materialize(texts.dropDuplicates(["key"]), "line-texts"), max_bits, similarity),
                           "line-verified")
    cls = connected_components(verified, "line-groups-cc").withColumnRenamed("id", "key")
    several = groups.select("key", "first", "n").join(broadcast_if_small(cls), "key", "left").where(
        "n > 1 or component is not null").select("key", F.coalesce("component", "key").alias("cls"), "first")
    several = materialize(several, "line-repeats")
    kept = several.groupBy("cls").agg(F.min("first").alias("kept"))
    owner = materialize(several.join(kept, "cls").select("key", "kept"), "line-owners")
    return (lines.select("doc_id", "th", "pos", "key").join(broadcast_if_small(owner), "key")
            .where(~place.eqNullSafe(F.col("kept")))
            .groupBy("doc_id", "th").agg(F.sort_array(F.collect_set("pos")).alias("dropped")))


def _without(text: Column, dropped: Column) -> Column:
    def cut(t: str | None, d) -> str | None:
        if t is None or d is None:
            return None
        gone = set(d.tolist())
        return "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone)

    def run(text: pd.Series, dropped: pd.Series) -> pd.Series:
        return pd.Series([cut(t, d) for t, d in zip(text, dropped, strict=True)], dtype=object)

    return F.pandas_udf(run, "string")(text, dropped)


def dedup_lines(docs: DataFrame, max_bits: int = 5, similarity: float = 0.8,
                dropped: str | None = None) -> DataFrame:
    """``docs`` (needs ``doc_id`` and ``text``) with the repeated lines cut from ``text``.

    * Every input row comes back once, with all its columns; a text whose lines all
      repeat becomes empty. ``dropped`` names a column for the cut line numbers (from 0), in
      place of a column of that name.
    * Blank lines and lines without letters or digits are never cut. Null texts stay null.
    * Rows with equal ``doc_id`` and text are one document: they keep the same lines. A
      null ``doc_id`` sorts first; ties among rows of one id go by the text's hash.
    * Other columns are carried along, whatever their names. Empty input: empty result.
    """
    own = F.xxhash64("text")
    gone = repeated_lines(docs.select(F.col("doc_id").cast("long"), own.alias("th"), "text"), max_bits, similarity)
    doc, th, cut_lines = free_names(docs, "__doc", "__th", "__dropped")
    gone = materialize(gone.toDF(doc, th, cut_lines), "line-dropped")
    # no hint: one text shuffle at every size, unless Spark finds the table tiny
    joined = docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone[doc])
                       & own.eqNullSafe(gone[th]), "left")
    gone_here = F.col(cut_lines)
    cut = F.when(gone_here.isNull(), F.col("text")).otherwise(
        _without(F.when(gone_here.isNotNull(), F.col("text")), gone_here))
    out = [cut.alias("text") if c == "text" else joined[c] for c in docs.columns if c != dropped]
    return joined.select(*out, *([F.coalesce(gone_here, F.array().cast("array<int>")).alias(dropped)]
                                 if dropped else []))
