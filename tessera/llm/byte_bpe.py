"""Byte-level BPE by monoid tree reduction.

Token sequences of neighbouring byte strings form a monoid: ``join(encode(a), encode(b)) ==
encode(a + b)``. A pattern match is encoded as a tree: halves recursively, down to short
leaves, then joined upwards. A join re-encodes a window of tokens around the boundary and
accepts it once both window edges are stable, else the window grows.

Why an edge is stable: two neighbouring tokens are *settled* if encoding just their bytes
gives these two tokens again. Suppose every neighbouring pair of a sequence is settled and
some merge crosses a token boundary while the whole is encoded; take the first. Until
then merges happened inside tokens only, and those inside the two tokens there in the
order in which encoding the two alone does them (lowest rank, then leftmost). So encoding
the two alone would make the crossing merge as well, and the pair would not be settled.
Hence a sequence whose neighbours are all settled is the encoding. Inside both halves
and inside the window neighbours are settled already; a join has to test the two edges.

Matches of one batch are split with array operations, equal ones are encoded once, and all
leaves of a batch merge side by side. Decoding concatenates the tokens' bytes up a tree.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IdStore, first_places, pieces

#: Bytes of a leaf; tokens of a join's first window on each side.
LEAF, WINDOW = 16, 2
#: Code points that are split at a time.
CHUNK = 1 << 20
NONE = np.int64(1 << 40)

#: Fixed: the pattern whose matches ``match_starts`` finds.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Fixed: code points with Unicode's White_Space property.
SPACES = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
LETTER, NUMBER, OTHER, SPACE, END = range(5)


@lru_cache(1)
def _kinds() -> np.ndarray:
    kind = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        c = unicodedata.category(chr(code))[0]
        if c == "L":
            kind[code] = LETTER
        elif c == "N":
            kind[code] = NUMBER
    kind[SPACES] = SPACE
    return kind


def match_starts(code: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where matches of ``PATTERN`` start, as a mask. ``kind`` is END at one place after each
    text, which is a match of its own."""
    start = np.ones(len(code), bool)
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == END)
    # The last of a run of white space before other text: a blank goes with that text.
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] < SPACE))
    start[last] = True
    start[last[code[last] == 32] + 1] = False
    # A lone apostrophe that starts a match takes one of the endings.
    padded = np.concatenate([code, np.zeros(3, code.dtype)])
    quote = np.flatnonzero((code == 39) & start)
    one, two = padded[quote + 1], padded[quote + 2]
    taken = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, np.where(
        (np.isin(one, [ord("r"), ord("v")]) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))), 2, 0))
    quote, taken = quote[taken > 0], taken[taken > 0]
    start[quote + 1] = False
    after = quote + 1 + taken
    start[after[kind[np.minimum(after, len(kind) - 1)] == LETTER]] = True
    return start


class TreeBPE:
    """Encoder and decoder for one rank table (token bytes -> id, ids as merge ranks)."""

    def __init__(self, ranks: dict[bytes, int], memory: int = 200_000):
        self.ranks, self.bytes_of = ranks, bytes_table(ranks)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.merges = merges = {ranks[t[:k]] << 32 | ranks[t[k:]]: r for t, r in ranks.items() if len(t) > 1
                  for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}
        self.pair = np.array(sorted(merges), np.int64)
        self.merged = np.array([merges[p] for p in self.pair.tolist()], np.int64)
        self.settled = lru_cache(1 << 16)(self._settled)
        self.leaf = lru_cache(1 << 14)(self._leaf)
        self.store = IdStore(memory)

    # ---- leaves

    def _leaf(self, data: bytes) -> list[int]:
        """Tokens of one byte string, by the same merges from a heap of (rank, place)."""
        find, tok = self.merges.get, self.single[np.frombuffer(data, np.uint8)].tolist()
        n = len(tok)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := find(tok[i] << 32 | tok[i + 1])) is not None]
        heapify(heap)
        while heap:
            r, i = heappop(heap)
            j = after[i]
            if tok[i] < 0 or j >= n or find(tok[i] << 32 | tok[j]) != r:
                continue
            tok[i], tok[j], k = r, -1, after[j]
            after[i] = k
            if k < n:
                before[k] = i
                if (r := find(tok[i] << 32 | tok[k])) is not None:
                    heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := find(tok[h] << 32 | tok[i])) is not None:
                heappush(heap, (r, h))
        return [t for t in tok if t >= 0]

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.merged[at], NONE)

    def leaves(self, data: list[bytes]) -> list[list[int]]:
        """Tokens of each byte string: merge the neighbours of lowest rank, leftmost
        first, until none is left; one merge in every string at a time."""
        out: list[list[int]] = [[] for _ in data]
        size = np.fromiter(map(len, data), np.int64, len(data))
        order = np.argsort(size, kind="stable")
        for rows in np.array_split(order, max(1, len(order) // 8192)):
            rows = rows[size[rows] > 0]
            if not len(rows):
                continue
            n, wide = size[rows], int(size[rows].max())
            flat = np.frombuffer(b"".join(data[i].ljust(wide, b"\0") for i in rows.tolist()), np.uint8)
            tok = self.single[flat].reshape(len(rows), wide)
            rank = self._rank(tok[:, :-1], tok[:, 1:])
            rank[np.arange(wide - 1) >= n[:, None] - 1] = NONE
            live = np.arange(len(rows))
            column = np.arange(wide)
            while wide > 1 and len(live):
                r = rank[live]
                j = r.argmin(axis=1)
                best = r[np.arange(len(live)), j]
                go = best < NONE
                live, j, best, r = live[go], j[go], best[go], r[go]
                if not len(live):
                    break
                t = tok[live]
                shift = np.minimum(column + (column > j[:, None]), wide - 1)
                t = np.take_along_axis(t, shift, axis=1)
                t[np.arange(len(live)), j] = best
                r = np.concatenate([r, np.full((len(live), 1), NONE)], axis=1)
                r = np.take_along_axis(r, shift, axis=1)[:, :-1]
                n[live] -= 1
                here = np.flatnonzero(j < n[live] - 1)
                r[np.flatnonzero(j >= n[live] - 1), np.minimum(j, wide - 2)[j >= n[live] - 1]] = NONE
                r[here, j[here]] = self._rank(t[here, j[here]], t[here, j[here] + 1])
                here = np.flatnonzero(j > 0)
                r[here, j[here] - 1] = self._rank(t[here, j[here] - 1], t[here, j[here]])
                tok[live], rank[live] = t, r
            for i, row, k in zip(rows.tolist(), tok.tolist(), n.tolist(), strict=True):
                out[i] = row[:k]
        return out

    # ---- the tree

    def _settled(self, a: int, b: int) -> bool:
        return self.leaf(self.bytes_of[a] + self.bytes_of[b]) == [a, b]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right:
            return left or right
        if self.settled(left[-1], right[0]):
            return left + right
        width = WINDOW
        while True:
            a, b = left[:-width], right[width:]
            data = b"".join(map(self.bytes_of.__getitem__, left[-width:] + right[:width]))
            mid = self.leaf(data) if len(data) <= 4 * LEAF else self._leaf(data)
            if (not a or self.settled(a[-1], mid[0])) and (not b or self.settled(mid[-1], b[0])):
                return a + mid + b
            width *= 2

    def trees(self, data: list[bytes]) -> list[list[int]]:
        """Tokens of each byte string: halves down to leaves, then joins level by level."""
        level = [[d] for d in data]
        heights = []
        for d in level:
            height = 0
            while max(map(len, d)) > LEAF:
                d[:] = [h for x in d for h in (x[:len(x) // 2], x[len(x) // 2:])]
                height += 1
            heights.append(height)
        tokens = iter(self.leaves([x for d in level for x in d]))
        out = []
        for d, height in zip(level, heights, strict=True):
            row = [next(tokens) for _ in d]
            for _ in range(height):
                row = [self.join(row[k], row[k + 1]) for k in range(0, len(row), 2)]
            out.append(row[0])
        return out

    def matches(self, words: list[str]) -> list[list[int]]:
        """Ids of pattern matches: a token of its own if the table has it whole."""
        data = [w.encode("utf-8", "surrogatepass") for w in words]
        out = [[r] if (r := self.ranks.get(d)) is not None else None for d in data]
        todo = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(todo, self.trees([data[i] for i in todo]), strict=True):
            out[i] = ids
        return out

    # ---- texts

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0].tolist()

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in turn, and how many each text has."""
        ids, counts, chunk, size = [], np.zeros(len(texts), np.int64), [], 0
        parts = [(i, p) for i, t in enumerate(texts) for p in cut(t, CHUNK)]
        for k, (i, part) in enumerate(parts):
            chunk.append((i, part))
            size += len(part)
            if size >= CHUNK or k + 1 == len(parts):
                got, n = self._encode([p for _, p in chunk])
                ids.append(got)
                np.add.at(counts, [i for i, _ in chunk], n)
                chunk, size = [], 0
        return (np.concatenate(ids) if ids else np.empty(0, np.int32)), counts

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = "\0".join(texts) + "\0"
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        kind = _kinds()[code]
        ends = np.cumsum(size + 1) - 1
        kind[ends] = END
        at = np.flatnonzero(match_starts(code, kind))
        length = np.diff(np.append(at, len(code)))
        place = (np.arange(len(code)) - np.repeat(at, length)).astype(np.uint64)
        mixed = (code + (place << np.uint64(24)) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        key = np.add.reduceat(mixed, at)
        end = kind[at] == END
        text = np.cumsum(end) - end
        at, length, key, text = at[~end], length[~end], key[~end], text[~end]
        which, different = pd.factorize(key)
        first = first_places(which, len(different))
        begin, stop = at[first], at[first] + length[first]
        offset, n, store = self.store.look_up(different, lambda new: self.matches(
            [joined[begin[i]:stop[i]] for i in new.tolist()]))
        offset, n = offset[which], n[which]
        before = np.cumsum(n) - n
        ids = store[np.repeat(offset - before, n) + np.arange(n.sum())]
        return ids, np.bincount(text, weights=n, minlength=len(texts)).astype(np.int64)

    def decode(self, ids: list[int]) -> bytes:
        return decode(self.bytes_of, ids)


def bytes_table(ranks: dict[bytes, int]) -> list[bytes]:
    """Bytes of each token id."""
    out = [b""] * (1 + max(ranks.values(), default=-1))
    for token, rank in ranks.items():
        out[rank] = token
    return out


def decode(bytes_of: list[bytes], ids: list[int]) -> bytes:
    """The tokens' bytes, concatenated up a tree."""
    level = list(map(bytes_of.__getitem__, ids))
    while len(level) > 1:
        level = [b"".join(level[k:k + 256]) for k in range(0, len(level), 256)]
    return level[0] if level else b""


def cut(text: str, size: int) -> Iterator[str]:
    """Parts of about ``size`` code points whose matches are those of the text: a lone
    blank between other characters always starts a match."""
    while len(text) > size:
        found = regex.search(r"\S(?= [^\s\p{N}\p{P}\p{S}])", text, pos=size)
        if not found:
            break
        yield text[:found.end()]
        text = text[found.end():]
    yield text


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one ``base64-token rank`` per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@lru_cache(1)
def _coder(path: str) -> TreeBPE:
    """One per worker process, kept across batches."""
    return TreeBPE(load_ranks(path))


@lru_cache(1)
def _bytes_of(path: str) -> list[bytes]:
    """All that decoding needs, one per worker process."""
    return bytes_table(load_ranks(path))


def _digests(rows: list[np.ndarray], out: list[bytes]) -> list[pa.Array]:
    """``n_tokens``, and the SHA-256 of the ids and of the decoded bytes of each row."""
    return [pa.array([len(x) for x in rows], pa.int64()),
            pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in rows], pa.string()),
            pa.array([hashlib.sha256(x).hexdigest() for x in out], pa.string())]


def _fields(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(names).schema)


def encode_texts(docs: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and ``ids`` (array of int) of each row's ``text`` (null: empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path)
        for b in pieces(batches, n_bytes=1 << 20):
            texts = [(t or b"").decode("utf-8", "replace") for t in b.column(len(keep)).to_pylist()]
            ids, n = coder.encode_batch(texts)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], lists], [*keep, "ids"])

    return docs.select(*keep, F.col("text").cast("binary").alias("__text")).mapInArrow(
        run, f"{_fields(docs, keep)}, ids array<int>")


def decode_ids(tokens: DataFrame, path: str, keep: list[str], digests: bool = False) -> DataFrame:
    """Columns ``keep`` and the decoded ``bytes`` (binary) of each row's ``ids`` (null:
    empty); with ``digests`` instead ``n_tokens`` and the SHA-256 of the ids, as
    little-endian unsigned 32-bit integers, and of the decoded bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = _bytes_of(path)
        for b in pieces(batches, n_bytes=1 << 20):
            col = b.column(len(keep))
            rows = [col[i].values.to_numpy(zero_copy_only=False) if col[i].is_valid else np.empty(0, np.int32)
                    for i in range(b.num_rows)]
            out = [decode(bytes_of, x.tolist()) for x in rows]
            cols = _digests(rows, out) if digests else [pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *cols], [*keep, *names])

    names = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["bytes"]
    kinds = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "bytes binary"
    return tokens.select(*keep, "ids").mapInArrow(run, f"{_fields(tokens, keep)}, {kinds}")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` (needs ``doc_id`` and ``text``) -> one row per input row:
    ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: encoded, then decoded.

    A null text is encoded as an empty one (no ids). Repeated rows and null ids come back
    as they came; other columns are ignored. Empty input: empty result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path)
        for b in pieces(batches, n_bytes=1 << 20):
            ids, n = coder.encode_batch([(t or b"").decode("utf-8", "replace") for t in b.column(1).to_pylist()])
            rows = np.split(ids, np.cumsum(n)[:-1])
            out = [coder.decode(x.tolist()) for x in rows]
            yield pa.RecordBatch.from_arrays([b.column(0), *_digests(rows, out)],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))  # one Python step: one coder per task
    return rows.mapInArrow(run, f"{_fields(docs, ['doc_id'])}, n_tokens long, ids_sha256 string, decoded_sha256 string")
