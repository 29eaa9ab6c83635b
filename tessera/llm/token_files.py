"""Token ids as files in canonical, length-limited Huffman code.

Format: a code table (one row per id in use: its code length) and blocks. A block holds the
code strings of consecutive documents in ascending ``doc_id``; each document starts at a
whole byte and has a checkpoint, its bit offset, every ``EVERY`` ids. So blocks, documents
and stretches between checkpoints decode independently, all from one table that maps the
next ``limit`` bits to an id and a length. Both parts are Parquet datasets with binary
payloads, written and read by Spark alone.

Codes follow from the counts of all ids (package-merge keeps lengths within the limit;
codes are numbered canonically, so lengths suffice to rebuild them).
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

from .common import IdStore, first_places, pieces, run_keys

#: Ids between two checkpoints; payload bytes at which a block is closed.
EVERY, BLOCK_BYTES = 256, 1 << 20


# ---- ids ------------------------------------------------------------------------

#: ASCII marks that, after letters, are a piece of their own in the tokenizer's pattern.
MARKS = ".,;:!?#$%&*+-/=@^_|~()[]{}"


class WordEncoder:
    """Ids of whole texts by the tokenizers library. Its pattern never takes ASCII white
    space into a piece, so a text's ids are its words' ids in turn; different words are
    encoded once and remembered, at most ``memory`` of them at a time. Words of letters go
    to the library many at a time: each is one piece, and a piece's last token is known
    by the vocabulary's end-of-word suffix. Marks after them are a second piece."""

    def __init__(self, path: str, memory: int = 1_000_000):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        self.last = {i for t, i in self.tokenizer.get_vocab().items() if suffix and t.endswith(suffix)}
        self.store = IdStore(memory)

    def _single(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[str], many: int = 500) -> dict[str, list[int]]:
        groups, out = [words[k:k + many] for k in range(0, len(words), many)], {}
        for group, ids in zip(groups, self._single([" ".join(g) for g in groups]), strict=True):
            ends = [k + 1 for k, i in enumerate(ids) if i in self.last]
            if len(ends) == len(group) and ends[-1] == len(ids):
                out.update(zip(group, (ids[a:b] for a, b in zip([0, *ends], ends)), strict=True))
            else:  # a vocabulary without end-of-word tokens
                out.update(zip(group, self._single(group), strict=True))
        return out

    def _ids(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word."""
        split = []
        for w in words:
            text = w.decode("utf-8", "replace")
            core = text.rstrip(MARKS)
            # letters that stay letters in the tokenizer's normal form (a dotted capital I does not)
            plain = core if core.isascii() else unicodedata.normalize("NFC", core).lower()
            split.append((core, text[len(core):]) if core.isalpha() and plain.isalpha() else ("", text))
        letters = self._letters(sorted({c for c, _ in split if c}))
        rest = sorted({t for _, t in split if t})
        other = dict(zip(rest, self._single(rest), strict=True))
        return [letters.get(c, []) + other.get(t, []) for c, t in split]

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.start, self.ids = np.zeros(1, np.int64), np.empty(0, np.int32)

    def encode(self, texts: list[bytes], end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """All ids in turn, ``end`` after each text, and how many each text has."""
        joined = b" ".join(texts) + b" "
        byte = np.frombuffer(joined, np.uint8)
        word = (byte != 32) & ((byte < 9) | (byte > 13))
        at = np.flatnonzero(word & np.append(True, ~word[:-1]))
        extra = 0 if end is None else 1
        if not len(at):
            return np.full(extra * len(texts), end or 0, np.int32), np.full(len(texts), extra, np.int64)
        which, different = pd.factorize(run_keys(np.where(word, byte.astype(np.uint16) + 1, 0), at, np.diff(np.append(at, len(byte)))))
        first = at[first_places(which, len(different))]
        stop = np.flatnonzero(~word)
        stop = stop[np.searchsorted(stop, first)]
        offset, n, store = self.store.look_up(np.asarray(different, np.uint64), lambda new: self._ids(
            [joined[first[i]:stop[i]] for i in new.tolist()]))
        offset, n = offset[which], n[which]
        before = np.cumsum(n) - n
        owner = np.searchsorted(np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1), at, side="right")
        count = np.bincount(owner, weights=n, minlength=len(texts)).astype(np.int64)
        out = np.full(int(n.sum()) + extra * len(texts), end or 0, np.int32)
        out[np.arange(int(n.sum())) + extra * np.repeat(owner, n)] = store[
            np.repeat(offset - before, n) + np.arange(int(n.sum()))]
        return out, count + extra


@lru_cache(1)
def _encoder(path: str) -> WordEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(path)


def _cut(flat: np.ndarray, count: np.ndarray, kind: str = "<u4") -> pa.Array:
    """One binary value per document: its ids as little-endian integers."""
    data = flat.astype(kind)
    offsets = np.append(0, np.cumsum(count)) * data.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(count), [
        None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data.tobytes())]).cast(pa.binary())


def _flat(col: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    values = col.to_pylist()
    width = np.dtype(kind).itemsize
    return (np.frombuffer(b"".join(values), kind),
            np.fromiter((len(v) // width for v in values), np.int64, len(values)))


# ---- the code -------------------------------------------------------------------

def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits (package-merge)."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    order = np.argsort(counts, kind="stable")
    weight = counts[order].astype(np.int64)
    level, single = weight, [np.ones(n, bool)]
    for _ in range(limit - 1):
        even = len(level) // 2 * 2
        both = np.concatenate([weight, level[:even].reshape(-1, 2).sum(axis=1)])
        place = np.argsort(both, kind="stable")
        level = both[place]
        single.append(place < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_single in reversed(single):
        own = int(is_single[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """Canonical code of ``ids`` (ascending) with ``lengths``."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        self.ids, self.lengths = ids.astype(np.int64), lengths.astype(np.int64)
        self.limit = int(self.lengths.max(initial=1))
        order = np.lexsort((self.ids, self.lengths))
        step = np.int64(1) << (self.limit - self.lengths[order])
        left = np.cumsum(step) - step  # codes, left-aligned in ``limit`` bits
        self.code = np.empty(len(ids), np.int64)
        self.code[order] = left >> (self.limit - self.lengths[order])
        self.next_id = np.repeat(self.ids[order], step).astype(np.int32)
        self.next_length = np.repeat(self.lengths[order], step).astype(np.int64)
        if len(ids) == 1:
            self.next_id, self.next_length = self.next_id.repeat(2), self.next_length.repeat(2)
        self.place = np.zeros(int(self.ids.max(initial=0)) + 1, np.int64)  # of each id among the used
        self.place[self.ids] = np.arange(len(ids))

    def encode(self, flat: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of all documents, each one's number of bytes, and the bit offset in its
        document of each id."""
        at = self.place[flat]
        size = self.lengths[at]
        total = np.cumsum(size) - size
        first = np.cumsum(count) - count
        some = count > 0
        bits = np.zeros(len(count), np.int64)
        if len(flat):
            bits[some] = np.add.reduceat(size, first[some])
        n_bytes = -(-bits // 8)
        byte0 = np.cumsum(n_bytes) - n_bytes
        base = np.zeros(len(count), np.int64)
        base[some] = total[first[some]]
        inside = total - np.repeat(base, count)
        place = inside + np.repeat(8 * byte0, count)
        word = self.code[at] << (32 - (place & 7) - size)
        out = np.zeros(int(n_bytes.sum()) + 4)
        for k in range(4):
            part = np.bincount((place >> 3) + k, weights=(word >> (24 - 8 * k)) & 255, minlength=len(out))
            out += part[:len(out)]
        return out[:-4].astype(np.uint8), n_bytes, inside

    def decode(self, payload: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Ids of stretches that begin at the bit offsets ``start`` and have ``count`` ids
        each, all stretches side by side."""
        b = np.concatenate([payload, np.zeros(4, np.uint8)]).astype(np.uint32)
        window = b[:-3] << np.uint32(24) | b[1:-2] << np.uint32(16) | b[2:-1] << np.uint32(8) | b[3:]
        order = np.argsort(-count, kind="stable")
        place, to = start[order].astype(np.int64), (np.cumsum(count) - count)[order]
        left = np.searchsorted(-count[order], -np.arange(int(count.max(initial=0))), side="left")
        out = np.empty(int(count.sum()), np.int32)
        shift = np.uint32(32 - self.limit)
        for t, live in enumerate(left.tolist()):  # the first ``live`` stretches have more than t ids
            p = place[:live]
            look = (window[p >> 3] << (p & 7).astype(np.uint32)) >> shift
            out[to[:live] + t] = self.next_id[look]
            p += self.next_length[look]
        return out


# ---- files ----------------------------------------------------------------------

def encode_ids(docs: DataFrame, path: str, end: int | None = 1) -> tuple[DataFrame, DataFrame, str]:
    """``docs (doc_id, text)`` -> a written table ``(doc_id, th, ids)``, the counts ``(id, n)``
    over all rows, and the integer kind of ``ids``: two bytes where the vocabulary allows
    it. Each task writes the counts of its ids as one more row of the same table."""
    from tokenizers import Tokenizer
    kind = "<u2" if max(Tokenizer.from_file(path).get_vocab_size(), end or 0) <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, total = _encoder(path), np.zeros(1, np.int64)
        for b in pieces(batches, n_bytes=2 << 20):
            flat, count = encoder.encode([t or b"" for t in b.column(2).to_pylist()], end)
            part = np.bincount(flat, minlength=len(total))
            part[:len(total)] += total
            total = part
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), _cut(flat, count, kind), pa.array([False] * b.num_rows)],
                ["doc_id", "th", "ids", "counts"])
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array(
                [np.concatenate([used, total[used]]).astype("<i8").tobytes()], pa.binary()), pa.array([True])],
            ["doc_id", "th", "ids", "counts"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column(0).to_pylist():
                used, n = np.frombuffer(x, "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n)], ["id", "n"])

    ids = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), F.col("text").cast("binary")
                      ).mapInArrow(run, "doc_id long, th long, ids binary, counts boolean")
    out = scratch_path(docs.sparkSession, "token-ids")
    ids.write.option("compression", "zstd").parquet(out)
    table = docs.sparkSession.read.schema(ids.schema).parquet(out)
    counts = table.where("counts").select("ids").mapInArrow(spread, "id long, n long")
    return table.where("not counts").drop("counts"), counts.groupBy("id").agg(F.sum("n").alias("n")), kind


BLOCK = ("part int, start long, doc_ids array<long>, n_ids array<long>, n_bytes array<long>, "
         "checkpoints binary, payload binary")


def write_files(ids: DataFrame, counts: DataFrame, kind: str, path: str, parts: int | None = None) -> None:
    """Write the table of ``encode_ids`` as files below ``path``, in ascending ``doc_id``
    (null first; rows of one id by text hash). The driver sees the counts, one row per id
    of the vocabulary, and makes the code. Ids are dealt out by range first, so the pass
    that samples the ranges' bounds only reads them; each row is coded once, in place."""
    spark = ids.sparkSession
    seen = sorted((r["id"], r["n"]) for r in counts.collect())
    used, n = (np.array([r[k] for r in seen], np.int64) for k in (0, 1))
    lengths = code_lengths(n, max(16, len(used).bit_length() + 2))
    spark.createDataFrame(list(zip(used.tolist(), lengths.tolist(), strict=True)), "id long, length long").coalesce(
        1).write.parquet(f"{path}/code")
    code = Code(used, lengths)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """``(doc_id, th, n, checkpoints, payload)`` of each row."""
        for b in pieces(batches, n_bytes=1 << 20):
            flat, count = _flat(b.column(2), kind)
            payload, n_bytes, inside = code.encode(flat, count)
            number = np.arange(len(flat)) - np.repeat(np.cumsum(count) - count, count)
            marks = number % EVERY == 0
            n_marks = -(-count // EVERY)
            marks, payload = (_cut(inside[marks], n_marks).to_pylist(), _cut(payload, n_bytes, "u1").to_pylist())
            yield from zip(b.column(0).to_pylist(), b.column(1).to_pylist(), count.tolist(), marks, payload, strict=True)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start, rows, size = TaskContext.get().partitionId(), 0, [], 0

        def block() -> pa.RecordBatch:
            one = [[part], [start], [[r[0] for r in rows]], [[r[2] for r in rows]], [[len(r[4]) for r in rows]],
                   [b"".join(r[3] for r in rows)], [b"".join(r[4] for r in rows)]]
            kinds = [pa.int32(), pa.int64(), *[pa.list_(pa.int64())] * 3, pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(one, kinds, strict=True)],
                                              ["part", "start", "doc_ids", "n_ids", "n_bytes", "checkpoints", "payload"])

        for row in encode(batches):
            rows.append(row)
            size += len(row[4])
            if size >= BLOCK_BYTES:
                yield block()
                start, rows, size = start + sum(r[2] for r in rows), [], 0
        if rows:
            yield block()

    dealt = ids.repartitionByRange(parts, "doc_id") if parts else ids.repartitionByRange("doc_id")
    dealt.sortWithinPartitions("doc_id", "th").mapInArrow(pack, BLOCK).write.option(
        "compression", "none").parquet(f"{path}/blocks")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of ``write_files`` -> ``(doc_id, start, n_tokens, ids)``; ``start``: ids of all
    documents before; ``ids``: little-endian unsigned 32-bit integers."""
    table = spark.read.parquet(f"{path}/code").orderBy("id").collect()
    code = Code(np.array([r["id"] for r in table], np.int64), np.array([r["length"] for r in table], np.int64))
    blocks = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    sizes = blocks.groupBy("part").agg(F.sum(F.aggregate("n_ids", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before, base = 0, {}
    for r in sizes.orderBy("part").collect():
        base[r["part"]], before = before, before + r["n"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, rows=1):
            r = {k: v[0] for k, v in b.to_pydict().items()}
            n, n_bytes = np.array(r["n_ids"], np.int64), np.array(r["n_bytes"], np.int64)
            n_marks = -(-n // EVERY)
            marks = np.frombuffer(r["checkpoints"], "<u4").astype(np.int64)
            place = marks + np.repeat(8 * (np.cumsum(n_bytes) - n_bytes), n_marks)
            number = np.arange(len(marks)) - np.repeat(np.cumsum(n_marks) - n_marks, n_marks)
            count = np.minimum(EVERY, np.repeat(n, n_marks) - EVERY * number)
            flat = code.decode(np.frombuffer(r["payload"], np.uint8), place, count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(r["doc_ids"], pa.int64()), pa.array(base[r["part"]] + r["start"] + np.cumsum(n) - n),
                 pa.array(n), _cut(flat, n)], ["doc_id", "start", "n_tokens", "ids"])

    return blocks.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def with_crc32(ids: DataFrame) -> DataFrame:
    """``read_files`` rows with the CRC-32 of the id bytes in place of the ids."""
    return ids.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def round_trip(docs: DataFrame, path: str, end: int | None = 1) -> DataFrame:
    """``docs`` (needs ``doc_id`` and ``text``) encoded, written and read back: one row per
    input row, ``(doc_id, start, n_tokens, ids_crc32)``.

    A null text is encoded as an empty one (only the end id). Null ids come first, rows of
    one id in the order of their text's hash; repeated rows come back as often as they
    came. Other columns are ignored. Empty input: empty result."""
    ids, counts, kind = encode_ids(docs, path, end)
    out = scratch_path(docs.sparkSession, "token-files")
    write_files(ids, counts, kind, out)
    return with_crc32(read_files(docs.sparkSession, out))
