"""Document fingerprints from closed syncmers.

A window of ``k`` code points is selected when the smallest hash among the ``s``-mers inside
it lies at its first or last place. Whether a window is selected depends on the window
alone (context-free), so an edit changes only anchors that overlap it, and copied text
keeps its anchors wherever it stands. The fingerprint holds the different hashes of all
anchors, and the likeness of two texts is that of their fingerprints. The anchors are kept
with their places too, packed: ``common_places`` gives where two texts meet, and
``copied_stretch`` the longest passage that they share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces

K, S = 16, 6

U64 = np.uint64


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def _grams(code: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` code points (polynomial, then mixed)."""
    h = np.zeros(len(code) - n + 1, U64)
    for i in range(n):
        h = h * U64(0x9E3779B97F4A7C15) + code[i:len(code) - n + 1 + i]
    return _mix(h + U64(n))


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def closed_syncmers(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Places (code points, ascending) and 64-bit hashes of the selected windows. A text of
    1 to ``k - 1`` code points is one window as a whole; an empty text has none."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(U64) + U64(1)
    if len(code) < k:
        return np.zeros(min(1, len(code)), np.int64), _grams(code, len(code)) if len(code) else code
    small = _grams(code, s)
    least = _window_min(small, k - s + 1)
    at = np.flatnonzero((small[:len(least)] == least) | (small[k - s:] == least))
    h = np.zeros(len(at), U64)
    for i in range(k):
        h = h * U64(0x9E3779B97F4A7C15) + code[at + i]
    return at, _mix(h + U64(k))


def anchors(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """``closed_syncmers`` of a text of any length, worked off in stretches."""
    parts, step = [], 1 << 20
    for start in range(0, max(1, len(text) - k + 1), step):  # windows start in one part each
        at, h = closed_syncmers(text[start:start + step + k - 1], k, s)
        parts.append((at + start, h))
    return np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts])


def sketch(h: np.ndarray, size: int | None = None) -> np.ndarray:
    """The different upper halves of the anchors' hashes, ascending: all, or the ``size`` smallest."""
    return np.unique(h >> U64(32))[:size].astype(np.uint32)


def fingerprint(text: str, k: int = K, s: int = S, size: int | None = None) -> np.ndarray:
    return sketch(anchors(text, k, s)[1], size)


_PACKED = np.dtype([("place", ">u4"), ("hash", ">u8")])


def pack(at: np.ndarray, h: np.ndarray) -> bytes:
    """Twelve bytes for each anchor, by place: place and hash, both big-endian."""
    out = np.empty(len(at), _PACKED)
    out["place"], out["hash"] = at, h
    return out.tobytes()


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(data, _PACKED)
    return rows["place"].astype(np.int64), rows["hash"].astype(U64)


def common_places(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Rows (place in a, place in b) of the common anchors, by place in a; an anchor that
    comes several times in a text counts at its first place."""
    ha, ia = np.unique(a[1], return_index=True)
    hb, ib = np.unique(b[1], return_index=True)
    _, x, y = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    both = np.stack([a[0][ia[x]], b[0][ib[y]]], axis=1)
    return both[np.argsort(both[:, 0], kind="stable")]


def copied_stretch(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], k: int = K) -> int:
    """Code points of the longest stretch that two texts have in common, by their anchors: common
    anchors that lie the same distance apart in both texts, each within a window of the
    one before. Texts without a common anchor: 0."""
    both = common_places(a, b)
    if not len(both):
        return 0
    shift = both[:, 1] - both[:, 0]
    order = np.lexsort((both[:, 0], shift))
    at, shift = both[order, 0], shift[order]
    starts = np.append(True, (np.diff(shift) != 0) | (np.diff(at) > k))
    first = np.flatnonzero(starts)
    last = np.append(first[1:], len(at)) - 1
    return int((at[last] - at[first]).max()) + k


def likeness(a: np.ndarray, b: np.ndarray, size: int | None = None) -> float:
    """Share of common anchors, 2 |A and B| / (|A| + |B|), of two sets of different hashes.
    ``size`` None: exact, of whole sets. Of sketches of ``size``: exact while both texts have
    at most ``size`` anchors, else estimated from the smallest of the union. Two texts
    without anchors are alike (1), one without and one with are not (0)."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if size is None:
        return 2 * len(np.intersect1d(a, b, assume_unique=True)) / (len(a) + len(b))
    union = np.union1d(a, b)
    if len(a) == size or len(b) == size:
        union = union[:size]
    both = np.intersect1d(np.intersect1d(a, b, assume_unique=True), union, assume_unique=True)
    j = len(both) / len(union)
    return 2 * j / (1 + j)


def _hex(x: np.ndarray) -> str:
    return x.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, k: int = K, s: int = S, size: int | None = None) -> DataFrame:
    """``docs`` (needs ``doc_id`` and ``text``) -> ``(doc_id, anchors, fingerprint)``: all anchors
    packed, and eight hexadecimal digits per different anchor (with ``size``: the smallest so
    many); null text: both empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            every = [anchors((t or b"").decode("utf-8", "replace"), k, s) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([pack(*x) for x in every], pa.binary()),
                 pa.array([_hex(sketch(h, size)) for _, h in every], pa.string())], ["doc_id", "anchors", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(
        run, "doc_id long, anchors binary, fingerprint string")


# ---- each document beside the next one ------------------------------------------

def with_next(docs: DataFrame, per_range: int = 10_000, max_ranges: int = 4096) -> DataFrame:
    """Rows ``(doc_id, text, th, range, last)`` such that, in the order of ``range, last, doc_id,
    th``, each row's next document is the row after it: the first id of each range comes
    again, as ``last``, at the end of the range before (that of the first range at the end
    of the last). The driver holds the bounds and first ids of at most ``max_ranges``
    ranges; texts are shuffled once, by range."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
    ids = rows.select("doc_id")
    ranges = max(16, min(max_ranges, -(-ids.count() // per_range)))
    cuts = ids.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 20 * ranges + 1000)).first()[0]
    cuts = F.array(*[F.lit(c).cast("long") for c in sorted(set(cuts or []))]).cast("array<long>")

    def place(doc_id: Column) -> Column:  # ids above so many bounds; null: below all
        return F.coalesce(F.size(F.filter(cuts, lambda c: c < doc_id)), F.lit(0))

    ids = ids.withColumn("range", place(F.col("doc_id")))
    # the null id, where there is one, is the first of all
    heads = sorted(((r["range"], None if r["nulls"] else r["low"]) for r in ids.groupBy("range").agg(
        F.min("doc_id").alias("low"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).collect()),
        key=lambda x: x[0])
    again = docs.sparkSession.createDataFrame(
        [(head, heads[k - 1][0]) for k, (_, head) in enumerate(heads)], "head long, before int")
    again = rows.join(F.broadcast(again), F.col("doc_id").eqNullSafe(F.col("head")))
    return rows.select("*", place(F.col("doc_id")).alias("range"), F.lit(False).alias("last")).unionByName(
        again.select("doc_id", "text", "th", F.col("before").alias("range"), F.lit(True).alias("last")))


EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, copied_edited long, copied_next long, "
          "anchors binary, edited_anchors binary")


def against_next(docs: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """``docs`` (needs ``doc_id`` and ``text``) -> one row per input row with its fingerprint, that
    of its edited text, the likeness of the first to the second and to the next document's,
    the code points of the longest stretch (``copied_...``) that it has in common with
    either, and the anchors of both its texts.

    The edited text has the last ``n_chars // 4`` code points replaced by the first as many
    (or all) of the next document: the next in ``(doc_id, text hash)`` order, null ids
    first; after the last comes the first. A document alone is its own next. Null texts
    count as empty. Other columns are ignored. Empty input: empty result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        out: list[tuple] = []
        for b in pieces(batches):
            for doc_id, data, where, last in zip(*(c.to_pylist() for c in b.columns), strict=True):
                text = (data or b"").decode("utf-8", "replace")
                at, h = anchors(text, k, s)
                row = (doc_id, text, where, last, at, h, sketch(h))
                if held is not None and not held[3] and held[2] == where:
                    out.append(beside(held, row))
                held = row
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []

    def beside(row: tuple, following: tuple) -> dict:
        doc_id, text, _, _, at, h, own = row
        n = len(text) // 4
        edited = text[:len(text) - n] + following[1][:n]
        new_at, new = anchors(edited, k, s)
        theirs = sketch(new)
        return {"doc_id": doc_id, "n_chars": len(text), "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(),
                "fingerprint": _hex(own), "edited_fingerprint": _hex(theirs),
                "near_edited": likeness(own, theirs), "near_next": likeness(own, following[6]),
                "copied_edited": copied_stretch((at, h), (new_at, new), k),
                "copied_next": copied_stretch((at, h), following[4:6], k),
                "anchors": pack(at, h), "edited_anchors": pack(new_at, new)}

    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in EDITED.split(", "))])
    rows = with_next(docs).repartitionByRange("range")
    return (rows.sortWithinPartitions("range", "last", "doc_id", "th")
            .select("doc_id", F.col("text").cast("binary"), "range", "last").mapInArrow(run, EDITED))
