"""Fill-in-the-middle transformation over a compressed set of token boundaries.

1. A text is cut into units: a word with the white space before it, or the white space
   at the end. The offsets (code points) at which units end form its boundary set.
2. The set is kept in containers of 2**16 values: a sorted array, a bitmap or runs,
   whichever takes the fewest bytes, with the cumulative cardinalities of the containers.
3. The two cuts are the boundaries of two ranks drawn from the document's hash: a search
   in the cumulative cardinalities finds the container, a local select the value.
4. Hashes, forms, outputs and the way back are column expressions; only the text and the
   two drawn numbers go to Python and only three numbers per row come back.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sentinels of prefix, suffix and middle, and the share in percent of texts that are
#: rearranged, and of those in suffix-first order.
SENTINELS = ("<P>", "<S>", "<M>")
RATE, SPM_RATE = 50, 80

BITMAP_BYTES = 8192
CHUNK = 4 << 20


# ---- containers -----------------------------------------------------------------

@dataclass
class ArrayContainer:
    low: np.ndarray  # sorted uint16

    def select(self, rank: int) -> int:
        return int(self.low[rank])

    def values(self) -> np.ndarray:
        return self.low.astype(np.int64)


@dataclass
class BitmapContainer:
    words: np.ndarray  # 1,024 words of 64 bits
    until: np.ndarray  # members up to and with each word

    @staticmethod
    def of(low: np.ndarray) -> BitmapContainer:
        bits = np.zeros(1 << 16, bool)
        bits[low] = True
        words = np.packbits(bits, bitorder="little").view("<u8")
        return BitmapContainer(words, np.cumsum(np.bitwise_count(words), dtype=np.int64))

    def select(self, rank: int) -> int:
        word = int(np.searchsorted(self.until, rank, side="right"))
        rest = rank - (int(self.until[word - 1]) if word else 0)
        bits = np.unpackbits(self.words[word:word + 1].view(np.uint8), bitorder="little")
        return 64 * word + int(np.flatnonzero(bits)[rest])

    def values(self) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little"))


@dataclass
class RunContainer:
    start: np.ndarray
    until: np.ndarray  # members up to and with each run

    def select(self, rank: int) -> int:
        run = int(np.searchsorted(self.until, rank, side="right"))
        return int(self.start[run]) + rank - (int(self.until[run - 1]) if run else 0)

    def values(self) -> np.ndarray:
        size = np.diff(self.until, prepend=0)
        return np.repeat(self.start - self.until + size, size) + np.arange(size.sum())


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest form of some different sorted values below 2**16."""
    breaks = np.flatnonzero(np.diff(low.astype(np.int64)) != 1) + 1
    if 4 * (len(breaks) + 1) < min(2 * len(low), BITMAP_BYTES):
        first = np.append(0, breaks)
        return RunContainer(low[first].astype(np.int64), np.append(breaks, len(low)))
    return ArrayContainer(low.astype(np.uint16)) if 2 * len(low) <= BITMAP_BYTES else BitmapContainer.of(low)


class BoundarySet:
    """Different non-negative integers, given in ascending order."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> 16
        cut = np.flatnonzero(np.diff(high)) + 1
        self.high = high[np.append(0, cut)] if len(offsets) else high
        self.parts = [container(x & 0xFFFF) for x in np.split(offsets, cut)] if len(offsets) else []
        self.until = np.append(cut, len(offsets))[:len(self.parts)]

    def __len__(self) -> int:
        return int(self.until[-1]) if len(self.until) else 0

    def select(self, rank: int) -> int:
        """The member of this rank (from 0)."""
        k = int(np.searchsorted(self.until, rank, side="right"))
        return (int(self.high[k]) << 16) + self.parts[k].select(rank - (int(self.until[k - 1]) if k else 0))

    def values(self) -> np.ndarray:
        return np.concatenate([(h << 16) + p.values() for h, p in zip(self.high.tolist(), self.parts, strict=True)]
                              or [np.empty(0, np.int64)])


# ---- boundaries -----------------------------------------------------------------

def boundaries(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Offsets in code points at which the units of each UTF-8 text end."""
    if not texts:
        return
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    stop = np.cumsum(size)
    byte = np.frombuffer(b"".join(texts), np.uint8)
    blank = (byte == 0x20) | ((byte >= 0x09) & (byte <= 0x0D))
    ends = np.zeros(len(byte), bool)
    ends[:-1] = ~blank[:-1] & blank[1:]
    ends[stop[size > 0] - 1] = True  # the last word, or the white space at the end
    points = np.cumsum((byte & 0xC0) != 0x80)
    at = np.flatnonzero(ends)
    cut = np.searchsorted(at, stop)
    before = np.append(0, points[stop[:-1] - 1]) if len(byte) else np.zeros(len(texts), np.int64)
    before[:np.searchsorted(stop, 0, side="right") + 1] = 0
    for lo, hi, base in zip(np.append(0, cut[:-1]), cut, before, strict=True):
        yield points[at[lo:hi]] - base


def cuts(texts: list[bytes], h1: list[int], h2: list[int]) -> Iterator[tuple[int, int, int]]:
    """Number of units of each text and the two cut offsets, the smaller first: the places
    after ``h1 % (n + 1)`` and ``h2 % (n + 1)`` units."""
    for offsets, a, b in zip(boundaries(texts), h1, h2, strict=True):
        found = BoundarySet(offsets)
        n = len(found)
        low, high = sorted((a % (n + 1), b % (n + 1)))
        yield n, found.select(low - 1) if low else 0, found.select(high - 1) if high else 0


def _cuts_of(texts: pd.Series, h1: pd.Series, h2: pd.Series) -> pd.DataFrame:
    rows, todo, size, first = [], [], 0, 0
    for k, t in enumerate([*texts, None]):
        if t is not None:
            todo.append(bytes(t))
            size += len(todo[-1])
        if todo and (t is None or size > CHUNK):
            last = first + len(todo)
            rows += cuts(todo, h1[first:last].tolist(), h2[first:last].tolist())
            todo, size, first = [], 0, last
    return pd.DataFrame(rows, columns=["n", "first", "second"], dtype="int64")


# ---- the operator ---------------------------------------------------------------

def key_hash(doc_id: Column, seed: int, group: int) -> Column:
    """The ``group``-th eight hex digits of sha256 of ``seed:doc_id`` as an unsigned number
    (a null id: nothing after the colon)."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(key, 8 * group - 7, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = RATE, spm_rate: int = SPM_RATE,
                   sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """``docs`` with ``doc_id`` and ``text`` -> one row per input row: ``(doc_id, n, form,
    prefix_chars, middle_chars, output)``.

    * ``n`` is the number of units; ``form`` is ``plain``, ``psm`` (prefix, suffix, middle)
      or ``spm`` (suffix, prefix, middle). Plain texts are those left as they are: empty
      ones, ones that hold a sentinel and a share of ``100 - rate`` percent by the id's
      hash; their two lengths are null.
    * A null text counts as empty. A null id hashes as ``seed:``; repeated rows come back as
      often as they came, rows of equal id are cut by the same hashes. Texts are whole,
      however long. Other columns are ignored, whatever their names. Empty input: empty
      result.
    """
    of = F.pandas_udf(_cuts_of, "n long, first long, second long")
    text, kind = F.coalesce(F.col("text"), F.lit("")), key_hash(F.col("doc_id"), seed, 3) % 100
    plain = (text == "") | (kind >= rate)
    for mark in sentinels:
        plain = plain | F.contains(text, F.lit(mark))
    rows = docs.select(
        "doc_id", text.alias("text"),
        of(text.cast("binary"), key_hash(F.col("doc_id"), seed, 1), key_hash(F.col("doc_id"), seed, 2)).alias("cut"),
        F.when(plain, "plain").when(key_hash(F.col("doc_id"), seed, 4) % 100 < spm_rate, "spm")
        .otherwise("psm").alias("form"))
    first, second = F.col("cut.first").cast("int"), F.col("cut.second").cast("int")
    prefix, middle = F.substr("text", F.lit(1), first), F.substr("text", first + 1, second - first)
    suffix = F.substr("text", second + 1)
    p, s, m = map(F.lit, sentinels)
    moved = F.col("form") != "plain"
    return rows.select(
        "doc_id", F.col("cut.n").alias("n"), "form", F.when(moved, F.col("cut.first")).alias("prefix_chars"),
        F.when(moved, F.col("cut.second") - F.col("cut.first")).alias("middle_chars"),
        F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle))
        .otherwise(F.col("text")).alias("output"))


def restore(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text from which ``fill_in_middle`` made ``output``. A rearranged text holds no
    sentinel of its own, so its three sentinels part it without doubt (none can begin
    inside a part and end in a sentinel, if no sentinel's end begins another)."""
    part = F.split(output, "|".join(re.escape(x) for x in sentinels))
    return (F.when(form == "psm", F.concat(F.get(part, F.lit(1)), F.get(part, F.lit(3)), F.get(part, F.lit(2))))
            .when(form == "spm", F.concat(F.get(part, F.lit(2)), F.get(part, F.lit(3)), F.get(part, F.lit(1))))
            .otherwise(output))
