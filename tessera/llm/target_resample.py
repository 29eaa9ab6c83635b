"""Importance resampling of documents towards a target distribution.

1. A 256-byte table lower-cases A-Z and blanks every ASCII byte that is no letter or digit;
   UTF-8 bytes of other characters stay. ``bytes.translate`` and ``bytes.split`` give the
   words, CRC-32 seeded with the hash of the words before extends them to n-grams.
2. Each task reduces its n-grams in a Counter to at most ``buckets`` sums, which are added
   up over all documents and over all target texts.
3. A bucket's gain is the scaled log ratio of its smoothed shares; a document's weight is
   the mean gain of its features, its score the weight plus Gumbel noise from its id.
4. The highest scores are drawn: a histogram of the scores (whole numbers of a narrow
   range, see ``resample``) gives the score to reach, the rows that reach it are ranked by
   range partitions, with the partitions' sizes as offsets.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, pieces

#: Letters and digits in lower case and bytes beyond ASCII stay, the rest becomes blank.
TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
              for c in range(256))

#: Different features that a task keeps before it reduces them to buckets or forgets them.
KEEP = 200_000


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text; a null text has none."""
    return text.translate(TABLE).split() if text else []


def feature_hashes(words: list[bytes], longest: int) -> Iterator[int]:
    """CRC-32 of each run of 1 to ``longest`` words joined by one space: a run's hash
    seeds that of the run with one more word."""
    run = list(map(zlib.crc32, words))
    yield from run
    spaced = [b" " + w for w in words] if longest > 1 else []
    for k in range(1, longest):
        run = list(map(zlib.crc32, spaced[k:], run))
        yield from run


def n_features(n_words: int, longest: int) -> int:
    return sum(max(0, n_words - k) for k in range(longest))


def bucket_counts(texts: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """Features of the column ``text`` in each bucket. Tasks and the shuffle hand on at most
    ``buckets`` rows each, so does the driver."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = Counter(), np.zeros(buckets, np.int64)

        def reduce() -> None:
            h = np.fromiter(map(zlib.crc32, seen) if longest == 1 else seen, np.int64, len(seen))
            np.add.at(total, h % buckets, np.fromiter(seen.values(), np.int64, len(seen)))
            seen.clear()

        for b in pieces(batches):
            for t in b.column(0).to_pylist():
                words = words_of(t)
                seen.update(words if longest == 1 else feature_hashes(words, longest))
                if len(seen) > KEEP:
                    reduce()
        reduce()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    rows = (texts.select(F.col("text").cast("binary")).mapInArrow(count, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray, unit: int) -> list[int]:
    """Scaled log ratio of each bucket's share in the target and in the source, both
    smoothed by one feature a bucket, rounded down."""
    more = len(source)
    s_all, t_all = int(source.sum()) + more, int(target.sum()) + more
    return [math.floor(unit * math.log((t + 1) * s_all / ((s + 1) * t_all)))
            for s, t in zip(source.tolist(), target.tolist(), strict=True)]


def noise(doc_id: int | None, seed: int, unit: int) -> int:
    """Scaled Gumbel noise from the first eight hex digits of sha256 of ``seed:doc_id`` (a null
    id: nothing after the colon), rounded down."""
    key = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
    return math.floor(-unit * math.log(-math.log((h + 0.5) / 2 ** 32)))


class _Gains(dict):
    """Gain of each word met so far."""

    def __init__(self, gain: list[int]):
        self.gain = gain

    def __missing__(self, word: bytes) -> int:
        out = self[word] = self.gain[zlib.crc32(word) % len(self.gain)]
        return out


def scores(docs: DataFrame, gain: list[int], longest: int, seed: int, unit: int) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score)`` of each row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, size = _Gains(gain), len(gain)
        for b in pieces(batches):
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = words_of(t)
                n = n_features(len(words), longest)
                total = sum(map(known.__getitem__, words) if longest == 1
                            else (gain[h % size] for h in feature_hashes(words, longest)))
                weight = total // n if n else 0
                rows.append((len(words), n, weight, weight + noise(i, seed, unit)))
                if len(known) > KEEP:
                    known.clear()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(x, pa.int64()) for x in zip(*rows, strict=True))],
                ["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(
        run, "doc_id long, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, seed: int = 2024,
             percent: int = 10, min_words: int = 20, unit: int = 1000) -> DataFrame:
    """``docs (doc_id, text)`` against the texts of ``target (text)`` -> one row per input row:
    ``(doc_id, n_features, weight, score, rank)``.

    * ``percent`` of the rows with at least ``min_words`` words are drawn, rounded down: the
      highest scores, ties to the smaller ``doc_id`` (null last), then in an arbitrary order
      that stays the same within one result. ``rank`` counts them from 1; it is null for
      rows that are not drawn.
    * A null or empty text has no features and weight 0. A null id is hashed as ``seed:``.
      Repeated rows count, and come back, as often as they come. Other columns are ignored,
      whatever their names. Without target texts the target's shares are all equal. Empty
      ``docs``: empty result.
    * To the driver come ``buckets`` sums of each side and the number of rows of each score.
      A score lies within ``unit`` times the log of the feature counts plus noise of at most
      23 ``unit``: some ten thousand different ones however many rows there are.
    """
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets), unit)
    rows = materialize(scores(docs, gain, longest, seed, unit)
                       .withColumn("row", F.monotonically_increasing_id()), "resample-scores")
    wanted, least = _cut(rows.where(F.col("n_words") >= min_words), percent)
    if least is None:
        return rows.select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    reaches = (F.col("n_words") >= min_words) & (F.col("score") >= least)
    drawn = (rows.where(reaches).repartitionByRange(F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row"))
             .sortWithinPartitions(F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row"))
             .withColumn("place", F.monotonically_increasing_id()))  # partition << 33 | place in it
    drawn = materialize(drawn.withColumn("part", F.shiftright("place", 33)), "resample-drawn")
    before, start = 0, []
    for part, n in sorted(map(tuple, drawn.groupBy("part").count().collect())):
        start.append((part, before - (part << 33) + 1))
        before += n
    start = docs.sparkSession.createDataFrame(start, "part long, start long")
    drawn = drawn.join(F.broadcast(start), "part").withColumn("rank", F.col("place") + F.col("start"))
    return (drawn.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
            .unionByName(rows.where(~reaches), allowMissingColumns=True)
            .select("doc_id", "n_features", "weight", "score", "rank"))


def _cut(rows: DataFrame, percent: int) -> tuple[int, int | None]:
    """How many rows are drawn, and the least score among them (none: null)."""
    by_score = sorted(map(tuple, rows.groupBy("score").count().collect()), reverse=True)
    wanted = percent * sum(n for _, n in by_score) // 100
    have = 0
    for score, n in by_score:
        have += n
        if wanted and have >= wanted:
            return wanted, score
    return wanted, None


def oracle_sql(buckets: int = 10_000, seed: int = 2024, percent: int = 10, min_words: int = 20,
               unit: int = 1000) -> str:
    """The same in DuckDB for single words; CRC-32 byte by byte from its table."""
    return f"""
    WITH crc_table AS (
      SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)),
        lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
    docs AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
    tw AS (
      SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM benchmark),
    dw AS (SELECT doc_id, unnest(words) AS w FROM docs),
    dc AS (SELECT w, count(*) AS n FROM dw GROUP BY w),
    tc AS (SELECT w, count(*) AS n FROM tw GROUP BY w),
    hashed AS (
      SELECT w, xor(list_reduce(list_concat([4294967295], list_transform(range(strlen(w)),
          lambda i: CAST('0x' || substr(hex(encode(w)), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
        lambda c, b: xor(c >> 8, t[CAST((xor(c, b) & 255) + 1 AS BIGINT)])), 4294967295) % {buckets} AS bucket
      FROM (SELECT w FROM dc UNION SELECT w FROM tc), crc_table),
    sums AS (
      SELECT bucket, sum(coalesce(dc.n, 0)) AS s, sum(coalesce(tc.n, 0)) AS t
      FROM hashed LEFT JOIN dc USING (w) LEFT JOIN tc USING (w) GROUP BY bucket),
    whole AS (SELECT coalesce(sum(s), 0)::DOUBLE AS s_all, coalesce(sum(t), 0)::DOUBLE AS t_all FROM sums),
    gain AS (
      SELECT bucket, floor({unit} * ln(((t + 1)::DOUBLE * (s_all + {buckets})) / ((s + 1)::DOUBLE * (t_all + {buckets}))))
        AS g FROM sums, whole),
    weights AS (
      SELECT doc_id, count(*) AS n, floor(sum(g) / count(*))::BIGINT AS weight
      FROM dw JOIN hashed USING (w) JOIN gain USING (bucket) GROUP BY doc_id),
    scored AS (
      SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-{unit} * ln(-ln(
        (CAST('0x' || substr(sha256('{seed}:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
      FROM docs LEFT JOIN weights USING (doc_id)),
    ranked AS (
      SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n
      FROM scored WHERE n_features >= {min_words})
    SELECT doc_id, n_features, weight, score, CASE WHEN r <= {percent} * n // 100 THEN r END AS rank
    FROM scored LEFT JOIN ranked USING (doc_id)"""
