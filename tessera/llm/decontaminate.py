"""Benchmark decontamination by size-partitioned MinHash containment search.

An item is *contained* in a document when at least the share ``threshold`` of its different
word shingles occurs in the document, however long that is. The items are partitioned by
size (powers of two of their shingle count); all items of a partition keep the same number
of minimum hashes, ``u - ceil(threshold * u) + 1`` for the partition's upper size ``u``. A
document that contains an item misses at most ``q - ceil(threshold * q)`` of its ``q <= u``
shingles, so it has at least one of those minima: the search misses nothing. Documents
with too few shingles for an item are left out by size. Candidates are then verified
by exact containment of shingle strings.

The document side is probed with all its shingle hashes: a MinHash signature of a long
document would agree with that of a 30-shingle item in about one hash of a thousand and
miss it. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, free_names, materialize


def word_list(text: Column) -> Column:
    """Lower-cased runs of letters and digits; a null or other text without any: none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _starts(words: str, n: int) -> Column:
    """1-based shingle starts; fewer than ``n`` words make one shingle, no words none."""
    return F.when(F.size(words) == 0, F.array().cast("array<int>")).otherwise(
        F.sequence(F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1))))


def shingle_texts(words: str, n: int) -> Column:
    """Different shingles of a word-list column. Named columns only here and below: an
    expression inside the lambda would be evaluated again for each element."""
    return F.array_distinct(F.transform(_starts(words, n), lambda i: F.array_join(F.slice(words, i, n), " ")))


def with_shingle_hashes(df: DataFrame, words: str, n: int, name: str) -> DataFrame:
    """``df`` with the array ``name``: a 64-bit hash of each shingle, from its words' hashes."""
    df = df.withColumn("__hashed", F.transform(words, lambda w: F.xxhash64(w)))
    return df.withColumn(name, F.transform(
        _starts("__hashed", n), lambda i: F.xxhash64(*[F.get("__hashed", i + (k - 1)) for k in range(n)])))


def item_sketches(items: DataFrame, n: int, threshold: float) -> DataFrame:
    """``items (item_id, ih, words)`` -> ``(item_id, ih, need, h)``: the minimum hashes of each
    item and the shingles a document needs to contain it."""
    need = F.ceil(threshold * F.col("q") - 1e-9)
    upper = F.pow(F.lit(2), F.floor(F.log2("q")) + 1) - 1
    keep = (upper - F.ceil(threshold * upper - 1e-9) + 1).cast("int")
    return (with_shingle_hashes(items, "words", n, "hashes")
            .withColumn("hashes", F.array_sort(F.array_distinct("hashes")))
            .withColumn("q", F.size("hashes")).where("q > 0")
            .withColumn("h", F.explode_outer(F.slice("hashes", F.lit(1), keep)))
            .select("item_id", "ih", need.cast("int").alias("need"), "h"))


def find_contained(docs: DataFrame, benchmark: DataFrame, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """``docs (doc_id, text)`` against ``benchmark (item_id, text)`` -> one row for each
    document text and item it contains: ``(doc_id, th, item_id, n_shared, n_shingles,
    containment)``; ``th`` is the text's hash.

    * Words are lower-cased runs of letters and digits. A text of fewer than ``words``
      words is one shingle; without words it has none and contains or matches nothing.
    * Null texts count as empty. Repeated rows of equal id and text are one document, and
      items of equal id and text one item; null ids are kept as ids of their own.
    * Other columns are ignored, whatever their names. Empty tables: empty result.
    """
    items = benchmark.select("item_id", word_list(F.col("text")).alias("words")).where(F.size("words") > 0).distinct()
    items = materialize(items.withColumn("ih", F.xxhash64("words")), "bench-items")
    sketches = materialize(item_sketches(items, words, threshold), "bench-sketches")
    texts = docs.select("doc_id", F.xxhash64("text").alias("th"), word_list(F.col("text")).alias("w"))
    # explode_outer: a plain explode makes Spark test the array's size below, computing it twice
    probes = (with_shingle_hashes(texts, "w", words, "hashes")
              .select("doc_id", "th", F.size("__hashed").alias("n_words"), "hashes")
              .select("doc_id", "th", "n_words", F.explode_outer("hashes").alias("h")))
    found = probes.join(broadcast_if_small(sketches), "h").where(
        F.greatest(F.col("n_words") - (words - 1), F.lit(1)) >= F.col("need"))
    found = materialize(found.select("doc_id", "th", "item_id", "ih").distinct(), "bench-candidates")
    pairs = broadcast_if_small(found.toDF("d", "t", "i", "item_hash"))
    there = texts.join(pairs, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")))
    wanted = broadcast_if_small(items.select("item_id", "ih", shingle_texts("words", words).alias("wanted")))
    both = there.select("doc_id", "th", "i", "item_hash", shingle_texts("w", words).alias("s")).join(
        wanted, F.col("item_id").eqNullSafe(F.col("i")) & (F.col("ih") == F.col("item_hash")))
    return (both.select("doc_id", "th", "item_id", F.size(F.array_intersect("s", "wanted")).cast("long").alias("n_shared"),
                        F.size("wanted").cast("long").alias("n_shingles"))
            .where(F.col("n_shared") >= F.ceil(threshold * F.col("n_shingles") - 1e-9)).distinct()
            .withColumn("containment", F.col("n_shared") / F.col("n_shingles")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """``docs`` without the rows whose text contains a benchmark item; same columns, whatever
    their names. Null and empty texts contain nothing and stay; repeated rows stay or go
    together, null ids are ids of their own. Empty tables: nothing goes."""
    doc, th = free_names(docs, "__doc", "__th")
    hit = materialize(find_contained(docs, benchmark, words, threshold).select(
        F.col("doc_id").alias(doc), F.col("th").alias(th)).distinct(), "bench-hits")
    return docs.join(broadcast_if_small(hit), docs["doc_id"].eqNullSafe(hit[doc])
                     & (F.xxhash64(docs["text"]) == hit[th]), "left_anti")
