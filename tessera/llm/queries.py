"""Queries of the training-data operators: thin ``opN_<name>`` entries over whole tables,
with production parameters, and their SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe, decontaminate, fill_middle, license_scan, line_dedup, lm_score, minhash_near, quality_mil, secret_scan,
    simhash_near, syncmers, target_resample, token_files)
from .common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_line_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without its repeated lines, and the numbers of the lines that went."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, dropped="dropped").select(
        "doc_id", F.size("dropped").cast("long").alias("n_dropped"), "dropped", "text")


@register("op2_byte_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@register("op3_license_scan", license_scan.oracle_sql())
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of each document, and how many known licence sentences it has."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.scan(docs).select("doc_id", "licenses", "n_known")


@register("op4_simhash_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_near.near_duplicates(docs, words=3, max_bits=2)


@register("op5_secret_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in each document with the forest's probability."""
    return secret_scan.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op6_document_fingerprints")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each text and of its edited text, likeness and longest common stretch."""
    return syncmers.against_next(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop(
        "anchors", "edited_anchors")


@register("op7_benchmark_decontamination", """
    WITH w AS (
      SELECT doc_id, trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS t FROM documents),
    ds AS (
      SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(string_split(t, ' ')) - 4, 1) + 1),
        lambda i: array_to_string(string_split(t, ' ')[i:i + 4], ' '))) AS s FROM w WHERE t <> ''),
    b AS (
      SELECT item_id, trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS t FROM benchmark),
    bs AS (
      SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(len(string_split(t, ' ')) - 4, 1) + 1),
        lambda i: array_to_string(string_split(t, ' ')[i:i + 4], ' '))) AS s FROM b WHERE t <> ''),
    n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id),
    m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id)
    SELECT doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles AS containment
    FROM m JOIN n USING (item_id) WHERE n_shared >= ceil(0.8 * n_shingles - 1e-9)
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items contained in documents."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.find_contained(docs, read_table(spark, sf_dir, "benchmark"), words=5, threshold=0.8).select(
        "doc_id", "item_id", "n_shared", "n_shingles", "containment")


@register("op8_quality_classifier")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return quality_mil.classify(docs, labels).select(
        "doc_id", quality_mil.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@register("op9_lm_scoring")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op10_token_files")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_files.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"), end=1)


@register("op11_fill_in_middle")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-the-middle form of each text, by digests of the output and of the way back."""
    made = fill_middle.fill_in_middle(read_table(spark, sf_dir, "documents").select("doc_id", "text"), seed=42)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_middle.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@register("op12_target_resampling", target_resample.oracle_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn towards the word distribution of the benchmark texts."""
    return target_resample.resample(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                                    read_table(spark, sf_dir, "benchmark").select("text"),
                                    longest=1, buckets=10_000, seed=2024, percent=10, min_words=20)


@register("op13_minhash_near_dedup")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of documents whose 2-word shingle sets have a similarity of 0.8."""
    return minhash_near.near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                                        words=2, percent=80)
