"""Corpus pipeline: quality filter, line dedup, near-dedup, decontamination, tokens.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame, which is written as Parquet and reread as the next one's ``docs``.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import byte_bpe, decontaminate, line_dedup, quality_mil, simhash_near
from tessera.llm.common import free_names, materialize, read_table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on ``labels``, rejects go. A null text counts as
    empty; rows of equal text stay or go together."""
    labels = read_table(spark, sf_dir, "labels")
    score, predicted = free_names(docs, "__score", "__predicted")
    scored = quality_mil.classify(docs, labels, score_col=score, predicted_col=predicted)
    return scored.where(F.col(predicted) == 1).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of equal or nearly equal lines, one occurrence stays, the first by ``doc_id``
    (null first) and place. Every row stays, null texts as null."""
    return line_dedup.dedup_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the one with the smallest id (null last).
    Null and blank texts are one component."""
    return simhash_near.keep_one(docs, words=3, max_bits=2)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item (0.8 of its 5-word shingles) go; null and empty
    texts stay."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"), words=5, threshold=0.8)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of each text that is left (null: empty), decoded again and hashed: one
    row per document, with columns of its own."""
    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [("quality classifier", keep_quality), ("line dedup", dedup_lines), ("simhash near-dedup", drop_near_copies),
          ("benchmark decontamination", drop_benchmark), ("byte bpe", encode)]

#: No SQL: the classifier is trained and the SimHash bit counts have no DuckDB form. The
#: stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
