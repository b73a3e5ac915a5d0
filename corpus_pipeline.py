"""Corpus pipeline: five stages over ``documents``, each by one of the operators.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``. Its result is written as Parquet
and read again as the next stage's input; all but the last return the columns of the
documents they got. Rows with null or empty texts go in the first stage; empty tables
pass through. Columns beside ``doc_id``, ``text``, ``lang``, ``source`` and ``n_chars``
are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadence.llm import dartminhash, decontam, langid, packing, secret_scan
from cadence.llm.common import read, stored
from cadence.llm.queries import word_bpe

#: A document in which no language has this share of the mixture is rejected.
LEAST_LANGUAGE_SHARE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of one prevailing language; those without any letter go."""
    return langid.prevailing(docs, LEAST_LANGUAGE_SHARE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    return dartminhash.deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark passage."""
    return decontam.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces live-looking secrets in the texts; all documents stay."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens into sequences: one row per piece."""
    return packing.pack(docs, word_bpe())


STAGES = [("language_id", language), ("minhash_near_dedup", near_dedup), ("benchmark_decontamination", decontaminate),
          ("secret_scan", secrets), ("best_fit_packing", pack)]

#: SQL has no way to express these stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
