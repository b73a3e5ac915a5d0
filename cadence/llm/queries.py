"""The operators' queries over the test tables (production parameters, whole tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cadence.llm import (dartminhash, decontam, embed_dedup, fim, html_text, langid, packing,
                         secret_scan, suffix_dedup, tokencount, toxicity, warc_build, whitening)
from cadence.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_language_mixture(spark, sf_dir):
    return langid.identify(read(spark, sf_dir, "documents"))


@query
def op2_line_blocks(spark, sf_dir):
    return html_text.extract(read(spark, sf_dir, "pages"))


@query
def op3_dart_minhash(spark, sf_dir):
    return dartminhash.near_duplicates(read(spark, sf_dir, "documents"))


@query
def op4_best_fit_packing(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents"), word_bpe())


@query
def op5_secret_ownership(spark, sf_dir):
    return secret_scan.scan(read(spark, sf_dir, "documents"))


@query
def op6_spaced_seeds(spark, sf_dir):
    return decontam.find_overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op7_token_counts(spark, sf_dir):
    return tokencount.count_tokens(read(spark, sf_dir, "documents"), word_bpe())


@query
def op8_suffix_runs(spark, sf_dir):
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))


@query
def op9_warc_derivatives(spark, sf_dir):
    return warc_build.derivatives(warc_build.responses(read(spark, sf_dir, "pages")))


@query
def op10_pca_tiles(spark, sf_dir):
    return embed_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


@query
def op11_skip_list_fim(spark, sf_dir):
    return fim.digests(fim.transform(read(spark, sf_dir, "documents")))


@query
def op12_jacobi_davidson(spark, sf_dir):
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


@query
def op13_nonnegative_pu(spark, sf_dir):
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
