"""Nulls, empty and long texts, repeats, empty tables and clashing columns, for every operator and stage."""

import pytest
from helpers import SF, bpe, edge_docs, edge_rows, no_docs
from pyspark.sql import functions as F

import corpus_pipeline
from cadence.llm import dartminhash, decontam, langid, packing, secret_scan, suffix_dedup, tokencount

BY_ROW = {
    "language": langid.identify,
    "near": dartminhash.near_duplicates,
    "secrets": secret_scan.scan,
    "tokens": lambda d: tokencount.count_tokens(d, bpe()),
    "repeats": suffix_dedup.remove_repeats,
}


@pytest.mark.parametrize("name", BY_ROW)
def test_one_result_per_row(spark, name):
    got = BY_ROW[name](edge_docs(spark)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in edge_rows())
    assert BY_ROW[name](no_docs(spark)).collect() == []


def test_packing_and_decontamination(spark):
    pieces = packing.pack(edge_docs(spark), bpe()).collect()
    assert {str(r["doc_id"]) for r in pieces} == {str(r[0]) for r in edge_rows()}
    assert packing.pack(no_docs(spark), bpe()).collect() == []
    items = spark.createDataFrame([(1, None), (2, ""), (3, edge_rows()[0][1]), (3, "x"), (None, "x")], "item_id long, text string")
    hits = decontam.find_overlaps(edge_docs(spark), items).collect()
    assert sorted((str(r["doc_id"]), str(r["item_id"])) for r in hits) == [("1", "3"), ("1", "3"), ("2", "3"), ("7", "3"), ("7", "None")]
    assert decontam.find_overlaps(no_docs(spark), items).collect() == []
    assert decontam.find_overlaps(edge_docs(spark), items.limit(0)).collect() == []


def test_stages_keep_columns_and_take_anything(spark):
    docs, none = edge_docs(spark), no_docs(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns and got.dtypes == docs.dtypes, name
        n = {"language_id": None, "minhash_near_dedup": 12, "benchmark_decontamination": 14, "secret_scan": 14}[name]
        assert n is None or got.count() == n, name
        assert stage(spark, none, SF).count() == 0, name
    kept = corpus_pipeline.language(spark, docs, SF)
    assert kept.where(F.col("text").isNull() | (F.col("text") == "")).count() == 0
    assert corpus_pipeline.pack(spark, none, SF).count() == 0
