"""The pipeline against its stages' brute-force counterparts, and the registered queries' names."""

import pandas as pd
from helpers import SF
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from cadence.llm import queries


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "minhash_near_dedup", "benchmark_decontamination", "secret_scan", "best_fit_packing"]


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = pd.read_parquet(f"{SF}/benchmark.parquet")
    planted = docs.limit(1).select(F.lit(9001).cast("long").alias("doc_id"), F.concat(F.substring("text", 1, 300), F.lit(" " + bench.text[0])).alias("text"), "lang", "source", "n_chars")
    letterless = docs.limit(1).select(F.lit(9002).cast("long").alias("doc_id"), F.lit("1 2 3").alias("text"), "lang", "source", "n_chars")
    copy = docs.where("doc_id = 9").select((F.col("doc_id") + 9003).alias("doc_id"), F.upper("text").alias("text"), "lang", "source", "n_chars")
    now = docs.unionByName(planted).unionByName(letterless).unionByName(copy)
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF)
        kept.append({r["doc_id"] for r in now.select("doc_id").collect()})
    assert 9002 not in kept[0] and {9001, 9012} <= kept[0]
    assert 9012 not in kept[1] and 9001 in kept[1]
    assert 9001 not in kept[2]
    text = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id").text
    assert not any(b in text[d] for d in kept[2] for b in bench.text)
    assert kept[3] == kept[2]
    assert {r["doc_id"] for r in corpus_pipeline.pack(spark, now, SF).collect()} == kept[3]


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and got.count() > 100
