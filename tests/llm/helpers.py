"""Rows that every operator must take: nulls, empty and long texts, repeats, columns with clashing names."""

from __future__ import annotations

import random

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("key", T.StringType()),
                     T.StructField("digest", T.IntegerType()), T.StructField("part", T.DoubleType()), T.StructField("spans", T.StringType()),
                     T.StructField("class_id", T.StringType()), T.StructField("lang_pred", T.StringType())])


def words(n: int, seed: int, alphabet: str = "abcdefghij") -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(alphabet) for _ in range(r.randint(2, 8))) for _ in range(n))


def edge_rows() -> list[tuple]:
    long_ = words(40_000, 1)
    texts = [(1, words(60, 2)), (1, words(60, 2)), (2, words(60, 2)), (3, None), (4, ""), (4, ""), (None, words(30, 3)), (None, None),
             (5, long_), (6, "!!! ... 12345"), (7, "x"), (8, "password = hunter2hunter2"), (9, "日本語 テキスト ퟿ <|endoftext|> é"), (1, words(50, 4))]
    return [(i, t, "en" if t else None, None if i == 2 else "s", len(t or ""), "k", 1, 0.5, "x", "c", "p") for i, t in texts]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def bpe() -> str:
    from cadence.llm.queries import word_bpe

    return word_bpe()
