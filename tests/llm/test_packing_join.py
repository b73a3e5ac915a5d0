"""The join that numbers the pieces across tasks: no sort of the pieces, and every piece numbered once."""

import public_tokenizers

from cadence.llm import packing


def test_pieces_are_numbered_without_sorting_them(spark):
    docs = [(i, "a b c" if i % 2 else " ".join(["word"] * (i % 7))) for i in range(200)] + [(1000, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(9)
    out = packing.pack(df, public_tokenizers.path("word_bpe_49k.json"), capacity=16)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    rows = out.collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in docs)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in bins.values():  # gapless from 0, nothing twice, no more than the capacity
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 16
