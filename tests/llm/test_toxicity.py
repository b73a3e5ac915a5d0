"""Held-out accuracy, what is learned from, the non-negative risk, and odd rows."""

import zlib

import numpy as np
import pandas as pd
from helpers import edge_docs, edge_rows, no_docs, words

from cadence.llm import toxicity

LABELS = "doc_id long, quality int, toxic int, text string"


def planted(n, seed, word):
    """Invented prose of which every fifth text holds the word once."""
    return [(i, words(120, seed + i) + (f" {word} " + words(20, seed - i - 1) if i % 5 == 0 else "")) for i in range(n)]


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    got = toxicity.classify(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")).toPandas()
    assert len(got) == len(pd.read_parquet(f"{d}/documents.parquet"))
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in zip(got.doc_id, got.held_out))
    assert got.score.between(0, 1).all() and ((got.score >= 0.7) == (got.predicted == 1)).all()
    toxic = got.doc_id.map(pd.read_parquet(f"{d}/labels.parquet").set_index("doc_id").toxic)
    held = got[got.held_out & toxic.notna()]
    y = toxic[held.index].to_numpy()
    rank = held.score.rank().to_numpy()
    auc = (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    assert auc > 0.9
    assert held.predicted[y == 1].mean() > 0.8 and held.predicted[y == 0].mean() < 0.02


def test_learns_only_from_visible_labels(spark):
    docs = planted(900, 10_000, "qqzzkk")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    all_labels = [(i, None, int(i % 5 == 0), "x") for i, _ in docs]
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t, x) for i, q, t, x in all_labels]
    a, b = ({r["doc_id"]: r for r in toxicity.classify(df, spark.createDataFrame(x, LABELS)).collect()} for x in (all_labels, flipped))
    assert all(a[i]["score"] == b[i]["score"] for i, _ in docs)
    held = [r for r in a.values() if r["held_out"]]
    assert all((r["predicted"] == 1) == (r["doc_id"] % 5 == 0) for r in held)
    # zeros are not used, but for the prior: without them and with the prior given, the same scores
    only = toxicity.classify(df, spark.createDataFrame([x for x in all_labels if x[2]], LABELS), prior=0.2).collect()
    same = toxicity.classify(df, spark.createDataFrame(all_labels, LABELS), prior=0.2).collect()
    assert sorted(map(tuple, only)) == sorted(map(tuple, same))


def test_a_long_text_with_one_word(spark):
    docs = planted(900, 20_000, "qqzzkk")
    long_ = words(60_000, 3)
    cut = len(long_) // 2
    extra = [(5001, long_), (5002, f"{long_[:cut]} qqzzkk {long_[cut:]}")]
    labels = spark.createDataFrame([(i, None, int(i % 5 == 0), "x") for i, _ in docs], LABELS)
    got = {r["doc_id"]: r["predicted"] for r in toxicity.classify(spark.createDataFrame(docs + extra, "doc_id long, text string"), labels).collect()}
    assert (got[5001], got[5002]) == (0, 1)


def test_risk_stays_non_negative():
    r = np.random.default_rng(0)
    width, n_pos, n_unl, prior = 40, 300, 1500, 0.2

    def rows(n, toxic):
        m = r.random((n, width)) < 0.1
        m[:, :4] |= toxic[:, None] & (r.random((n, 4)) < 0.6)
        at = np.nonzero(m)
        return at[0], at[1], n

    truth = r.random(n_unl) < prior
    pos, unl = rows(n_pos, np.ones(n_pos, bool)), rows(n_unl, truth)
    w, b = toxicity.fit(pos, unl, width, prior)
    score = 1 / (1 + np.exp(-(np.bincount(unl[0], w[unl[1]], n_unl) + b)))
    assert score[truth].mean() > score[~truth].mean() + 0.3 and abs(score.mean() - prior) < 0.07
    assert (w[:4] > np.abs(w[4:]).max()).all() and np.isfinite(w).all()


def test_edges(spark):
    labels = spark.createDataFrame([(1, 1, 1, "x"), (1, 1, 0, "x"), (2, 0, None, "x"), (None, 0, 1, "x"), (3, 0, 0, "x"), (9, 1, 1, "x")], LABELS)
    got = toxicity.classify(edge_docs(spark), labels).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in edge_rows())
    assert all(0 <= r["score"] <= 1 for r in got) and [r["held_out"] for r in got if r["doc_id"] is None] == [False, False]
    assert len({r["score"] for r in got if r["doc_id"] == 4}) == 1
    assert all(r["score"] == 0 and r["predicted"] == 0 for r in toxicity.classify(edge_docs(spark), labels.limit(0)).collect())
    assert all(r["score"] == 0 for r in toxicity.classify(edge_docs(spark), labels.where("toxic = 0")).collect())
    assert toxicity.classify(no_docs(spark), labels).collect() == []
