"""Token counts and packing against the library and an item-by-item best-fit decreasing."""

import random
import zlib

import numpy as np
import pandas as pd
import pytest
from helpers import SF, bpe, words
from tokenizers import Tokenizer

from cadence.llm import packing, tokencount, wordbpe


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(bpe())


def test_ids_equal_the_library(lib):
    enc, r = wordbpe.WordBpe(bpe()), random.Random(3)
    letters = "abcXYZ'smtdlrve09 \t\n.,;:!?-_()[]{}<>|@#$%&*+=/\\~`^éèüßÑÀÿøæ–—‘’“”…€ΣςİıſḰ日本́  \x1c\x85½²ªº"
    for _ in range(4000):
        t = "".join(r.choice(letters[:r.choice([30, 60, len(letters)])]) for _ in range(r.randint(0, 30)))
        if r.random() < 0.1:
            t += "<|endoftext|>" + t
        assert enc.ids(t) == np.asarray(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t
    t = words(30_000, 5) + "Σ" + words(9000, 6)
    assert enc.ids(t) == np.asarray(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_spliced_counts(spark, lib):
    texts = [words(3000, 1), "a" * 5000, words(400, 2) + "b" * 3000 + " " + words(900, 3), words(500, 4).replace(" ", "<|endoftext|>"),
             "日本" * 2000 + " " + words(2000, 5), words(300, 6)] * 2
    df = spark.createDataFrame([(i % 7, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = tokencount.count_tokens(df, bpe(), chunk_chars=500, overlap=40).collect()
    want = sorted((i % 7, len(t.encode()), len(lib.encode(t, add_special_tokens=False).ids)) for i, t in enumerate(texts))
    assert sorted((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in got)


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [k for k, room in enumerate(rooms) if room >= n]
        if fit:
            rooms[min(fit, key=rooms.__getitem__)] -= n
        else:
            rooms.append(capacity - n)
    return rooms


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_fit_decreasing(seed):
    r = random.Random(seed)
    capacity = r.choice([7, 50, 64, 100])
    lengths = [r.randint(1, capacity) if r.random() < 0.7 else r.choice([1, 3, capacity]) for _ in range(r.randint(1, 300))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    rows, bins = packing.plan(counts.items(), capacity), {}
    for n, lo, hi, first, each, offset in rows:
        for k in range(hi - lo):
            bins.setdefault(first + k // each, []).append((offset + k % each * n, n))
    for found in bins.values():
        at = 0
        for offset, n in sorted(found):
            assert offset == at
            at += n
        assert at <= capacity
    assert sorted(capacity - sum(n for _, n in b) for b in bins.values()) == sorted(best_fit_decreasing(lengths, capacity))
    for n, c in counts.items():
        spans = sorted((lo, hi) for m, lo, hi, *_ in rows if m == n)
        assert spans[0][0] == 0 and spans[-1][1] == c and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_pieces_hold_all_tokens(spark, lib):
    docs = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id")
    got = packing.pack(spark.read.parquet(f"{SF}/documents.parquet"), bpe(), capacity=256).toPandas()
    ids = {i: np.asarray([*lib.encode(t, add_special_tokens=False).ids, 0], "<u4") for i, t in docs.text.items()}
    for r in got.itertuples():
        body = ids[r.doc_id][r.start:r.start + r.length]
        assert len(body) == r.length and zlib.crc32(body.tobytes()) == r.ids_crc32 and r.start == 256 * r.piece
    assert got.groupby("doc_id").length.sum().to_dict() == {i: len(x) for i, x in ids.items()}
    assert got.sequence_id.nunique() == len(best_fit_decreasing(got.length.tolist(), 256))
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert (g.offset.to_numpy() == np.concatenate([[0], g.length.cumsum().to_numpy()[:-1]])).all() and g.length.sum() <= 256
