"""Cuts by the skip list against token lists; whole outputs, digests and the way back."""

import hashlib
import random
import re

import pandas as pd
import pytest
from helpers import edge_docs, edge_rows, no_docs

from cadence.llm import fim


def brute(text, doc_id):
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    n = len(tokens)
    h = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def random_text(r, n):
    return "".join(r.choice("abcXYz <PSM>é日😀\n1") for _ in range(n))


def test_cuts_equal_token_lists():
    r = random.Random(5)
    forms = set()
    for i in range(1500):
        text = random_text(r, r.choice([0, 1, 2, 7, 60, 700]))
        got = fim.transform_text(text, i)
        assert got == brute(text, i)
        forms.add(got[1])
    assert forms == {"plain", "psm", "spm"}


def test_every_rank_of_a_long_text():
    text = random_text(random.Random(6), 60_000)
    lanes = fim.SkipList(text)
    ends = [0, *(m.end() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text, re.S))]
    assert lanes.n == len(ends) - 1 and len(lanes.lanes) > 3
    assert [len(x[0]) for x in lanes.lanes] == sorted((len(x[0]) for x in lanes.lanes), reverse=True)
    for units, chars, _ in lanes.lanes:
        assert units.sum() == lanes.n and chars.sum() == len(text)
    assert [lanes.descend(k) for k in range(lanes.n + 1)] == ends
    for k in (-1, lanes.n + 1):
        with pytest.raises(IndexError):
            lanes.descend(k)


def test_query_on_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = pd.read_parquet("/root/testdata/sf0.01/documents.parquet").set_index("doc_id").text.fillna("")
    got = fim.digests(fim.transform(docs)).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts.index)

    def sha(t):
        return hashlib.sha256(t.encode()).hexdigest()

    for r in got:
        n, form, prefix, middle, out = brute(texts[r["doc_id"]], r["doc_id"])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, prefix, middle)
        assert (r["output_sha256"], r["restored_sha256"]) == (sha(out), sha(texts[r["doc_id"]]))


def test_sentinel_pieces_and_edges(spark):
    texts = ["<", "<P", "P>", "S><M", "<<P", "a<S", "<M>", "x<P>y", "M>" * 50, "<" * 50, None, "", "é日😀 <S <M a"]
    df = spark.createDataFrame([(i * 100 + k, t) for i in range(30) for k, t in enumerate(texts)], "doc_id long, text string")
    given = {r["doc_id"]: r["text"] or "" for r in df.collect()}
    for r in fim.digests(fim.transform(df)).collect():
        assert r["restored_sha256"] == hashlib.sha256(given[r["doc_id"]].encode()).hexdigest()
    got = fim.digests(fim.transform(edge_docs(spark))).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in edge_rows())
    assert len({tuple(r) for r in got if r["doc_id"] == 4}) == 1
    assert fim.transform(no_docs(spark)).collect() == []
