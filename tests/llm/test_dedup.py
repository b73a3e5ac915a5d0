"""Near-duplicates, repeats and embeddings against brute force."""

import collections
import hashlib
import random
import time

import numpy as np
import pandas as pd
import pytest
from helpers import SF, words

from cadence.llm import components, dartminhash, decontam, embed_dedup, suffix_dedup, wordhash


def closure(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_signatures_estimate_weighted_similarity():
    r = np.random.default_rng(0)
    x = r.integers(1, 2 ** 63, 400).astype(np.uint64)
    a = r.uniform(0.1, 3, 400)
    b = a * r.uniform(0.3, 1.4, 400)
    sa, sb = dartminhash.signature(x, a, 3000), dartminhash.signature(x, b, 3000)
    assert abs((sa == sb).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.04
    sa, sb = dartminhash.signature(x[:300], None, 3000), dartminhash.signature(x[30:], None, 3000)
    assert abs((sa == sb).mean() - 270 / 400) < 0.04
    assert (dartminhash.signature(x[:1], None, 50) != 0).all()


def test_words_do_not_depend_on_batches(monkeypatch):
    texts = [words(50, k) for k in range(20)] + ["", "!", "É é_x", "z" * 9000]
    h, first = wordhash.words(texts)
    monkeypatch.setattr(wordhash, "SEGMENT", 64)
    for k, t in enumerate(texts):
        assert (wordhash.words([t])[0] == h[first[k]:first[k + 1]]).all()
    assert len(np.unique(h)) == len({w for t in texts for w in __import__("re").findall(r"[a-z0-9é]+", t.lower().replace("_", " "))})


def test_near_duplicate_groups(spark):
    docs = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")
    extra, r = [], random.Random(1)
    base = words(200, 77).split()
    for k in range(150):  # most near the base, hardly any near each other
        w = list(base)
        for _ in range(r.choice([3, 3, 6, 9])):
            w[r.randrange(200)] = f"w{r.random()}"
        extra.append(" ".join(w))
        if k % 10 == 0:  # near that one, not near the base
            w[r.randrange(200)] = "twin"
            extra.append(" ".join(w))
    texts = dict(zip(docs.doc_id.tolist(), docs.text)) | {10_000 + k: t for k, t in enumerate([*extra, " ".join(base)])}
    sets = {i: frozenset(wordhash.shingles(wordhash.words([t])[0], 5).tolist()) for i, t in texts.items()}
    by, links = collections.defaultdict(list), set()
    for i, s in sets.items():
        for h in s:
            by[h].append(i)
    for group in by.values():
        for a in group:
            links |= {(a, b) for b in group if a < b}
    links = [(a, b) for a, b in links if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want = closure(texts, links)
    got = dartminhash.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == want
    assert sorted(r["doc_id"] for r in got if r["kept"]) == sorted(set(want.values()))


def test_components(spark):
    r = random.Random(4)
    links = [(r.randrange(400), r.randrange(400)) for _ in range(250)] + [(k, k + 1) for k in range(500, 560)] + [(600, k) for k in range(601, 700)]
    got = {x["node"]: x["root"] for x in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = closure({n for ab in links for n in ab}, links)
    assert got == {n: k for n, k in want.items() if n in got} and all(n in got or k == n for n, k in want.items())


def repeats(texts, n):
    data = [t.encode() for t in texts]
    seen = collections.Counter(b[i:i + n] for b in data for i in range(len(b) - n + 1))
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - n + 1):
            if seen[b[i:i + n]] > 1:
                gone[i:i + n] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        yield len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()


@pytest.mark.parametrize("length, gram, seed", [(20, 8, 1), (12, 5, 2), (30, 20, 3), (16, 16, 4)])
def test_repeats_of_random_texts(spark, length, gram, seed):
    r = random.Random(seed)
    letters = "abé " if seed % 2 else "abcdefgh \n"
    some = lambda n: "".join(r.choice(letters) for _ in range(n))
    passages, texts = [some(r.randint(5, 60)) for _ in range(12)], []
    for _ in range(200):
        t = ""
        for _ in range(r.randint(0, 5)):
            p, a = r.choice(passages), r.randint(0, 20)
            t += some(r.randint(0, 40)) + p[a // 3:len(p) - a // 4]
        texts.append(t)
    texts += texts[:5] + ["a" * 500, "", "ab" * 200]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {x["doc_id"]: (x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in suffix_dedup.remove_repeats(df, length=length, gram=gram).collect()}
    assert got == dict(enumerate(repeats(texts, length)))


def test_repeats_in_segments_and_short_runs(spark, monkeypatch):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    t = [b.encode() for b in docs.text if len(b) > 3000][:5]
    whole = [np.concatenate(x) for x in zip(*suffix_dedup.text_anchors(t, 200, 88))]
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 1000)
    parts = [np.concatenate(x) for x in zip(*suffix_dedup.text_anchors(t, 200, 88))]
    assert set(zip(whole[0].tolist(), whole[1].tolist())) == set(zip(parts[0].tolist(), parts[1].tolist()))
    got = {x["doc_id"]: (x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in
           suffix_dedup.remove_repeats(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    assert got == dict(zip(docs.doc_id.tolist(), repeats(docs.text, 200)))


def test_merge_gives_order_and_common_prefixes():
    r = random.Random(2)
    for n in (1, 2, 3, 7):
        lists = [sorted({"".join(r.choice("ab") for _ in range(r.randint(0, 12))).encode() for _ in range(r.randint(0, 40))}) for _ in range(n)]
        runs = [suffix_dedup.Run(*suffix_dedup.front_code(x)) for x in lists]
        got = list(suffix_dedup.merge(runs))
        assert [s for s, _, _ in got] == sorted(s for x in lists for s in x)
        assert all(k == suffix_dedup.common(a, b) for (a, _, _), (b, k, _) in zip(got, got[1:]))


def test_embeddings(spark):
    r = np.random.default_rng(3)
    base = r.normal(size=(40, 16))
    rows = []
    for k in range(600):
        v = base[r.integers(40)] + r.normal(size=16) * r.choice([0.0, 0.05, 0.2])
        rows.append((k, [float(x) for x in v * r.uniform(0.1, 9)], int(r.integers(3))))
    rows += [(k + 600, rows[k][1], rows[k][2]) for k in range(50)]
    odd = [(700, None, 1), (701, [], 1), (702, [0.0] * 16, 1), (703, [1.0] * 15 + [None], 1), (704, [float("nan")] * 16, 1), (705, rows[0][1], None),
           (706, [1.0, 2.0], 1), (707, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")
    got = {x["vec_id"]: (x["n_links"], x["component_id"], x["kept"]) for x in embed_dedup.near_duplicates(df, tile=32, sample=100).collect()}
    m = np.asarray([v for _, v, _ in rows])
    cos = m @ m.T / np.outer(np.linalg.norm(m, axis=1), np.linalg.norm(m, axis=1))
    label = np.asarray([x for _, _, x in rows])
    link = (cos >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(link, False)
    ids = np.asarray([i for i, _, _ in rows])
    want = closure(ids.tolist(), [(int(ids[a]), int(ids[b])) for a, b in zip(*np.nonzero(link))])
    for a, i in enumerate(ids.tolist()):
        assert got[i] == (int(link[a].sum()), want[i], want[i] == i)
    assert all(got[i] == (0, i, True) for i in range(700, 706)) and got[706] == (1, 706, True) and got[707] == (1, 706, False)
    assert embed_dedup.near_duplicates(df.limit(0)).collect() == []


def test_decontamination_tolerates_substitutions(spark):
    r = random.Random(9)
    items = [(k, words(r.randint(14, 60), 100 + k)) for k in range(20)] + [(50, words(5, 999)), (51, items_text := words(30, 555)), (51, items_text)]
    docs, want = [], set()
    for d in range(120):
        body = words(r.randint(0, 150), 1000 + d).split()
        if d % 3 == 0:
            k, t = r.choice(items)
            passage = t.split()
            for p in range(6, len(passage) - 3, 10):
                passage[p] = "zzz"
            at = r.randint(0, len(body))
            body[at:at] = passage
            want |= {(d, k)}
        docs.append((d, " ".join(body).upper() if d % 2 else "\n".join(body)))
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for block in (8_000_000, 900):
        got = {(x["doc_id"], x["item_id"]) for x in decontam.find_overlaps(df, bench, block_chars=block).collect()}
        assert got == want
        left = {x["doc_id"] for x in decontam.decontaminate(df, bench, block_chars=block).collect()}
        assert left == {d for d, _ in docs} - {d for d, _ in want}


def qualifies(eq, need: int, identity: float) -> bool:
    c = np.concatenate([[0], np.cumsum(eq)]).astype(int)
    return any(c[z] - c[a] >= need and (c[z] - c[a]) * 1000 >= round(identity * 1000) * (z - a) for a in range(len(eq)) for z in range(a + 1, len(eq) + 1))


def test_any_qualifying_segment_is_an_overlap():
    # 13 verbatim words, then 30 of which 70% agree: no whole passage at 0.8, but its beginning is
    item = [f"w{i}" for i in range(43)]
    index = decontam.Index([(1, " ".join(item))])
    text = " ".join("zz" if i >= 13 and i % 10 in (3, 6, 9) else x for i, x in enumerate(item))
    assert [h[:2] for h in index.hits([text])] == [(0, 0)]
    r = random.Random(4)
    for n, share in ((14, 0.15), (16, 0.2), (20, 0.2), (25, 0.25), (60, 0.25), (100, 0.25), (13, 0.05), (8, 0.05)):
        item = [f"w{i}" for i in range(n)]
        index = decontam.Index([(1, " ".join(item))])
        eqs = [np.asarray([r.random() >= share for _ in item]) for _ in range(150)]
        got = {h[0] for h in index.hits([" ".join(x if e else "zz" for x, e in zip(item, eq)) for eq in eqs])}
        assert got == {i for i, eq in enumerate(eqs) if qualifies(eq, min(13, n), 0.8)}


@pytest.mark.parametrize("need, identity", [(13, 0.8), (8, 0.6), (5, 0.9), (13, 1.0), (10, 0.75), (3, 0.5)])
def test_masks_miss_no_pattern(need, identity):
    # the best score (equal * (1 - identity) - replaced * identity) of a pattern without a mask's window, by its last positions
    masks = list(decontam.masks_for([], need, identity).values())
    span = max(int(m[-1]) for m in masks) + 1
    up, down = round(1000 * (1 - identity)), -round(1000 * identity)
    best, todo = {(0, 0): 0}, [(0, 0)]
    for _ in range(300):
        new = {}
        for last, n in todo:
            for bit in (0, 1):
                bits = (last << 1 | bit) & ((1 << span) - 1)
                if any(all(bits >> (int(m[-1]) - int(p)) & 1 for p in m) for m in masks):
                    continue
                state, score = (bits & ((1 << (span - 1)) - 1), min(need, n + bit)), best[last, n] + (up if bit else down)
                if score > best.get(state, -10**9):
                    best[state] = new[state] = score
        todo = list(new)
        assert all(x < 0 for (_, n), x in best.items() if n == need)
        if not todo:
            break
    assert not todo  # no better pattern is left: the proof is complete


def test_repeated_words_cost_their_lengths(spark):
    start = time.process_time()
    for item, doc, want in (("a " * 2000, "a " * 200_000, (2000, 2000, 0)), ("a " * 1990 + "b " * 10, "a " * 200_000, (1990, 1990, 0)),
                            ("a b c " * 700, "a b c " * 60_000, (2100, 2100, 0))):
        assert [h[2:] for h in decontam.Index([(1, item)]).hits([doc])] == [want]
    assert time.process_time() - start < 60


def test_hits_equal_all_diagonals():
    r = random.Random(4)
    for _ in range(120):
        vocabulary = [f"w{i}" for i in range(r.choice([1, 2, 3, 9]))]
        def text(n):  # noqa: E306
            period = [r.choice(vocabulary) for _ in range(r.randint(1, 4))]
            return " ".join((period * n)[:n] if r.random() < 0.4 else [r.choice(vocabulary) for _ in range(n)])
        items, docs = [(i, text(r.choice([0, 3, 13, 50]))) for i in range(2)], [text(r.choice([0, 4, 40, 90])) for _ in range(3)]
        index, want = decontam.Index(items), []
        for t, doc in enumerate(docs):
            hashes = decontam.wordhash.words([doc])[0]
            every = np.asarray([(k, d) for k, w in enumerate(index.words) for d in range(-len(w) + 1, len(hashes))], np.int64).reshape(-1, 2)
            want += [(t, *x) for x in index.overlaps(hashes, 0, len(hashes), every)]
        assert sorted(index.hits(docs)) == sorted(want)


def test_a_benchmark_that_repeats_one_item(spark):
    items = [(i, words(40, 7)) for i in range(40)] + [(100 + i, words(40, 300 + i)) for i in range(20)]
    docs = spark.createDataFrame([(1, "x " + words(40, 7) + " y"), (2, words(40, 303)), (3, words(90, 9))], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (8_000_000, 500):
        got = sorted((x["doc_id"], x["item_id"]) for x in decontam.find_overlaps(docs, bench, block_chars=block).collect())
        assert got == [(1, i) for i in range(40)] + [(2, 103)]
