"""Toxicity scores by non-negative positive-unlabelled learning.

Labelled zeros are never shown to the classifiers: they see texts confirmed toxic and texts
without labels. Each is a linear logistic classifier in numpy that minimises the class-prior
corrected risk ``p E+[l(g)] + max(0, Eu[l(-g)] - p E+[l(-g)])``; where the
second part falls below zero (the model has begun to fit single unlabelled texts), the step
goes back up that part instead. The prior p is the share of toxic labels, or a parameter.

A text is the set of its features, hashes of words and of five-letter pieces of words, each
counted once whatever the length of the text. The features that a classifier gets are those that
differ between its toxic and unlabelled texts. Several classifiers learn from separate
samples (one, where the toxic texts fill no more), each in a task of its own; the score is the logistic of their mean.

The samples are bounded: MEMBERS classifiers of at most about POSITIVES and UNLABELLED distinct
texts (documented parameters); whole texts are read, and every row is scored by its whole
text. Without confirmed toxic texts every score is the prior (0 if there are no labels).
Null and empty texts have no features and get the score of a text without any. An id labelled more than
once is toxic if one of its labels says so; null labels say nothing. Rows whose id is null
or repeated are rows of their own, and their text counts once. An empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import map_arrow, slices, stored, text_or_empty
from cadence.llm.wordhash import mix, words

U = np.uint64
#: Feature classes; pieces of words have this many characters.
BUCKETS, PIECE = 1 << 20, 5
#: Bounds of the training samples: classifiers, and about so many distinct texts for each.
MEMBERS, POSITIVES, UNLABELLED = 3, 2500, 7500
#: A feature is kept if its rates differ by so many standard errors, and if so many toxic texts hold it.
LEAST_Z, LEAST_DOCS = 4.0, 3
#: Bound of the features of one classifier, the most telling first.
FEATURES = 1 << 14
STEPS, RATE, SHRINK = 300, 0.2, 1e-5
THRESHOLD = 0.7


def _pieces(text: str) -> np.ndarray:
    """Hashes of all runs of PIECE characters, words being letters (any script) and digits between single spaces."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    wordy = (code > 127) | ((code >= 97) & (code <= 122)) | ((code >= 48) & (code <= 57))
    keep = wordy.copy()
    keep[1:] |= wordy[:-1]
    code = np.where(wordy, code, np.uint32(32))[keep].astype(U)
    code = np.concatenate([[U(32)], code, [U(32)]])
    n = len(code) - PIECE + 1
    if n < 1:
        return np.zeros(0, U)
    h = np.zeros(n, U)
    for i in range(PIECE):
        h = h * U(0x9E3779B97F4A7C15) + code[i:i + n]
    return mix(h)


def features(texts: list[str]) -> Iterator[np.ndarray]:
    """Of each text, the features of its words and pieces, with repeats."""
    for lo, hi in slices(texts, 1 << 20):
        h, at = words(texts[lo:hi])
        for i in range(lo, hi):
            yield (np.concatenate([h[at[i - lo]:at[i - lo + 1]], _pieces(texts[i])]) >> U(44)).astype(np.int64)


def _held(texts: list[str], index: np.ndarray) -> Iterator[np.ndarray]:
    """Of each text, the places of the distinct features that ``index`` (place by feature, or -1) keeps."""
    for f in features(texts):
        place = index[f]
        yield np.unique(place[place >= 0])


def fit(pos: tuple[np.ndarray, np.ndarray, int], unl: tuple[np.ndarray, np.ndarray, int], width: int,
        prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk. Sets are ``(row, feature, rows)``, sorted by row.

    Adagrad over the whole sample, the mean of the later half of the steps: estimated from a small batch, the second
    part would often fall below zero by chance and hold the scores back."""
    w, b = np.zeros(width), float(np.log(prior / (1 - prior)))
    seen_w, seen_b = np.full(width, 1e-8), 1e-8
    mean_w, mean_b, taken = np.zeros(width), 0.0, 0

    def logits(s):
        return np.bincount(s[0], w[s[1]], s[2]) + b

    def back(s, d):
        return np.bincount(s[1], d[s[0]], width), d.sum()

    def sigmoid(g):
        return 0.5 * (1 + np.tanh(0.5 * g))

    for step in range(STEPS):
        gp, gu = logits(pos), logits(unl)
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        (wu, bu), (wn, bn) = back(unl, sigmoid(gu) / unl[2]), back(pos, prior * sigmoid(gp) / pos[2])
        if negative < 0:  # back up the part that became negative
            dw, db = wn - wu, bn - bu
        else:
            wp, bp = back(pos, prior * sigmoid(-gp) / pos[2])
            dw, db = wu - wn - wp, bu - bn - bp
        dw = dw + SHRINK * w
        seen_w += dw * dw
        seen_b += db * db
        w -= RATE * dw / np.sqrt(seen_w)
        b -= RATE * db / np.sqrt(seen_b)
        if 2 * step >= STEPS:
            taken += 1
            mean_w += (w - mean_w) / taken
            mean_b += (b - mean_b) / taken
    return mean_w, mean_b


def _rates(batches):
    """Of each classifier's features, how many of its toxic and of its unlabelled texts hold it."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        texts, member, toxic = (batch.column(c).to_pylist() for c in ("text", "member", "toxic"))
        for f, m, t in zip(features(texts), member, toxic):
            count = total.setdefault(m, np.zeros((2, BUCKETS), np.int32))[t]
            count[f] += 1  # once a text, however often it holds the feature
    for m, (unl, pos) in total.items():
        at = np.flatnonzero(unl + pos)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), m, np.int32)), pa.array(at, pa.int32()), pa.array(unl[at]), pa.array(pos[at])],
                                         ["member", "feature", "unl", "pos"])


def _kept_features(shared):
    def run(batches):
        index = {}
        for m, f in shared.value.items():
            index[m] = np.full(BUCKETS, -1, np.int32)
            index[m][f] = np.arange(len(f))
        for batch in batches:
            held = [np.unique(p[p >= 0]) for m, f in zip(batch.column("member").to_pylist(), features(batch.column("text").to_pylist()))
                    for p in [index[m][f]]]
            yield pa.RecordBatch.from_arrays([batch.column("member"), batch.column("toxic"), pa.array(held, pa.list_(pa.int32()))],
                                             ["member", "toxic", "held"])
    return run


def _train(shared, prior: float):
    def run(batches):
        """All rows of a task are one classifier's (or several's, one after the other)."""
        sets: dict[tuple[int, int], tuple[list, list]] = {}
        for batch in batches:
            for m, t, held in zip(*(batch.column(c).to_pylist() for c in ("member", "toxic", "held"))):
                sets.setdefault((m, t), []).append(np.asarray(held, np.int64))
        for m in sorted({m for m, _ in sets}):
            pos, unl = ((np.repeat(np.arange(len(s)), [len(x) for x in s]), np.concatenate([*s, np.zeros(0, np.int64)]), len(s))
                        for s in (sorted(sets.get((m, t), []), key=lambda x: x.tobytes()) for t in (1, 0)))
            if not pos[2] or not unl[2]:
                continue
            f = shared.value[m]
            w, b = fit(pos, unl, len(f), prior)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(f, -1), pa.int32()), pa.array(np.append(w, b))], ["feature", "weight"])
    return run


def learn(texts: DataFrame, confirmed: DataFrame, prior: float, members: int = MEMBERS, positives: int = POSITIVES,
          unlabelled: int = UNLABELLED) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Features, mean weights and mean bias, from ``texts`` (text, digest) and the digests that are ``confirmed`` toxic;
    None if there is nothing to learn from.

    There are as many classifiers as the confirmed texts fill, at most ``members``. Samples are drawn from distinct texts
    by their digests, so that only sampled texts are exchanged. Chosen features (at most FEATURES a classifier) and
    weights are all that comes to the driver."""
    texts, confirmed = texts.where("text != ''"), confirmed.distinct()

    def drawn(df, n, bound):
        return df.where(F.shiftrightunsigned("digest", 11) / float(1 << 53) < (min(1.0, bound / n) if n else 0.0))

    n_pos = confirmed.count()
    members = max(1, min(members, -(-n_pos // positives)))
    n_all = texts.agg(F.approx_count_distinct("digest", 0.02)).first()[0]
    of_toxic = drawn(confirmed, n_pos, members * positives)  # about members * positives digests, so they are broadcast
    parts = [drawn(texts, n_all, members * unlabelled), texts.join(F.broadcast(of_toxic), "digest", "left_semi")]
    parts = [some.dropDuplicates(["digest"]).select("text", F.pmod(F.xxhash64("digest"), F.lit(members)).cast("int").alias("member"), F.lit(t).alias("toxic"))
             for t, some in enumerate(parts)]
    sample = stored(parts[0].unionByName(parts[1]))
    n_docs = {(r["member"], r["toxic"]): r["n"] for r in sample.groupBy("member", "toxic").agg(F.count("*").alias("n")).collect()}
    sides = [m for m in range(members) if (m, 0) in n_docs and (m, 1) in n_docs]
    if not sides:
        return None
    sizes = sample.sparkSession.createDataFrame([(m, n_docs[m, 0], n_docs[m, 1]) for m in sides], "member int, n_unl long, n_pos long")
    rates = map_arrow(sample, _rates, "member int, feature int, unl int, pos int").groupBy("member", "feature").agg(
        F.sum("unl").alias("unl"), F.sum("pos").alias("pos")).where(F.col("pos") >= LEAST_DOCS).join(F.broadcast(sizes), "member")  # a row a member
    p, q = F.col("pos") / F.col("n_pos"), F.col("unl") / F.col("n_unl")
    both = (F.col("pos") + F.col("unl") + 1) / (F.col("n_pos") + F.col("n_unl") + 2)
    z = F.abs(p - q) / F.sqrt(both * (1 - both) * (1 / F.col("n_pos") + 1 / F.col("n_unl")))
    telling = Window.partitionBy("member").orderBy(F.desc("z"), "feature")  # a classifier has at most BUCKETS features
    best = rates.select("member", "feature", z.alias("z")).where(F.col("z") >= LEAST_Z).withColumn("at", F.row_number().over(telling))
    chosen: dict[int, list] = {m: [] for m in sides}
    for r in best.where(F.col("at") <= FEATURES).orderBy("member", "at").select("member", "feature").collect():
        chosen[r["member"]].append(r["feature"])
    chosen = {m: np.asarray(f, np.int64) for m, f in chosen.items()}
    shared = sample.sparkSession.sparkContext.broadcast(chosen)  # at most FEATURES numbers a classifier
    held = map_arrow(sample.where(F.col("member").isin(sides)), _kept_features(shared), "member int, toxic int, held array<int>")
    # more partitions than classifiers, so that two of them seldom meet in one
    trained = map_arrow(held.repartition(8 * members, "member"), _train(shared, prior), "feature int, weight double")
    got = trained.groupBy("feature").agg(F.sum("weight").alias("w")).orderBy("feature").collect()
    f, w = np.asarray([r["feature"] for r in got], np.int64), np.asarray([r["w"] for r in got]) / len(sides)
    return f[1:], w[1:], float(w[0])


def _score(shared, threshold: float):
    def run(batches):
        f, w, b = shared.value
        index = np.full(BUCKETS, -1, np.int32)
        index[f] = np.arange(len(f))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            logit = np.fromiter((b + w[p].sum() for p in _held(texts, index)), np.float64, len(texts))
            score = 0.5 * (1 + np.tanh(0.5 * logit))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                                             ["doc_id", "held_out", "score", "predicted"])
    return run


def held_out(id_col: str = "doc_id") -> Column:
    """The test fold: crc32 of the id as text leaves 1 when divided by 3 (null ids are not in it)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, prior: float | None = None, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", threshold: float = THRESHOLD, members: int = MEMBERS, positives: int = POSITIVES,
             unlabelled: int = UNLABELLED) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted. Learns from rows that are not held out: texts of ids that
    ``labels`` calls toxic, against all texts; ``prior`` is by default the share of toxic ids among the labelled."""
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), text_or_empty(text_col).alias("text"))
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    if prior is None:
        n, toxic = known.agg(F.count("*"), F.count_if(F.col("toxic") == 1)).first()
        prior = toxic / n if n else 0.0
    visible = rows.where(~F.col("held_out")).withColumn("digest", F.xxhash64("text"))
    confirmed = visible.where("text != ''").select("doc_id", "digest").join(known.where("toxic = 1").select("doc_id"), "doc_id", "left_semi").select("digest")
    bound = min(max(prior, 1e-6), 1 - 1e-6)
    model = learn(visible.select("text", "digest"), confirmed, bound, members, positives, unlabelled) if prior > 0 else None
    if model is None:
        model = np.zeros(0, np.int64), np.zeros(0), float(np.log(bound / (1 - bound))) if prior > 0 else -np.inf
    id_type = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most FEATURES weights a classifier
    return map_arrow(rows, _score(shared, threshold), f"doc_id {id_type}, held_out boolean, score double, predicted int")
