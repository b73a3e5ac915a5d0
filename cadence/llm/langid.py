"""Language identification by mixture inference.

Model: per language the probabilities of hashed letter trigrams, learned from a
bounded sample of each language's distinct texts. A document is a mixture of the languages: its
trigrams are drawn from ``sum_k p_k P_k``. Expectation-maximisation estimates the
proportions p; the languages it keeps are chosen by penalised likelihood (BIC over
growing sets of the strongest languages, with the number of trigrams divided by
three, as overlapping trigrams are not independent). The prediction is the language
of the largest share, the score that share.

Null texts and texts without a letter are ``und`` with score 0. Ties between
languages go to the alphabetically first. More than MAX_LANGUAGES languages are an error. Rows with a null language are predicted,
never learned from; if there is nothing to learn from, every row is ``und``. Repeated
rows get equal results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import map_arrow, text_or_empty

#: Trigram classes of the model.
BUCKETS = 1 << 15
#: Bound of the training sample: about so many distinct texts for each language, all if it has fewer.
TRAIN_DOCS = 4000
#: Bound of the languages learned: BUCKETS numbers each.
MAX_LANGUAGES = 1000
PENALTY, EM_STEPS, EM_STOP, OVERLAP = 1.0, 40, 1e-4, 3
UNKNOWN = "und"


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def trigrams(text: str) -> np.ndarray:
    """Bucket of each trigram of the lower-cased letters, other characters being one space."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[code]
    if not letter.any():
        return np.zeros(0, np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    code = np.where(letter, code, np.uint32(32))[keep].astype(np.uint64)
    code = np.concatenate([[np.uint64(32)], code, [np.uint64(32)]])
    mixed = (code[:-2] * np.uint64(0x9E3779B97F4A7C15) + code[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
             + code[2:] * np.uint64(0x165667B19E3779F9))
    return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(49)).astype(np.int64)


def _counts(batches):
    total: dict[str, np.ndarray] = {}
    for b in batches:
        for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
            c = total.setdefault(lang, np.zeros(BUCKETS, np.int64))
            c += np.bincount(trigrams(text), minlength=BUCKETS)
    for lang, c in total.items():
        at = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(c[at])],
                                         ["lang", "bucket", "n"])


def learn(labelled: DataFrame, train_docs: int = TRAIN_DOCS) -> tuple[list[str], np.ndarray]:
    """Languages and their log probabilities, from ``labelled`` (text, lang).

    Every language that has a text with a letter is learned. Of each about ``train_docs``
    distinct texts are taken (all, if it has fewer), by a hash of the text at a rate from
    the number of distinct ones; their whole texts count once. To the driver go at most
    BUCKETS counts a language."""
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "text", F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("digest"))
    have = {r["lang"]: r["n"] for r in labelled.groupBy("lang", "digest").agg(F.lit(1).alias("x")).groupBy("lang").agg(F.count("x").alias("n")).collect()}
    langs = sorted(have)
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"{len(langs)} language values; a model of at most {MAX_LANGUAGES} fits the driver")
    if not langs:
        return [], np.zeros((0, BUCKETS))
    rates = labelled.sparkSession.createDataFrame([(k, min(1.0, train_docs / have[k])) for k in langs], "lang string, rate double")
    unit = F.shiftrightunsigned("digest", 11) / float(1 << 53)
    sample = labelled.join(F.broadcast(rates), "lang").where(unit < F.col("rate")).select("text", "lang").distinct()  # a row a language
    counted = map_arrow(sample, _counts, "lang string, bucket int, n bigint")
    at = {k: i for i, k in enumerate(langs)}
    m = np.zeros((len(langs), BUCKETS))
    for r in counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect():
        m[at[r["lang"]], r["bucket"]] = r["n"]
    langs, m = [k for k, x in zip(langs, m) if x.any()], m[m.any(axis=1)]
    base = m.sum(axis=0) + 0.5  # smoothing towards what all languages have together
    m += 50.0 * base / base.sum()
    return langs, np.log(m / m.sum(axis=1, keepdims=True)) if langs else m


def mixture(p: np.ndarray, c: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions after EM, and the log-likelihood, for classes of probabilities ``p`` seen ``c`` times."""
    n = c.sum()
    for _ in range(EM_STEPS):
        new = share * (p.T @ (c / (p @ share))) / n
        moved = np.abs(new - share).max()
        share = new
        if moved < EM_STOP:
            break
    return share, float(c @ np.log(p @ share))


def infer(log_p: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """The proportions of all languages, zero for those that the penalty leaves out."""
    k = len(log_p)
    c = np.bincount(grams, minlength=BUCKETS)
    at = np.flatnonzero(c)
    c = c[at].astype(np.float64)
    lp = log_p[:, at].T
    p = np.exp(lp - lp.max(axis=1, keepdims=True))
    share, most = mixture(p, c, np.full(k, 1 / k))
    order = np.argsort(-share, kind="stable")
    best, best_cost = None, np.inf
    penalty = PENALTY * np.log(max(c.sum() / OVERLAP, 2.0))
    for m in range(1, k + 1):
        chosen = order[:m]
        # no set is likelier than all languages together, so from here on the penalty outweighs any gain
        if m > 1 and (share[chosen[-1]] <= 0 or -2 * most / OVERLAP + penalty * (m - 1) >= best_cost):
            break
        part, ll = (np.ones(1), float(c @ np.log(np.maximum(p[:, chosen[0]], 1e-300)))) if m == 1 else \
            mixture(p[:, chosen], c, share[chosen] / share[chosen].sum())
        cost = -2 * ll / OVERLAP + penalty * (m - 1)
        if cost < best_cost:
            best, best_cost = np.zeros(k), cost
            best[chosen] = part
    return best


def _predict(model):
    def run(batches):
        langs, log_p = model.value
        for b in batches:
            pred, score, n_langs = [], [], []
            for text in b.column("text").to_pylist():
                g = trigrams(text) if langs else ()
                if not len(g):
                    got = (UNKNOWN, 0.0, 0)
                else:
                    share = infer(log_p, g)
                    got = (langs[int(share.argmax())], float(min(1.0, share.max())), int((share > 0).sum()))
                for to, x in zip((pred, score, n_langs), got):
                    to.append(x)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(b.num_columns - 1)], pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                 pa.array(n_langs, pa.int32())],
                [*b.schema.names[:-1], "lang_pred", "score", "n_langs"])
    return run


def held_out(id_col: str = "doc_id") -> Column:
    """The test fold: crc32 of the id as text leaves 2 when divided by 4 (null ids are not in it)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, learn_from: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", train_docs: int = TRAIN_DOCS) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, n_langs. Learns from rows where
    ``learn_from`` holds (by default: those not held out) and the language is known."""
    use = ~held_out(id_col) if learn_from is None else learn_from
    model = learn(docs.where(use).select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang")), train_docs)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), text_or_empty(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers a language
    return map_arrow(rows, _predict(shared), f"doc_id {id_type}, held_out boolean, lang_pred string, score double, n_langs int")


def _prevailing(model, column: int, least: float):
    def run(batches):
        langs, log_p = model.value
        for b in batches:
            ok = []
            for text in b.column(column).to_pylist():
                g = trigrams(text or "") if langs else ()
                ok.append(bool(len(g)) and float(infer(log_p, g).max()) >= least)
            yield b.filter(pa.array(ok, pa.bool_()))
    return run


def prevailing(docs: DataFrame, least: float = 0.5, text_col: str = "text", lang_col: str = "lang",
               train_docs: int = TRAIN_DOCS) -> DataFrame:
    """The rows of ``docs`` with a language that has at least the share ``least``, all columns as they
    are. Learns from all labelled rows; if there are none, only rows without a letter go."""
    model = learn(docs.select(docs[text_col].cast("string").alias("text"), docs[lang_col].alias("lang")), train_docs)
    if not model[0]:
        return docs.where(docs[text_col].rlike(r"\p{L}"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_arrow(docs, _prevailing(shared, docs.columns.index(text_col), least), docs.schema)
