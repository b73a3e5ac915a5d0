"""Near-duplicate groups by DartMinHash signatures.

Each element (a hashed shingle) with weight w owns the region [0, w) x [0, inf). A
Poisson process of rate one, driven by hashes of the element alone, throws darts into
it: unit cell by unit cell of the weight axis, the ranks of a cell's darts being sums
of hashed exponential gaps. A document looks at all darts of its elements up to a rank
threshold that gives about ``k ln k + 2k`` of them (doubled while some coordinate has
none), assigns each to one of k coordinates by a hash, and keeps the earliest dart of
each. Two documents agree in a coordinate with the probability of their weighted
Jaccard similarity.

Banded joining: documents with equal words are one class first (a hot group of copies
becomes one row by partial aggregation). Classes sharing a band meet in a bucket,
where every class is compared with the bucket's hub - the member with most company
over all its buckets - and not with everyone. Candidates are verified by the exact
Jaccard similarity of their shingle sets; a hub's text is dealt in salted copies, so a
hub of very many members is no hot key. After the components of these links, members
of one hub that still are in different components are compared where the hub's set
does not rule it out (see ``_unmet``), so no candidate pair between different groups
stays unchecked, and a large group of copies does not make all its pairs.

Null and empty texts and texts without words have no shingles: each row is a class of
its own, and kept. A text of one to four words has one shingle, all its words.
Repeated rows are copies of each other. The class id is the least doc_id of the group
(null only if the group has no other); ties between rows with that id go to the first
by text digest. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm import wordhash
from cadence.llm.common import map_arrow, slices, stored, text_or_empty
from cadence.llm.components import components
from cadence.llm.wordhash import U, mix

SHINGLE, SIMILARITY = 5, 0.8
#: 24 bands of 6 find a pair of similarity 0.8 with probability 0.9993, of 0.85 with 0.99999.
BANDS, ROWS = 24, 6
#: Members a salted copy of a hub's text is compared with.
HUB_SHARE = 128
SLICE_CHARS = 1 << 20


def _gaps(h: np.ndarray) -> np.ndarray:
    """Exponential variates from hashes."""
    return -np.log(((h >> U(11)).astype(np.float64) + 1.0) * 2.0 ** -53)


def darts(elements: np.ndarray, weights: np.ndarray | None, upto: float) -> tuple[np.ndarray, np.ndarray]:
    """Rank and id of every dart of rank below ``upto`` in the elements' regions."""
    if weights is None:
        cell, room = elements, None
    else:
        n = np.ceil(weights).astype(np.int64)
        no = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        cell = np.repeat(elements, n) + no.astype(U) * U(0xA0761D6478BD642F)
        room = np.repeat(weights, n) - no
    at, ranks, ids, step, block = np.zeros(len(cell)), [], [], 0, 1
    while len(cell):
        h = mix(cell[:, None] + (np.arange(step, step + block, dtype=U) + U(1)) * wordhash.BASE)
        t = at[:, None] + np.cumsum(_gaps(h), axis=1)
        hit = t < upto
        if room is not None:  # a dart beyond the weight in its cell misses
            ok = hit & (((mix(h ^ U(0xE7037ED1A0B428DB)) >> U(11)).astype(np.float64) * 2.0 ** -53) < room[:, None])
        else:
            ok = hit
        ranks.append(t[ok])
        ids.append(h[ok])
        more = hit[:, -1]
        cell, at, room = cell[more], t[more, -1], None if room is None else room[more]
        step, block = step + block, min(1 << 16, int(upto + 3 * upto ** 0.5) + 3)
    return np.concatenate(ranks) if ranks else np.zeros(0), np.concatenate(ids) if ids else np.zeros(0, U)


def signature(elements: np.ndarray, weights: np.ndarray | None, k: int) -> np.ndarray:
    """k dart ids, the earliest of each coordinate."""
    total = float(len(elements) if weights is None else weights.sum())
    upto = (k * np.log(k) + 2 * k) / total
    while True:
        rank, ids = darts(elements, weights, upto)
        coord = (mix(ids + U(0x8EBC6AF09C88C6E3)) % U(k)).astype(np.int64)
        order = np.argsort(-rank, kind="stable")
        sig = np.zeros(k, U)
        got = np.zeros(k, bool)
        sig[coord[order]] = ids[order]
        got[coord] = True
        if got.all():
            return sig
        upto *= 2


def bands_of(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    s = sig.reshape(bands, rows)
    h = np.arange(1, bands + 1, dtype=U) * U(0x589965CC75374CC3)
    for i in range(rows):
        h = mix(h * wordhash.BASE + s[:, i])
    return h.view(np.int64)


def _sign(bands: int, rows: int, size: int):
    def run(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            key, count, band = [], [], []
            for lo, hi in slices(texts, SLICE_CHARS):
                hashes, first = wordhash.words(texts[lo:hi])
                for a, z in zip(first[:-1], first[1:]):
                    w = hashes[a:z]
                    el = wordhash.shingles(w, size)
                    pos = np.arange(1, len(w) + 1, dtype=U)  # equal words in equal order have equal keys
                    key.append(np.asarray([mix(w + pos * wordhash.BASE).sum(dtype=U), mix(w * pos + U(11)).sum(dtype=U)]).tobytes())
                    count.append(len(el))
                    band.append(bands_of(signature(el, None, bands * rows), bands, rows) if len(el) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("digest"), pa.array(key, pa.binary()), pa.array(count, pa.int64()),
                 pa.array(band, pa.list_(pa.int64()))], ["doc_id", "digest", "key", "n", "bands"])
    return run


def _sets(batch: pa.RecordBatch, size: int, last: list):
    """Row by row the shingle sets of hub and member; rows of one hub come together."""
    for hub, ht, mt in zip(batch.column("hub").to_pylist(), batch.column("hub_text").to_pylist(), batch.column("text").to_pylist()):
        if not last or last[0] != hub:
            last[:] = [hub, wordhash.shingles(wordhash.words([ht])[0], size)]
        yield last[1], wordhash.shingles(wordhash.words([mt])[0], size)


def _overlap(size: int):
    def run(batches):
        last: list = []
        for b in batches:
            n = [(len(np.intersect1d(h, m, assume_unique=True)), len(h), len(m)) for h, m in _sets(b, size, last)]
            c = np.asarray(n, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([b.column("hub"), b.column("member"), *[pa.array(c[:, i]) for i in range(3)]],
                                             ["hub", "member", "shared", "hub_n", "n"])
    return run


def _novel(size: int, least: float):
    """The member's shingles that its hub lacks, their number, and how many of the rarest of
    them the prefix principle asks for: whoever is similar has one of these."""
    def run(batches):
        last: list = []
        for b in batches:
            at, out, many, asked = [], [], [], []
            for i, (h, m) in enumerate(_sets(b, size, last)):
                new = np.setdiff1d(m, h, assume_unique=True)
                must = max(1, int(np.ceil(least * len(m) - (len(m) - len(new)) - 1e-9)))
                if len(new) >= must:
                    at.append(np.full(len(new), i))
                    out.append(new)
                    many.append(np.full(len(new), len(new)))
                    asked.append(np.full(len(new), len(new) - must + 1))
            c = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (at, many, asked)]
            rows = pa.array(c[0])
            yield pa.RecordBatch.from_arrays([b.column("hub").take(rows), b.column("member").take(rows),
                                              pa.array((np.concatenate(out) if out else np.zeros(0, U)).view(np.int64)), pa.array(c[1]), pa.array(c[2])],
                                             ["hub", "member", "shingle", "many", "asked"])
    return run


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``(hub, member, hub_text, text)`` for stored distinct pairs, a hub's text in salted copies."""
    salts = stored(pairs.groupBy("hub").agg(F.ceil(F.count("*") / HUB_SHARE).cast("int").alias("salts")))
    hubs = salts.join(texts.withColumnsRenamed({"key": "hub", "text": "hub_text"}), "hub").select(
        "hub", "hub_text", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    dealt = pairs.join(salts, "hub").select("hub", "member", F.pmod(F.xxhash64("member"), F.col("salts")).cast("int").alias("salt"))
    whole = dealt.join(texts.withColumnRenamed("key", "member"), "member").join(hubs, ["hub", "salt"])
    return whole.select("hub", "member", "hub_text", "text")


def _measured(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """Sizes and overlap of the distinct pairs' shingle sets; written."""
    both = _with_texts(stored(pairs.distinct()), texts)
    return stored(map_arrow(both, _overlap(size), "hub binary, member binary, shared bigint, hub_n bigint, n bigint"))


def _similar(measured: DataFrame, least: float) -> DataFrame:
    union = F.col("hub_n") + F.col("n") - F.col("shared")
    return measured.where(F.col("shared") >= F.lit(least) * union - 1e-9).select(F.col("hub").alias("a"), F.col("member").alias("b"))


def _unmet(measured: DataFrame, group: DataFrame, texts: DataFrame, size: int, least: float) -> DataFrame | None:
    """Pairs of one hub's members in different components that may still be similar.

    With H the hub's set, two members share at most ``min(|u & H|, |v & H|)`` shingles of
    H. Either that is enough by itself, which takes a v smaller than H if u is not similar
    to H. Or they share shingles that H lacks, and then, by the prefix principle, one of the
    rarest of these. What a copy has changed in its own way is rarest and meets nobody, so
    copies that each differ from the hub by themselves make no pairs."""
    own = measured.groupBy("hub").agg(F.first("hub_n").alias("n")).select("hub", F.col("hub").alias("member"), F.col("n").alias("shared"), "n")
    every = measured.select("hub", "member", "shared", "n").unionByName(own)
    every = every.join(group, F.col("member") == F.col("node"), "left").select("hub", "member", "shared", "n", F.coalesce("root", "member").alias("root"))
    split = every.groupBy("hub").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size"))
    split = split.where("lo != hi and size > 2").select("hub")  # of two, both were compared
    every = stored(every.join(stored(split), "hub"))
    if every.isEmpty():
        return None
    others = every.where("hub != member")
    novel = stored(map_arrow(_with_texts(stored(others.select("hub", "member")), texts), _novel(size, least),
                             "hub binary, member binary, shingle bigint, many bigint, asked bigint"))
    often = novel.groupBy("hub", "shingle").agg(F.count("*").alias("often")).where("often > 1")
    novel = novel.join(stored(often), ["hub", "shingle"])
    # the member's shingles by rarity; those that nobody else has come first and are not in the table any more
    own_first = Window.partitionBy("hub", "member")
    rank = F.row_number().over(own_first.orderBy("often", "shingle")) + F.col("many") - F.count("*").over(own_first)
    novel = novel.withColumn("rank", rank).where("rank <= asked").withColumn("after", F.col("many") - F.col("rank"))
    novel = stored(novel.join(others.select("hub", "member", "shared", "n", "root"), ["hub", "member"]))
    at = novel.groupBy("hub", "shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("hub", "shingle")
    novel = stored(novel.join(stored(at), ["hub", "shingle"]))
    ratio = F.least("a.n", "b.n") >= F.lit(least) * F.greatest("a.n", "b.n")
    # if this is the first shingle that both have and the hub lacks, so many can follow at most
    most = F.least("a.shared", "b.shared") + 1 + F.least("a.after", "b.after")
    enough = most * (1 + least) + 1e-9 >= F.lit(least) * (F.col("a.n") + F.col("b.n"))
    pairs = novel.alias("a").join(novel.alias("b"), ["hub", "shingle"]).where(F.col("a.root") < F.col("b.root")).where(ratio & enough).select(
        F.col("a.member").alias("hub"), F.col("b.member").alias("member"))
    # what members of H alone can do: v has at most ``most`` shingles
    most = F.floor(F.col("shared") * (1 + least) / least - F.col("n") + 1e-9)
    u = others.withColumn("most", most).where(F.col("most") >= F.lit(least) * F.col("n"))
    reach = u.groupBy("hub").agg(F.max("most").alias("reach"))
    v = others.join(stored(reach), "hub").where(F.col("n") <= F.col("reach"))
    core = u.alias("a").join(v.alias("b"), "hub").where(
        (F.col("a.root") != F.col("b.root")) & (F.col("b.n") <= F.col("a.most")) & ratio
        & (F.col("b.shared") * (1 + least) + 1e-9 >= F.lit(least) * (F.col("a.n") + F.col("b.n")))).select(
        F.least("a.member", "b.member").alias("hub"), F.greatest("a.member", "b.member").alias("member"))
    return pairs.unionByName(core)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
                    shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per row: doc_id, digest (SHA-256 of the text), class_id, kept.

    Rows of one group have one class_id; exactly one ``(doc_id, digest)`` of a group is kept."""
    base = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("digest", F.sha2("text", 256))
    id_type = base.schema["doc_id"].dataType.simpleString()
    signed = stored(map_arrow(base, _sign(bands, rows, shingle), f"doc_id {id_type}, digest string, key binary, n bigint, bands array<bigint>"))
    has = signed.where("n > 0")
    classes = stored(has.groupBy("key").agg(F.first("bands").alias("bands"),
                                            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("r")).select(
        "key", "bands", F.col("r.doc_id").alias("rep_id"), F.col("r.digest").alias("rep_digest")))
    each = classes.select("key", F.explode("bands").alias("band"))
    shared = each.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    met = stored(each.join(shared, "band"))
    central = met.groupBy("key").agg(F.sum("size").alias("company"))
    met = met.join(central, "key")
    hubs = stored(met.groupBy("band").agg(F.max(F.struct("company", "key")).alias("h")).select("band", F.col("h.key").alias("hub")))
    first = met.join(hubs, "band").where(F.col("key") != F.col("hub")).select("hub", F.col("key").alias("member"))
    need = classes.join(met.select("key").distinct(), "key", "left_semi").select("key", F.col("rep_id").alias("doc_id"), F.col("rep_digest").alias("digest"))
    texts = base.join(need, base["doc_id"].eqNullSafe(need["doc_id"]) & (base["digest"] == need["digest"])).select("key", "text")
    texts = stored(texts.groupBy("key").agg(F.first("text").alias("text")))
    measured = _measured(first, texts, shingle)
    links = _similar(measured, similarity)
    group = stored(components(links))
    rest = _unmet(measured, group, texts, shingle, similarity)
    if rest is not None:
        more = stored(_similar(_measured(rest, texts, shingle), similarity))
        if not more.isEmpty():
            group = stored(components(group.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)))
    return _result(signed, has, classes, group)


def _result(signed: DataFrame, has: DataFrame, classes: DataFrame, group: DataFrame) -> DataFrame:
    rooted = classes.join(group, F.col("key") == F.col("node"), "left").select("key", "rep_id", "rep_digest", F.coalesce("root", "key").alias("root"))
    best = rooted.groupBy("root").agg(F.min(F.struct(F.col("rep_id").isNull(), "rep_id", "rep_digest")).alias("r"))
    named = stored(rooted.select("key", "root").join(best, "root").select("key", F.col("r.rep_id").alias("class_id"), F.col("r.rep_digest").alias("keep")))
    out = has.select("doc_id", "digest", "key").join(named, "key").select(
        "doc_id", "digest", "class_id", (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("digest") == F.col("keep"))).alias("kept"))
    return out.unionByName(signed.where("n = 0").select("doc_id", "digest", F.col("doc_id").alias("class_id"), F.lit(True).alias("kept")))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that are kept, one for each group, all columns as they are. Of
    rows equal in id and text one is kept, unless the text has no words."""
    def row_key(id_, digest):
        return F.concat_ws("|", F.coalesce(id_.cast("string"), F.lit("")), id_.isNull().cast("string"), digest)

    kept = near_duplicates(docs, id_col, text_col, **how).where("kept")
    kept = stored(kept.select(row_key(F.col("doc_id"), F.col("digest")).alias("__row")).distinct())
    text = text_or_empty(text_col)
    has_words = F.lower(text).rlike(r"[a-z0-9\x{80}-\x{10ffff}]")
    marked = docs.withColumns({"__row": row_key(F.col(id_col), F.sha2(text, 256)),
                               "__own": F.when(~has_words, F.monotonically_increasing_id())})
    return marked.join(kept, "__row").dropDuplicates(["__row", "__own"]).select(*docs.columns)
