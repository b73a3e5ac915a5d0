"""Token counts: huge documents are encoded in overlapping chunks that are spliced.

A document longer than ``chunk_chars`` becomes chunks that each reach ``overlap``
characters into the next one; chunks are dealt over the cluster, so no task encodes a
huge document alone. Each chunk is encoded with offsets. Neighbours are spliced at a
boundary that both encodings have and that is proven stable: a token start right
after white space, with that white space inside both chunks (normaliser, split
pattern and special strings never reach across white space). Where the overlap of
some junction has no such boundary, or the two encodings disagree between their
first and last common boundary, the documents concerned are encoded again with an
overlap twice as wide, in the end as one chunk.

Nulls and empty texts have 0 tokens. Repeated rows and ids are counted row by row.
The only input columns used are the id and the text; others may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm import wordbpe
from cadence.llm.common import map_arrow, stored, text_or_empty

CHUNK_CHARS = 32_768
OVERLAP = 512
_SPACES = np.zeros(128, bool)
_SPACES[[9, 10, 13, 32]] = True


def _count_whole(path: str):
    def run(batches):
        enc = wordbpe.load(path)
        for b in batches:
            n = [len(enc.ids(t)) // 4 for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), pa.array(n, pa.int64())],
                                             ["doc_id", "n_bytes", "n_tokens"])
    return run


def _cut(chunk: int, overlap: int):
    """Rows of one chunk each; a generator, so that a huge text is never held in pieces all at once."""
    def run(batches):
        for b in batches:
            for key, text in zip(b.column("key").to_pylist(), b.column("text").to_pylist()):
                n, i, at = len(text), 0, 0
                while True:
                    end = min(n, at + chunk + overlap)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key]), pa.array([i], pa.int64()), pa.array([at], pa.int64()),
                         pa.array([end == n]), pa.array([text[at:end]])],
                        ["key", "chunk", "start", "last", "text"])
                    if end == n:
                        break
                    i, at = i + 1, at + chunk
    return run


def stable_boundaries(text: str, at: np.ndarray, before: np.ndarray, lo: int, hi: int) -> list[dict]:
    """Token starts in ``[lo, hi)`` right after white space, with the tokens before each."""
    codes = np.frombuffer(text[:hi].encode("utf-32-le", "surrogatepass"), np.uint32)
    at_ok = (at > max(lo, 0)) & (at < hi)
    p, b = at[at_ok], before[at_ok]
    prev = codes[p - 1] if len(p) else np.zeros(0, np.uint32)
    ok = (prev < 128) & _SPACES[np.minimum(prev, 127)]
    first = np.ones(len(p), bool)
    first[1:] = p[1:] != p[:-1]
    ok &= first
    return [{"p": int(x), "b": int(y)} for x, y in zip(p[ok], b[ok])]


_EDGE = pa.list_(pa.struct([("p", pa.int64()), ("b", pa.int64())]))


def _encode_chunks(path: str, overlap: int):
    def run(batches):
        enc = wordbpe.load(path)
        for b in batches:
            cols: dict[str, list] = {k: [] for k in ("n", "head", "tail")}
            for text, start, first, last in zip(b.column("text").to_pylist(), b.column("start").to_pylist(),
                                                b.column("chunk").to_pylist(), b.column("last").to_pylist()):
                total = len(enc.ids(text)) // 4
                at, before = enc.starts(text)
                edge = lambda lo, hi: [{"p": x["p"] + start, "b": x["b"]}
                                       for x in stable_boundaries(text, at, before, lo, hi)]
                cols["n"].append(total)
                cols["head"].append([] if first == 0 else edge(0, overlap))
                cols["tail"].append([] if last else edge(len(text) - overlap, len(text)))
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), b.column("chunk"), b.column("last"), pa.array(cols["n"], pa.int64()),
                 pa.array(cols["head"], _EDGE), pa.array(cols["tail"], _EDGE)],
                ["key", "chunk", "last", "n", "head", "tail"])
    return run


def splice(chunks: DataFrame) -> DataFrame:
    """Per key ``n_tokens`` and whether every junction was spliced (``ok``).

    A junction's two sides are two rows; their common boundaries are ``c``. The
    document has the sum of its chunks, less what left and right count twice."""
    one = chunks.groupBy("key", "chunk").agg(*[F.first(c).alias(c) for c in ("last", "n", "head", "tail")])
    sides = one.select("key", F.explode(F.array(
        F.struct(F.col("chunk").alias("j"), F.col("tail").alias("l"), F.lit(None).cast(_edge_sql()).alias("r"),
                 F.col("n").alias("n"), (~F.col("last")).alias("joins")),
        F.struct((F.col("chunk") - 1).alias("j"), F.lit(None).cast(_edge_sql()).alias("l"), F.col("head").alias("r"),
                 F.lit(0).cast("long").alias("n"), (F.col("chunk") > 0).alias("joins")))).alias("s")).select("key", "s.*")
    j = sides.groupBy("key", "j").agg(F.first("l", ignorenulls=True).alias("l"), F.first("r", ignorenulls=True).alias("r"),
                                      F.sum("n").alias("n"), F.max("joins").alias("joins"))
    common = F.array_intersect(F.col("l.p"), F.col("r.p"))
    at = lambda side, p: F.get(F.filter(side, lambda x: x["p"] == p), F.lit(0))["b"]
    j = j.withColumn("c", common).withColumn("lo", F.array_min("c")).withColumn("hi", F.array_max("c"))
    j = j.select("key", "n", "joins", *[at(F.col(s), F.col(e)).alias(s + e) for s in ("l", "r") for e in ("lo", "hi")])
    agree = F.col("llo").isNotNull() & (F.col("lhi") - F.col("llo") == F.col("rhi") - F.col("rlo"))
    twice = F.when(F.col("joins"), F.col("n") - F.col("llo") + F.col("rlo")).otherwise(0)
    return j.groupBy("key").agg((F.sum("n") - F.sum(twice)).alias("n_tokens"),
                                F.min(~F.col("joins") | F.coalesce(agree, F.lit(False))).alias("ok"))


def _edge_sql() -> str:
    return "array<struct<p:bigint,b:bigint>>"


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048, chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit (``n_tokens > limit``)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    long_ = F.char_length("text") > chunk_chars
    id_type = rows.schema["doc_id"].dataType.simpleString()
    out = map_arrow(rows.where(~long_), _count_whole(path), f"doc_id {id_type}, n_bytes bigint, n_tokens bigint")
    huge = rows.where(long_).withColumn("key", F.sha2("text", 256))
    done = None
    todo, wide = huge.select("key", "text"), overlap
    while todo is not None:
        chunk = max(chunk_chars, wide)
        cut = map_arrow(todo, _cut(chunk, wide), "key string, chunk bigint, start bigint, last boolean, text string")
        enc = map_arrow(cut.repartition("key", "chunk"), _encode_chunks(path, wide),
                        f"key string, chunk bigint, last boolean, n bigint, head {_edge_sql()}, tail {_edge_sql()}")
        got = stored(splice(enc))
        good = got.where("ok").select("key", "n_tokens")
        done = good if done is None else done.unionByName(good)
        bad = got.where("not ok").select("key")
        if bad.isEmpty():
            todo = None
        else:  # a chunk as long as the text has no junction, so this ends
            todo, wide = huge.join(bad, "key", "left_semi").select("key", "text"), wide * 2
    out = out.unionByName(huge.select("doc_id", "n_bytes", "key").join(done, "key").select("doc_id", "n_bytes", "n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
