"""Secret scan with corpus-wide ownership frequency.

One pass finds the candidate values of every text. Their hashes are then aggregated
over the corpus by distinct repositories and owners: a value that several owners hold is a widely
copied example; one that a single owner holds looks like that owner's live credential, in
however many of its repositories it stands, and so does one of which nearly all repositories are
one owner's. A caller may bound the repositories too; a text that occurs in several of them then counts once. Only hashes, never values, leave
the scan.

Kinds: ``assign``, ``access`` and ``hex`` are given patterns and always reported.
``opaque`` candidates (long mixed tokens outside the others' spans) are reported only
where ownership says live. A hash held by a third of the corpus is counted by partial
aggregation first, per (hash, owner, repository), and per (hash, text) where repositories are bounded; the join that brings the
verdicts back is an equi-join that Spark may split on skew.

Null texts are empty and have no spans. A null repository or owner counts as one
unknown repository or owner. Repeated rows and ids keep a row each (rows are numbered
in the scan); ties do not matter, as spans are ordered by start and kind. An empty
table gives no rows. Columns other than the four named ones are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import map_arrow, stored, text_or_empty

# The given patterns, letters of the key words in either case.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX_RUN = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "opaque")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
#: An opaque candidate: this long, with a digit and letters of both cases.
OPAQUE = re.compile(r"[A-Za-z0-9+/_-]{24,}")
MAX_OWNERS = 1
#: Or one owner's share of the repositories that hold a value, from which on it is that owner's own.
OWNER_SHARE = 0.9


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """``(start, kind number, end, value)`` of the given kinds, by start, then kind."""
    out = []
    if ":" in text or "=" in text:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= MIN_ASSIGN:
                out.append((m.start(), 0, m.end(), m.group(2)))
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.group()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    # runs are maximal either way, so asking for 24 at once drops just the failing ones
    out += [(m.start(), 2, m.end(), m.group()) for m in HEX_RUN.finditer(text)]
    return sorted(out)


def opaque_spans(text: str, base: list[tuple]) -> list[tuple[int, int, int, str]]:
    out = []
    for m in OPAQUE.finditer(text):
        v = m.group()
        if any(c.isdigit() for c in v) and v.lower() != v and v.upper() != v \
                and not any(s < m.end() and m.start() < e for s, _, e, _ in base):
            out.append((m.start(), 3, m.end(), v))
    return out


_FOUND = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("value", pa.string())]))
_FOUND_SQL = "array<struct<start:bigint,kind:int,end:bigint,value:string>>"


def _scan(batches):
    part, at = TaskContext.get().partitionId(), 0
    for b in batches:
        found, digest, whole = [], [], []
        for text in b.column("text").to_pylist():
            base = base_spans(text)
            digest.append(hashlib.sha256(join_spans(base).encode()).hexdigest())
            found.append([{"start": s, "kind": k, "end": e, "value": hashlib.sha256(v.encode()).hexdigest()}
                          for s, k, e, v in sorted(base + opaque_spans(text, base))])
            whole.append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest() if found[-1] else None)
        n = b.num_rows
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("repo"), b.column("owner"), pa.array([part] * n, pa.int32()),
             pa.array(range(at, at + n), pa.int64()), pa.array(digest, pa.string()), pa.array(whole, pa.string()), pa.array(found, _FOUND)],
            ["doc_id", "repo", "owner", "part", "row", "base_sha256", "text_sha256", "found"])
        at += n


def join_spans(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in spans)


def _of_kind(i: int):
    return lambda span: span["kind"] == i


def live_values(found: DataFrame, max_owners: int, max_repos: int | None, owner_share: float = OWNER_SHARE) -> DataFrame:
    """Per value hash: ``n_owners`` and ``n_repos``, the distinct owners and repositories that hold it, and ``live``:
    whether it is some owner's own. That is so where few enough owners hold it, or where one owner's repositories are
    at least ``owner_share`` of all that do. With ``max_repos`` there must be few repositories too (copies of a text count once)."""
    once = found.groupBy("value", "owner", "repo").agg(F.lit(1).alias("x"))
    own = once.groupBy("value", "owner").agg(F.count("x").alias("n"))
    held = own.groupBy("value").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_repos"), F.max("n").alias("most"))
    live = (F.col("n_owners") <= max_owners) | (F.col("most") >= F.lit(owner_share) * F.col("n_repos"))
    held = held.select("value", "n_owners", "n_repos", live.alias("live"))
    if max_repos is None:
        return held
    texts = found.groupBy("value", "text_sha256").agg(F.min("repo").alias("repo")).groupBy("value", "repo").agg(F.lit(1).alias("x"))
    few = texts.groupBy("value").agg((F.count("x") <= max_repos).alias("few"))
    return held.join(few, "value").withColumn("live", F.col("live") & F.col("few")).drop("few")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id",
         owner_col: str = "source", max_owners: int = MAX_OWNERS, max_repos: int | None = None,
         owner_share: float = OWNER_SHARE) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied, n_owners, n_repos.

    ``n_live`` counts the spans whose value is an owner's own (:func:`live_values`), ``n_copied`` the
    others; ``n_owners`` and ``n_repos`` are those of the most widely held value reported (0 without any)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(repo_col).cast("string").alias("repo"),
                       F.col(owner_col).cast("string").alias("owner"), text_or_empty(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    scanned = stored(map_arrow(rows, _scan, f"doc_id {id_type}, repo string, owner string, part int, row bigint, "
                                            f"base_sha256 string, text_sha256 string, found {_FOUND_SQL}"))
    held = ["part", "row", "repo", "owner", "text_sha256"]
    each = scanned.select(*held, F.explode("found").alias("f")).select(*held, "f.*")
    live = live_values(each, max_owners, max_repos, owner_share)
    judged = each.join(live, "value").where(F.col("live") | (F.col("kind") < 3)).groupBy("part", "row").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end", "live"))).alias("s"),  # one document's spans
        F.max("n_owners").alias("n_owners"), F.max("n_repos").alias("n_repos"))
    text = F.array_join(F.transform("s", lambda x: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")
    out = scanned.join(judged, ["part", "row"], "left")
    count = lambda cond: F.coalesce(F.size(F.filter("s", cond)), F.lit(0)).cast("long")
    zero = F.coalesce(F.col("s"), F.array().cast("array<struct<start:bigint,kind:int,end:bigint,live:boolean>>"))
    return out.withColumn("s", zero).select(
        "doc_id", *[count(_of_kind(i)).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])],
        "base_sha256", text.alias("spans"), count(lambda x: x["live"]).alias("n_live"),
        count(lambda x: ~x["live"]).alias("n_copied"), *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_owners", "n_repos")])


REDACTED = "[redacted]"


def _redact(text_at: int, spans_at: int, chars_at: int | None):
    def run(batches):
        for b in batches:
            cols = list(b.columns)
            texts = b.column(text_at).to_pylist()
            for i, spans in enumerate(b.column(spans_at).to_pylist()):
                if spans:
                    out, at = [], 0
                    for s in spans:
                        if s["end"] > at:
                            out += [texts[i][at:max(at, s["start"])], REDACTED]
                            at = s["end"]
                    texts[i] = "".join(out) + texts[i][at:]
            cols[text_at] = pa.array(texts, pa.string())
            if chars_at is not None:
                cols[chars_at] = pa.array([None if t is None else len(t) for t in texts], b.column(chars_at).type)
            keep = [i for i in range(b.num_columns) if i != spans_at]
            yield pa.RecordBatch.from_arrays([cols[i] for i in keep], [b.schema.names[i] for i in keep])
    return run


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", chars_col: str = "n_chars",
           max_owners: int = MAX_OWNERS, max_repos: int | None = None, owner_share: float = OWNER_SHARE) -> DataFrame:
    """``docs`` with every live-looking span replaced, all columns else as they are (``chars_col``,
    where there is one, follows the text). Rows meet their spans by the text's digest, as
    equal texts have equal spans and values."""
    rows = docs.select(F.sha2(text_or_empty(text_col), 256).alias("doc_id"), F.col(id_col).cast("string").alias("repo"),
                       F.col(owner_col).cast("string").alias("owner"), text_or_empty(text_col).alias("text"))
    found = map_arrow(rows, _scan, f"doc_id string, repo string, owner string, part int, row bigint, base_sha256 string, text_sha256 string, found {_FOUND_SQL}")
    held = ["doc_id", "repo", "owner", "text_sha256"]
    each = stored(found.where(F.size("found") > 0)).select(*held, F.explode("found").alias("f")).select(*held, "f.*")
    live = live_values(each, max_owners, max_repos, owner_share).where("live").select("value")
    spans = each.select("doc_id", "start", "end", "value").distinct().join(live, "value").groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__spans"))
    marked = docs.withColumn("__digest", F.sha2(text_or_empty(text_col), 256))
    joined = marked.join(stored(spans).withColumnRenamed("doc_id", "__digest"), "__digest", "left").select(*docs.columns, "__spans")
    chars = docs.columns.index(chars_col) if chars_col in docs.columns else None
    return map_arrow(joined, _redact(docs.columns.index(text_col), len(docs.columns), chars), docs.schema)
