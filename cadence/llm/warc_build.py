"""WARC derivatives: metadata and plain-text conversion records linked to responses.

Every response record gives one ``metadata`` and one ``conversion`` record. Record ids
are UUIDs derived from the parent's id and the record type, so a retried task writes
the same record; ``WARC-Refers-To`` carries the response's id; the target URI, the date and the
payload digest are taken over from the response's header, block digests are made new. In
the WARC bytes a derived record's ``WARC-Payload-Digest`` is that of its own block, which
a reader can verify, and the response's is its ``Source-Payload-Digest``. The conversion's
text is decoded by the transfer and content codings and the charset that the response
states. Control characters in a URI are percent-encoded. Header fields that the source
response has beside the known ones are kept in the metadata record's body. ``responses``
builds response records from a page table, ``write``/``parse`` turn records into WARC
bytes (one gzip member each) and back.

A null body is an empty one, a null URI an empty one (both still get their records). Repeated rows
give repeated records with equal ids; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import map_arrow

NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL name space
SOURCE_DIGEST = "Source-Payload-Digest"
SOFTWARE = "cadence derivative builder"
DATE = "1970-01-01T00:00:00Z"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_SKIP = re.compile(r"<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)", re.S | re.I)
_BREAK = re.compile(r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|"
                    r"section|table|td|th|title|tr|ul)\b[^>]*(?:>|\Z)", re.I)
_TAG = re.compile(r"<[A-Za-z/!?][^>]*(?:>|\Z)")
_CONTROL = re.compile(r"[\x00-\x1f\x7f]")
_SIZE = re.compile(rb"\s*([0-9A-Fa-f]{1,8})\s*(?:;|$)")
_CHARSET = re.compile(rb"""charset\s*=\s*["']?([A-Za-z0-9_.:-]+)""", re.I)
_META = re.compile(rb"""<meta[^>]{0,200}?charset\s*=\s*["']?([A-Za-z0-9_.:-]+)""", re.I)
_BLANK = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" ?\n\s*")

RECORD = ("record_id string, record_type string, refers_to string, target_uri string, warc_date string, content_type string, "
          "payload_digest string, block_digest string, content_length bigint, fields map<string,string>, block binary")
_MAP = pa.map_(pa.string(), pa.string())


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*names: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, chr(10).join(names))}>"


def plain_text(page: str) -> str:
    """All text of a page, a line for each block."""
    t = _TAG.sub("", _BREAK.sub("\n", _SKIP.sub(" ", page)))
    return _LINES.sub("\n", _BLANK.sub(" ", html.unescape(t))).strip()


def field(value: str) -> str:
    """A header value: control characters, which would end the field, percent-encoded."""
    return _CONTROL.sub(lambda m: f"%{ord(m.group()):02X}", value)


def unchunked(body: bytes) -> bytes:
    """The content of a chunked transfer; what follows a damaged size is taken as it is."""
    out, at = [], 0
    while at < len(body):
        line = body.find(b"\r\n", at)
        size = _SIZE.match(body[at:line]) if line >= 0 else None
        if size is None:
            return b"".join([*out, body[at:]])
        n = int(size.group(1), 16)
        if n == 0:
            break
        out.append(body[line + 2:line + 2 + n])
        at = line + 2 + n + 2
    return b"".join(out)


def unpacked(body: bytes, http: dict[str, str]) -> bytes:
    """The body as its transfer and content codings say it was; damaged data as far as it can be read."""
    if "chunked" in http.get("transfer-encoding", "").lower():
        body = unchunked(body)
    for coding in reversed(http.get("content-encoding", "").lower().replace(" ", "").split(",")):
        if coding in ("gzip", "x-gzip", "deflate"):
            for bits in (zlib.MAX_WBITS | 32, -zlib.MAX_WBITS):  # with a header, then bare
                try:
                    body = zlib.decompressobj(bits).decompress(body)
                    break
                except zlib.error:
                    continue
    return body


def decoded(body: bytes, http: dict[str, str]) -> str:
    """The body's text by the charset of its header, else of its own meta element, else UTF-8."""
    found = _CHARSET.search(http.get("content-type", "").encode()) or _META.search(body[:4096])
    for name in ([found.group(1).decode("ascii", "ignore")] if found else []) + ["utf-8"]:
        try:
            return body.decode("cp1252" if name.lower() in ("iso-8859-1", "latin1", "ascii", "us-ascii") else name, "replace")
        except (LookupError, ValueError):
            continue
    return ""


def record(kind: str, rid: str, refers: str | None, uri: str, date: str, content_type: str, payload: str | None, block: bytes,
           fields: dict) -> dict:
    return {"record_id": rid, "record_type": kind, "refers_to": refers, "target_uri": field(uri), "warc_date": date, "content_type": content_type,
            "payload_digest": payload, "block_digest": digest(block), "content_length": len(block), "fields": list(fields.items()), "block": block}


def response(uri: str, body: str, key: str) -> dict:
    data = body.encode("utf-8", "surrogatepass")
    return record("response", record_id(key, uri, digest(data)), None, uri, DATE, "application/http; msgtype=response", digest(data),
                  HTTP.format(len(data)).encode() + data, {"WARC-IP-Address": "0.0.0.0"})


def derive(r: dict) -> list[dict]:
    """The metadata and the conversion record of a response record."""
    head, _, body = r["block"].partition(b"\r\n\r\n")
    status, *lines = head.decode("latin-1").split("\r\n")
    http = [x.split(":", 1) for x in lines if ":" in x]
    named = {k.strip().lower(): v.strip() for k, v in http}
    kept = [f"source-{k.strip().lower()}: {v.strip()}" for k, v in http] + [f"{k}: {v}" for k, v in r["fields"]]
    meta = "\r\n".join([f"http-status: {status}", *kept, f"source-block-digest: {r['block_digest']}", f"source-payload-digest: {r['payload_digest']}",
                        f"source-length: {r['content_length']}", ""]).encode()
    text = plain_text(decoded(unpacked(body, named), named)).encode("utf-8", "surrogatepass")
    out = []
    for kind, content_type, block in (("metadata", "application/warc-fields", meta), ("conversion", "text/plain", text)):
        out.append(record(kind, record_id(r["record_id"], kind), r["record_id"], r["target_uri"], r["warc_date"], content_type,
                          r["payload_digest"], block, {"WARC-Software": SOFTWARE}))
    return out


def write(r: dict) -> bytes:
    """A record as one gzip member."""
    fields = [("WARC-Type", r["record_type"]), ("WARC-Record-ID", r["record_id"]), ("WARC-Date", r["warc_date"]),
              ("WARC-Target-URI", r["target_uri"]), ("WARC-Refers-To", r["refers_to"]),
              *([("WARC-Payload-Digest", digest(r["block"])), (SOURCE_DIGEST, r["payload_digest"])] if r["refers_to"] else
                [("WARC-Payload-Digest", r["payload_digest"])]),
              ("WARC-Block-Digest", r["block_digest"]), ("Content-Type", r["content_type"]), *dict(r["fields"]).items(),
              ("Content-Length", r["content_length"])]
    head = "".join(f"{field(str(k))}: {field(str(v))}\r\n" for k, v in fields if v not in (None, ""))
    return gzip.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + r["block"] + b"\r\n\r\n", 6, mtime=0)


def parse(data: bytes) -> list[dict]:
    """The records in WARC bytes (gzip members in a row)."""
    raw, out, at = gzip.decompress(data), [], 0
    while at < len(raw):
        head, _, _ = raw[at:].partition(b"\r\n\r\n")
        f = {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}
        start, n = at + len(head) + 4, int(f.pop("Content-Length"))
        take, names = lambda k: f.pop(k, None), set(f)
        out.append({"record_type": take("WARC-Type"), "record_id": take("WARC-Record-ID"), "warc_date": take("WARC-Date"),
                    "target_uri": take("WARC-Target-URI") or "", "refers_to": take("WARC-Refers-To"), "payload_digest": [take("WARC-Payload-Digest"), take(SOURCE_DIGEST)][SOURCE_DIGEST in names],
                    "block_digest": take("WARC-Block-Digest"), "content_type": take("Content-Type"), "content_length": n,
                    "fields": list(f.items()), "block": raw[start:start + n]})
        at = start + n + 4
    return out


def _batch(rows: list[dict], lead: dict[str, pa.Array]) -> pa.RecordBatch:
    names = [x.strip().split(" ")[0] for x in RECORD.replace("map<string,string>", "map").split(",")]
    types = {"content_length": pa.int64(), "fields": _MAP, "block": pa.binary()}
    return pa.RecordBatch.from_arrays([*lead.values(), *[pa.array([r[n] for r in rows], types.get(n, pa.string())) for n in names]], [*lead, *names])


def _responses(batches):
    for b in batches:
        rows = [response(u, h, str(k)) for k, u, h in zip(*[b.column(c).to_pylist() for c in ("page_id", "url", "html")])]
        yield _batch(rows, {"page_id": b.column("page_id")})


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A response record per page: page_id and the fields of RECORD."""
    empty = F.lit("")
    rows = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col).cast("string"), empty).alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), empty).alias("html"))
    return map_arrow(rows, _responses, f"page_id {rows.schema['page_id'].dataType.simpleString()}, {RECORD}")


def _derive(batches):
    for b in batches:
        rows = b.select([i for i, n in enumerate(b.schema.names) if n != "page_id"]).to_pylist()
        yield _batch([d for r in rows for d in derive(r)],
                     {"page_id": b.column("page_id").take(pa.array([i for i in range(len(rows)) for _ in (0, 1)], pa.int64()))})


def derivatives(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of the response records in ``records``."""
    return map_arrow(records.where(F.col("record_type") == "response"), _derive,
                     f"page_id {records.schema['page_id'].dataType.simpleString()}, {RECORD}")


def _bytes(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("record_id"), pa.array([write(r) for r in b.to_pylist()], pa.binary())], ["record_id", "warc"])


def warc_bytes(records: DataFrame) -> DataFrame:
    """``(record_id, warc)``: each record as a gzip member; members may be joined to files in any order."""
    return map_arrow(records.drop("page_id"), _bytes, "record_id string, warc binary")
