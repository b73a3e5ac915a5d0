"""Removal of repeated byte strings by a distributed, prefix-aware merge sort of suffixes.

Every byte covered by a LENGTH-byte string that starts anywhere else too goes. Sorting
all suffixes would exchange LENGTH bytes for each byte of input, so the suffixes are
thinned first, without losing a repeat:

1. Anchors. A window of LENGTH bytes holds W = LENGTH - GRAM + 1 grams; the one with
   the least hash is its anchor (all of them, if equal). Equal windows have their
   anchors at equal places, so a repeated window is found through its anchor: the
   suffix from there, with the W - 1 bytes before it read backwards.
2. Fingerprints. An anchor whose gram is nowhere else cannot belong to a repeated
   window. Tasks send 40-bit gram hashes, packed by hash bucket and collapsed within
   the task; a collision only lets a useless anchor live.
3. Sorted runs. Each task sorts the strings (suffix, end mark, reversed left context)
   of its live anchors, collapses equal ones with a count, and sends each bucket a
   front-coded run: for every string the length of the prefix shared with the one
   before, and the rest.
4. Merge. A bucket's runs are merged by a loser tree whose players carry their common
   prefix with the last winner: the longer one decides without looking at a character,
   and characters are compared only beyond it. Equal strings of different runs meet as
   neighbours; the common prefixes of neighbours come out with them.
5. Repeats. Strings met twice have all their windows repeated. For the others, a window
   reaching o bytes left is repeated if another string of the bucket shares LENGTH - o
   bytes to the right and o to the left: ranks by prefix, read off the common prefixes
   of the merge, and ranks of the reversed left contexts tell this for every o at once.
   As all windows of an anchor contain it, the least and the largest o give the bytes.
6. The documents, dealt by a hash of their text as in step 3, drop the union.

Matches never cross documents; overlaps count; everything is judged on the input.
Null texts are empty. Texts shorter than LENGTH keep everything. Rows with equal texts
are copies, so each of them of LENGTH bytes or more goes as a whole; repeated ids keep
a row each. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm import wordhash
from cadence.llm.common import map_arrow, text_or_empty
from cadence.llm.wordhash import U

LENGTH, GRAM = 200, 88
#: Input bytes for each bucket (about 50,000 anchors), and the fewest buckets.
BUCKET_BYTES, BUCKETS = 3_000_000, 256
#: Bytes hashed at a time; anchors, and bytes of strings, held until a task sends them.
SEGMENT, HELD, RUN_BYTES = 1 << 21, 2_000_000, 48_000_000
HASH_BYTES = 5
END = b"\xff"  # in no UTF-8 text


def sliding(a: np.ndarray, w: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every w neighbours, by doubling."""
    n = 1
    while 2 * n <= w:
        a, n = pick(a[:-n], a[n:]), 2 * n
    return pick(a[:len(a) - (w - n)], a[w - n:]) if w > n else a


def anchors(data: np.ndarray, ok: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and gram hashes of the anchors of the windows ``[s, s + length)`` with ``ok[s]``."""
    w = length - gram + 1
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, U)
    s = wordhash.sums(data)
    h = wordhash.mix((s[gram:] - s[:-gram]) * wordhash.powers(len(data))[1][:len(s) - gram]) | U(1)
    least = np.where(ok[:len(data) - length + 1], sliding(h, w, np.minimum), U(0))
    # a gram is an anchor if it is the least of some window that holds it
    pad = np.zeros(w - 1, U)
    at = np.flatnonzero(sliding(np.concatenate([pad, least, pad]), w, np.maximum) == h)
    return at, h[at]


def text_anchors(texts: list[bytes], length: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(text number, position, hash)`` arrays, in segments of bounded size; long texts span several."""
    group: list[tuple[int, int, bytes]] = []
    size = 0

    def run():
        data = np.frombuffer(b"".join(b for _, _, b in group), np.uint8)
        n = np.fromiter((len(b) for _, _, b in group), np.int64, len(group))
        first = np.cumsum(n) - n
        ok = np.zeros(len(data), bool)
        for f, m in zip(first.tolist(), n.tolist()):
            ok[f:f + m - length + 1] = True
        at, h = anchors(data, ok, length, gram)
        k = np.searchsorted(first, at, side="right") - 1
        return np.asarray([g[0] for g in group])[k], at - first[k] + np.asarray([g[1] for g in group])[k], h

    for i, b in enumerate(texts):
        for lo in range(0, max(1, len(b) - length + 1), SEGMENT):
            part = b[lo:lo + SEGMENT + length - 1]
            if len(part) < length:
                continue
            group.append((i, lo, part))
            size += len(part)
            if size >= SEGMENT:
                yield run()
                group, size = [], 0
    if group:
        yield run()


def _encode(texts: list[str]) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts]


_PRINT = "bucket int, hash binary, many binary, text binary, pos binary, live_text binary, live_pos binary"
_PRINT_NAMES = [x.split()[0] for x in _PRINT.split(", ")]


def _fingerprints(buckets: int, length: int, gram: int):
    def send(h: np.ndarray, text: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
        bucket = (h % U(buckets)).astype(np.int64)
        low = h >> U(64 - 8 * HASH_BYTES)
        order = np.lexsort((pos, text, low, bucket))
        bucket, low, text, pos = bucket[order], low[order], text[order], pos[order]
        new = np.ones(len(low), bool)
        new[1:] = (low[1:] != low[:-1]) | (bucket[1:] != bucket[:-1])
        lead = np.flatnonzero(new)
        n = np.diff(np.append(lead, len(low)))
        many = np.repeat(n > 1, n)  # met twice here already: live, and one of them tells the others
        cut = np.searchsorted(bucket, np.arange(buckets + 1))
        rows = []
        for b in np.flatnonzero(np.diff(cut)).tolist():
            x = slice(int(cut[b]), int(cut[b + 1]))
            f, m = np.flatnonzero(new[x]) + x.start, np.flatnonzero(many[x]) + x.start
            rows.append((b, np.ascontiguousarray(low[f].view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES]).tobytes(), many[f].tobytes(), text[f].tobytes(),
                         pos[f].astype("<u4").tobytes(), text[m].tobytes(), pos[m].astype("<u4").tobytes()))
        cols = list(zip(*rows)) or [()] * 7
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]], _PRINT_NAMES)

    def run(batches):
        held, n = [], 0
        for b in batches:
            key = b.column("key").to_numpy()
            for text, pos, h in text_anchors(_encode(b.column("text").to_pylist()), length, gram):
                held.append((h, key[text], pos))
                n += len(h)
                if n >= HELD:
                    yield send(*map(np.concatenate, zip(*held)))
                    held, n = [], 0
        if held:
            yield send(*map(np.concatenate, zip(*held)))
    return run


def _live(table: pa.Table) -> pa.Table:
    """Of one bucket: ``(key, pos)`` of the anchors whose gram was met more than once."""
    col = lambda n, t: np.frombuffer(b"".join(table.column(n).to_pylist()), t)
    raw = col("hash", np.uint8).reshape(-1, HASH_BYTES)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :HASH_BYTES] = raw
    _, which, n = np.unique(wide.view("<u8").ravel(), return_inverse=True, return_counts=True)
    many = col("many", bool)
    live = (n[which] > 1) & ~many  # those met twice in a task are in the live lists themselves
    return pa.table({"key": np.concatenate([col("text", np.int64)[live], col("live_text", np.int64)]),
                     "pos": np.concatenate([col("pos", "<u4")[live], col("live_pos", "<u4")]).astype(np.int64)})


def common(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, given that it is ``known`` at least."""
    n = min(len(a), len(b))
    if known == n or a[known] != b[known]:
        return known
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


class Run:
    """A front-coded sorted run, decoded string by string."""

    def __init__(self, shared: np.ndarray, rest: np.ndarray, chars: bytes):
        self.shared, self.rest, self.chars = shared.tolist(), rest.tolist(), chars
        self.i, self.at, self.now = -1, 0, b""

    def next(self) -> int | None:
        """Moves on; returns the prefix length shared with the string before, or None at the end."""
        self.i += 1
        if self.i >= len(self.shared):
            return None
        keep, n = self.shared[self.i], self.rest[self.i]
        self.now = self.now[:keep] + self.chars[self.at:self.at + n]
        self.at += n
        return keep


def front_code(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    shared = [0, *map(common, strings, strings[1:])] if strings else []
    return np.asarray(shared, "<u2"), np.asarray([len(s) - k for s, k in zip(strings, shared)], "<u2"), b"".join(s[k:] for s, k in zip(strings, shared))


def merge(runs: list[Run]) -> Iterator[tuple[bytes, int, int]]:
    """``(string, common prefix with the one before, run)`` in sorted order.

    Loser tree: ``known[r]`` is the prefix run r's string shares with the last winner.
    Of two players the one sharing more is smaller; only equals look at characters,
    from there on, and the loser then remembers what it shares with the new winner."""
    size = 1
    while size < len(runs):
        size *= 2
    strings: list[bytes | None] = [None] * size
    known = [0] * size
    for r, run in enumerate(runs):
        if run.next() is not None:
            strings[r] = run.now

    def play(x: int, y: int) -> tuple[int, int]:
        """Winner and loser."""
        a, b = strings[x], strings[y]
        if a is None or b is None:
            return (y, x) if a is None else (x, y)
        if known[x] != known[y]:
            return (x, y) if known[x] > known[y] else (y, x)
        k = common(a, b, known[x])
        if a[k:k + 1] > b[k:k + 1] or (a[k:k + 1] == b[k:k + 1] and x > y):
            x, y = y, x
        known[y] = k
        return x, y

    loser, winner = [0] * size, [0] * (2 * size)
    for i in range(size):
        winner[size + i] = i
    for i in range(size - 1, 0, -1):
        winner[i], loser[i] = play(winner[2 * i], winner[2 * i + 1])
    top = winner[1] if size > 1 else 0
    while strings[top] is not None:
        yield strings[top], known[top], top
        keep = runs[top].next()
        strings[top], known[top] = (None, 0) if keep is None else (runs[top].now, keep)
        i = (top + size) // 2
        while i:
            top, loser[i] = play(top, loser[i])
            i //= 2


_RUN = "bucket int, shared binary, rest binary, chars binary, times binary, members binary, member binary"
_RUN_NAMES = [x.split()[0] for x in _RUN.split(", ")]
_MEMBER = np.dtype([("key", "<i8"), ("check", "<i8"), ("pos", "<i8")])


def _runs(buckets: int, length: int, gram: int):
    left = length - gram

    def send(held: dict) -> Iterator[pa.RecordBatch]:
        by: dict[int, list[bytes]] = {}
        for s in held:
            by.setdefault(zlib.crc32(s[:gram]) % buckets, []).append(s)
        for bucket, strings in by.items():
            strings.sort()
            places = [held[s] for s in strings]
            # copies of a text in one task give the same place: it is sent once, its number counts
            distinct = [np.unique(np.asarray(p, _MEMBER)) for p in places]
            row = [bucket, *front_code(strings), np.asarray([len(p) for p in places], "<i8"), np.asarray([len(d) for d in distinct], "<i8"), np.concatenate(distinct)]
            yield pa.RecordBatch.from_arrays([pa.array([row[0]], pa.int32()), *[pa.array([x if isinstance(x, bytes) else x.tobytes()], pa.binary()) for x in row[1:]]],
                                             _RUN_NAMES)

    def run(batches):
        held, n = {}, 0
        for b in batches:
            for key, check, text, places in zip(*[b.column(c).to_pylist() for c in ("key", "check", "text", "places")]):
                data = text.encode("utf-8", "surrogatepass")
                for p in places:
                    if p + gram > len(data):
                        continue  # of another text with the same key
                    s = data[p:p + length] + END + data[max(0, p - left):p][::-1]
                    got = held.get(s)
                    if got is None:
                        held[s] = got = []
                        n += len(s) + 100
                    got.append((key, check, p))
                    n += 24
                if n >= RUN_BYTES:
                    yield from send(held)
                    held, n = {}, 0
        if held:
            yield from send(held)
    return run


def repeated(strings: list[bytes], shared: np.ndarray, times: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Per sorted distinct string the least and largest o of its repeated windows; none: (1, 0)."""
    n, left = len(strings), length - gram
    right = np.fromiter((s.index(END) for s in strings), np.int64, n)
    back = np.fromiter(map(len, strings), np.int64, n) - right - 1
    lo, hi = np.maximum(0, length - right), np.minimum(left, back)
    whole = (times > 1) & (lo <= hi)
    least, most = np.where(whole, lo, 1), np.where(whole, hi, 0)
    same = np.concatenate([[False], shared[1:] >= gram])  # shares its gram with the one before
    group = np.cumsum(~same) - 1
    todo = np.zeros(group[-1] + 1 if n else 0, bool)
    todo[group[times == 1]] = True
    todo &= np.bincount(group, minlength=len(todo)) > 1
    at = np.flatnonzero(todo[group])
    if not len(at):
        return least, most
    # common prefix with the string before, of the right contexts only, 0 where that one is not in ``at``
    prefix = np.minimum(shared, np.minimum(right, np.concatenate([[0], right[:-1]])))[at]
    prefix[np.concatenate([[True], np.diff(at) != 1])] = 0
    backs = [strings[i][right[i] + 1:] for i in at.tolist()]
    order = sorted(range(len(at)), key=backs.__getitem__)
    suffix = np.asarray([0, *(common(backs[x], backs[y]) for x, y in zip(order, order[1:]))])
    order = np.asarray(order)
    lo, hi = lo[at], hi[at]
    least_, most_ = np.full(len(at), left + 1), np.full(len(at), -1)
    rank_left = np.empty(len(at), np.int64)
    for o in range(left + 1):
        can = (lo <= o) & (o <= hi)
        if can.sum() < 2:
            continue
        rank_left[order] = np.cumsum(suffix < o) if o else 0
        key = (np.cumsum(prefix < length - o) * np.int64(len(at) + 1) + rank_left)[can]
        by = np.argsort(key, kind="stable")
        k = key[by]
        twin = np.zeros(len(k), bool)
        twin[1:] = k[1:] == k[:-1]
        twin[:-1] |= twin[1:].copy()
        hit = np.flatnonzero(can)[by[twin]]
        least_[hit] = np.minimum(least_[hit], o)
        most_[hit] = o
    single = times[at] == 1
    least[at[single]] = np.where(most_ >= 0, least_, 1)[single]
    most[at[single]] = np.where(most_ >= 0, most_, 0)[single]
    return least, most


def _decide(length: int, gram: int):
    def run(table: pa.Table) -> pa.Table:
        cols = {c: table.column(c).to_pylist() for c in _RUN_NAMES[1:]}
        runs = [Run(np.frombuffer(a, "<u2"), np.frombuffer(b, "<u2"), c) for a, b, c in zip(cols["shared"], cols["rest"], cols["chars"])]
        times_of = [np.frombuffer(x, "<i8").tolist() for x in cols["times"]]
        n_of = [np.frombuffer(x, "<i8") for x in cols["members"]]
        end_of = [np.cumsum(x) for x in n_of]
        member_of = [np.frombuffer(x, _MEMBER) for x in cols["member"]]
        strings, shared, times, place = [], [], [], []
        for s, k, r in merge(runs):
            i = runs[r].i
            if strings and k == len(s) == len(strings[-1]):
                times[-1] += times_of[r][i]
            else:
                strings.append(s)
                shared.append(k)
                times.append(times_of[r][i])
            place.append((len(strings) - 1, r, i))
        least, most = repeated(strings, np.asarray(shared), np.asarray(times), length, gram)
        out, spans = [], []
        for which, r, i in place:
            if least[which] <= most[which]:
                e = int(end_of[r][i])
                m = member_of[r][e - int(n_of[r][i]):e]
                out.append(m)
                spans.append(np.repeat([[most[which], least[which]]], len(m), axis=0))
        m = np.concatenate(out) if out else np.zeros(0, _MEMBER)
        o = np.concatenate(spans) if out else np.zeros((0, 2), np.int64)
        return pa.table({"key": m["key"].copy(), "check": m["check"].copy(), "lo": m["pos"] - o[:, 0], "hi": m["pos"] - o[:, 1] + length})
    return run


def _drop(batches):
    for b in batches:
        rows = []
        for text, check, spans in zip(*[b.column(c).to_pylist() for c in ("text", "check", "spans")]):
            data = text.encode("utf-8", "surrogatepass")
            out, at, spans_n = hashlib.sha256(), 0, 0
            removed = 0
            start = end = -1
            for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or () if s["check"] == check):
                if lo > end:
                    if end > 0:
                        removed, at = removed + end - start, end
                    out.update(data[at:lo])
                    start, end, spans_n = lo, hi, spans_n + 1
                end = max(end, hi)
            if end > 0:
                removed, at = removed + end - start, end
            out.update(data[at:])
            rows.append((len(data), removed, spans_n, out.hexdigest()))
        c = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(x, pa.int64()) for x in c[:3]], pa.array(c[3], pa.string())],
                                         ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("key"), F.xxhash64("text", F.lit(length)).alias("check"), "text")
    total = docs.select(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    buckets = max(BUCKETS, -(-total // BUCKET_BYTES))
    prints = map_arrow(rows.where(F.octet_length("text") >= length).select("key", "text"), _fingerprints(buckets, length, gram), _PRINT)
    live = prints.groupBy("bucket").applyInArrow(_live, "key bigint, pos bigint")
    places = live.groupBy("key").agg(F.collect_set("pos").alias("places"))  # one text's anchors
    runs = map_arrow(rows.join(places, "key"), _runs(buckets, length, gram), _RUN)
    spans = runs.groupBy("bucket").applyInArrow(_decide(length, gram), "key bigint, check bigint, lo bigint, hi bigint")
    gone = spans.groupBy("key").agg(F.collect_set(F.struct("check", "lo", "hi")).alias("spans"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows.join(gone, "key", "left"), _drop, f"doc_id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
