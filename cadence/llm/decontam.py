"""Benchmark decontamination with spaced seeds.

Masks choose token positions and ignore the others between them. Every window of a
benchmark item under every mask gives a seed hash; so does every window of every
document. Equal hashes are hits: an item, and a diagonal on which document and item
are aligned. The hit is verified on the whole diagonal: any aligned segment with
``min_tokens`` equal tokens (all of them, if the item has fewer) and the least identity
is an overlap; the one with the most equal tokens is reported. So a passage is found
though single words were replaced. The masks follow from the two thresholds and miss
no such segment (``seed_weight``).

Hits that follow one another on a diagonal are one: a hit is looked up only where the one
before it on its diagonal is none, so a word or phrase repeated in text and item gives
hits by the sum of their lengths, not by the product. Positions are taken in portions of
bounded hits, and an item is done with once no diagonal can beat the best one found.

The benchmark is the stated query set: its distinct texts are read in blocks (by hash), each
broadcast and held against all documents; the ids of items are joined to the hits. Items shorter than a
mask use contiguous windows of their own length. Null and empty texts match nothing,
nor do items without words. Repeated rows each get their result, repeated items are
reported each. Ties between segments go to the leftmost. Empty tables give no rows.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm import wordhash
from cadence.llm.common import map_arrow, slices, text_or_empty
from cadence.llm.wordhash import U, mix

MIN_TOKENS, IDENTITY = 13, 0.8
#: Positions a mask looks at, at most; lower thresholds need masks of fewer.
MOST_WEIGHT = 8
#: Characters of benchmark text in a broadcast block.
BLOCK_CHARS = 8_000_000
FILTER_BITS = 20
#: Hits expanded at a time.
PORTION = 1 << 21
#: Stands for the seed before the first.
NONE = np.zeros(1, U)
SLICE_CHARS = 1 << 20


def seed_weight(min_tokens: int, identity: float) -> int:
    """The most positions w that a mask may look at so that no overlap is missed.

    An overlap with m replaced tokens has e >= max(min_tokens, m * identity / (1 - identity))
    equal ones, in m + 1 runs. These make m // 2 + 1 pairs of neighbours (or single runs),
    so two neighbouring runs hold w tokens if (w - 1) * (m // 2 + 1) < e. From some m on
    that follows from the identity alone."""
    least, t = max(1, min_tokens), Fraction(str(identity))
    if t >= 1:
        return min(MOST_WEIGHT, least)
    odds = t / (1 - t)
    for k in range(MOST_WEIGHT - 1, 0, -1):
        if k < 2 * odds and all(k * (m // 2 + 1) < max(least, -(-m * odds // 1)) for m in range(int(k / (odds - Fraction(k, 2))) + 2)):
            return k + 1
    return 1


def masks_for(lengths, min_tokens: int = MIN_TOKENS, identity: float = IDENTITY) -> dict[int, np.ndarray]:
    """Mask number -> positions: w in a row, or w around one replaced token.
    Numbers from 100 on are the windows of whole short items."""
    w = seed_weight(min_tokens, identity)
    out = {a: np.delete(np.arange(w + 1), a or w) for a in range(w)}
    return out | {100 + n: np.arange(n) for n in sorted({int(n) for n in lengths if 0 < n <= w})}


def seeds(hashes: np.ndarray, number: int, positions: np.ndarray) -> np.ndarray:
    """Seed hash of every window of ``hashes`` under the mask."""
    n = len(hashes) - int(positions[-1])
    if n <= 0:
        return np.zeros(0, U)
    h = np.full(n, U(number + 1))
    for p in positions:
        h = h * wordhash.BASE + hashes[p:p + n]
    return mix(h)


def segment(eq: np.ndarray, identity: Fraction) -> tuple[int, int, int]:
    """``(equal, aligned, start)`` of the segment with the most equal tokens among those of the least identity.

    A segment has it if ``equal - identity * aligned`` summed up to its end is not below the sum
    up to its start; for each end the earliest such start leaves out the fewest equal tokens."""
    equal = np.concatenate([[0], np.cumsum(eq)])
    run = identity.denominator * equal - identity.numerator * np.arange(len(equal))
    start = np.searchsorted(-np.minimum.accumulate(run), -run)
    end = int((equal - equal[start]).argmax())
    at = np.flatnonzero(eq[start[end]:end]) + start[end]
    return (len(at), int(at[-1] - at[0]) + 1, int(at[0])) if len(at) else (0, 0, 0)


class Index:
    """Seeds of a block of items: sorted hashes with item and position, and a bitmap that rules most others out."""

    def __init__(self, items: list[tuple], min_tokens: int = MIN_TOKENS, identity: float = IDENTITY):
        self.min_tokens, self.identity = min_tokens, Fraction(str(identity))
        self.ids = [i for i, _ in items]
        hashes, first = wordhash.words([t or "" for _, t in items])
        self.words = [hashes[a:b] for a, b in zip(first[:-1], first[1:])]
        self.masks = masks_for(map(len, self.words), min_tokens, identity)
        self.table = {}
        for number, positions in self.masks.items():
            own = [(k, seeds(w, number, positions)) for k, w in enumerate(self.words)
                   if len(w) > positions[-1] and (number < 100 or len(w) == number - 100)]
            if own:
                h = np.concatenate([s for _, s in own])
                before = np.concatenate([np.concatenate([NONE, s[:-1]]) for _, s in own])
                item = np.repeat([k for k, _ in own], [len(s) for _, s in own])
                at = np.concatenate([np.arange(len(s)) for _, s in own])
                order = np.lexsort((before, h))
                h, before = h[order], before[order]
                # entries by hash, and by the hash before them: (hash, hash before) as one rising number
                kinds, group = np.unique(before), np.cumsum(np.concatenate([[0], h[1:] != h[:-1]]))
                pair = group * (len(kinds) + 1) + np.searchsorted(kinds, before)
                bits = np.zeros(1 << FILTER_BITS, bool)
                bits[(h >> U(64 - FILTER_BITS)).astype(np.int64)] = True
                self.table[number] = (h, item[order], at[order], bits, kinds, group, pair)

    def diagonals(self, hashes: np.ndarray) -> np.ndarray:
        """Distinct ``(item, document position - item position)`` on which a word sequence has a hit."""
        out, longest = np.zeros(0, np.int64), max(map(len, self.words), default=0)
        wide = len(hashes) + longest + 1  # a diagonal and its item as one number
        for number, (h, item, at, bits, kinds, group, pair) in self.table.items():
            s = seeds(hashes, number, self.masks[number])
            pos = np.flatnonzero(bits[(s >> U(64 - FILTER_BITS)).astype(np.int64)])
            lo, hi = np.searchsorted(h, s[pos]), np.searchsorted(h, s[pos], side="right")
            pos, lo, hi = pos[hi > lo], lo[hi > lo], hi[hi > lo]
            if not len(pos):
                continue
            # of these, the entries whose own predecessor equals the text's go on a hit that is known
            prior = np.where(pos > 0, s[np.maximum(pos - 1, 0)], NONE)
            kind = np.searchsorted(kinds, prior)
            known = (pos > 0) & (kinds[np.minimum(kind, len(kinds) - 1)] == prior) & (kind < len(kinds))
            key = group[lo] * (len(kinds) + 1) + kind
            skip = np.where(known, np.searchsorted(pair, key), lo)
            upto = np.where(known, np.searchsorted(pair, key, side="right"), lo)
            first, size = np.concatenate([lo, upto]), np.concatenate([skip - lo, hi - upto])
            p = np.concatenate([pos, pos])
            p, first, size = p[size > 0], first[size > 0], size[size > 0]
            done = np.concatenate([[0], np.cumsum(size)])
            for a, z in _portions(done):
                n = size[a:z]
                to = np.repeat(first[a:z], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                out = np.unique(np.concatenate([out, item[to] * wide + np.repeat(p[a:z], n) - at[to] + longest]))
        return np.stack([out // wide, out % wide - longest], axis=1)

    def overlaps(self, hashes: np.ndarray, lo: int, hi: int, diagonals: np.ndarray) -> Iterator[tuple]:
        """Verified ``(item, equal, aligned, start)`` in the document of words lo to hi, the best of each item."""
        best: dict = {}
        own, most = np.unique(hashes[lo:hi]), {}
        for k, d in diagonals.tolist():
            reach = best.get(k, (0,))[0]
            if reach and most[k] <= reach:
                continue
            w = self.words[k]
            if k not in most:  # no diagonal has more equal tokens than the item has words that the document holds
                most[k] = int(np.isin(w, own).sum())
            a, b = max(lo, d), min(hi, d + len(w))
            if b - a <= reach:
                continue
            found = segment(hashes[a:b] == w[a - d:b - d], self.identity)
            if found[0] >= max(1, min(self.min_tokens, len(w))) and found[0] > reach:
                best[k] = (found[0], found[1], a + found[2] - lo)
        for k, x in sorted(best.items()):
            yield (k, *x)

    def hits(self, texts: list[str]) -> Iterator[tuple]:
        """``(text number, item number, equal, aligned, start)`` over many texts."""
        for t0, t1 in slices(texts, SLICE_CHARS):
            hashes, first = wordhash.words(texts[t0:t1])
            d = self.diagonals(hashes)
            # a seed may span two texts; its diagonal is cut at the text's ends when it is verified
            if not len(d):
                continue
            length = np.fromiter(map(len, self.words), np.int64, len(self.words))[d[:, 0]]
            a = np.searchsorted(first, np.maximum(d[:, 1], 0), side="right") - 1
            z = np.searchsorted(first, np.minimum(d[:, 1] + length, len(hashes)) - 1, side="right") - 1
            for t in np.unique(np.concatenate([np.arange(x, y + 1) for x, y in zip(a, z)])).tolist():
                mine = d[(a <= t) & (z >= t)]
                for found in self.overlaps(hashes, int(first[t]), int(first[t + 1]), mine):
                    yield (t0 + t, *found)


def _portions(done: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of entries of about PORTION hits together, from the running count of hits."""
    a = 0
    while a < len(done) - 1:
        z = max(a + 1, int(np.searchsorted(done, done[a] + PORTION, side="right")) - 1)
        yield a, z
        a = z


def _item_key(text_col):
    return F.sha2(text_col, 256)


def blocks(benchmark: DataFrame, text_col: str, min_tokens: int = MIN_TOKENS, identity: float = IDENTITY,
           block_chars: int = BLOCK_CHARS) -> Iterator[Index]:
    """Indexes of the benchmark's distinct texts by their SHA-256, block by block. Copies of a text count
    once, so a block has about ``block_chars`` characters, or those of one longer text."""
    items = benchmark.select(text_or_empty(text_col).alias("text")).distinct()
    total = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    n = int(2 * total // block_chars) + 1
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k).select(_item_key(F.col("text")).alias("k"), "text").orderBy("k").collect()
        if part:
            yield Index([(r["k"], r["text"]) for r in part], min_tokens, identity)


def _find(shared):
    def run(batches):
        index = shared.value
        for b in batches:
            rows = list(index.hits(b.column("text").to_pylist()))
            c = np.asarray(rows, np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(c[:, 0])), pa.array([index.ids[i] for i in c[:, 1]], pa.string()),
                 *[pa.array(c[:, i]) for i in (2, 3, 4)]], ["doc_id", "__item", "n_equal", "n_aligned", "start_word"])
    return run


def find_overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", min_tokens: int = MIN_TOKENS,
                  identity: float = IDENTITY, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per contaminated row and item: doc_id, item_id, n_equal, n_aligned, start_word (of the best segment)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).alias("item_id"), _item_key(text_or_empty(item_text_col)).alias("__item"))
    sql = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, __item string, n_equal bigint, n_aligned bigint, start_word bigint"
    out = docs.sparkSession.createDataFrame([], sql)
    for index in blocks(benchmark, item_text_col, min_tokens, identity, block_chars):
        out = out.unionByName(map_arrow(rows, _find(docs.sparkSession.sparkContext.broadcast(index)), sql))
    return out.join(items, "__item").select("doc_id", "item_id", "n_equal", "n_aligned", "start_word")


def _clean(shared, column: int):
    def run(batches):
        for b in batches:
            texts = [t or "" for t in b.column(column).to_pylist()]
            bad = {h[0] for h in shared.value.hits(texts)}
            yield b.filter(pa.array([i not in bad for i in range(b.num_rows)], pa.bool_()))
    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", min_tokens: int = MIN_TOKENS, identity: float = IDENTITY,
                  block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the rows that overlap with an item; all columns as they are."""
    out = docs
    for index in blocks(benchmark, item_text_col, min_tokens, identity, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        out = map_arrow(out, _clean(shared, docs.columns.index(text_col)), docs.schema)
    return out
