"""Best-fit-decreasing packing of token sequences, exact over the whole table.

Documents are encoded and cut into pieces in one distributed pass that also numbers
each task's pieces of equal length. Best-fit decreasing only looks at lengths, and
pieces of one length are interchangeable, so the whole packing follows from the
number of pieces of each length: at most ``capacity`` counts go to the driver,
whatever the input. There a segment tree over remaining capacities finds the
tightest open bin in logarithmic time; bins with equal content stay one run. The
resulting plan (runs of equal pieces -> runs of bins) goes back to the pieces, which
find their bin by their number within their length. No task sees more than its part.

Null texts are empty; an empty document is one piece holding the end id only.
Repeated rows and ids are packed row by row; ties of equal length are placed in the
order of their number. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm import wordbpe
from cadence.llm.common import map_arrow, stored, text_or_empty

CAPACITY = 2048
END_ID = 0


class OpenBins:
    """Runs of open bins by remaining capacity, under a segment tree of which capacities have any."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.runs: list[list[tuple]] = [[] for _ in range(capacity + 1)]

    def _count(self, leaf: int, by: int) -> None:
        i = leaf + self.leaves
        while i:
            self.tree[i] += by
            i >>= 1

    def add(self, remaining: int, run: tuple) -> None:
        self.runs[remaining].append(run)
        self._count(remaining, 1)

    def take(self, remaining: int) -> tuple:
        self._count(remaining, -1)
        return self.runs[remaining].pop()

    def tightest(self, need: int) -> int | None:
        """The least remaining capacity of at least ``need`` that some open bin has."""
        i = need + self.leaves
        if self.tree[i]:
            return need
        while i > 1:  # up to the first right neighbour that has bins, then down its left edge
            if i % 2 == 0 and self.tree[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.tree[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return None


def plan(counts: Iterable[tuple[int, int]], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing for ``(length, how many)``.

    Rows ``(length, lo, hi, first bin, per bin, offset)``: the pieces of that length
    numbered from lo to hi - 1 fill consecutive bins from ``first bin``, ``per bin`` in
    each, from ``offset`` on. As a bin that took a piece is tighter than before, best fit
    puts pieces of one length into one bin until they no longer fit."""
    bins, out, opened = OpenBins(capacity), [], 0
    for length, todo in sorted(counts, reverse=True):
        number = 0
        while todo:
            room = bins.tightest(length)
            if room is None:
                room, n = capacity, -(-todo // (capacity // length))
                first, opened = opened, opened + n
            else:
                first, n = bins.take(room)
            each = room // length
            full = min(n, todo // each)
            if full:
                out.append((length, number, number + full * each, first, each, capacity - room))
                bins.add(room - full_size(each, length), (first, full))
                number, todo = number + full * each, todo - full * each
            if full < n and 0 < todo < each:
                out.append((length, number, number + todo, first + full, each, capacity - room))
                bins.add(room - full_size(todo, length), (first + full, 1))
                number, todo, full = number + todo, 0, full + 1
            if full < n:
                bins.add(room, (first + full, n - full))
    return out


def full_size(n: int, length: int) -> int:
    return n * length


def _pieces(path: str, capacity: int):
    end = np.asarray([END_ID], "<u4").tobytes()

    def run(batches):
        enc, part = wordbpe.load(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for b in batches:
            rows: list[tuple] = []
            for k, text in enumerate(b.column("text").to_pylist()):
                ids = enc.ids(text) + end
                for p, at in enumerate(range(0, len(ids), 4 * capacity)):
                    body = ids[at:at + 4 * capacity]
                    n = len(body) // 4
                    rows.append((k, p, at // 4, n, zlib.crc32(body), seen[n]))
                    seen[n] += 1
            c = np.asarray(rows, np.int64).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(c[:, 0])), pa.array(c[:, 1], pa.int32()), *[pa.array(c[:, i]) for i in (2, 3, 4, 5)],
                 pa.array(np.full(len(c), part), pa.int32())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "nth", "part"])
    return run


def _place(rows: list[tuple]):
    p = np.asarray(sorted((r[0], r[1], r[2], r[3], r[4], r[5]) for r in rows), np.int64).reshape(-1, 6)
    top = int(p[:, 2].max()) + 1 if len(p) else 1

    def run(batches):
        keys = p[:, 0].astype(object) * top + p[:, 1].astype(object) if top > 1 << 50 else p[:, 0] * top + p[:, 1]
        for b in batches:
            length, nth = b.column("length").to_numpy(), b.column("nth").to_numpy()
            r = p[np.searchsorted(keys, length * top + nth, side="right") - 1]
            k = nth - r[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")],
                 pa.array(r[:, 3] + k // r[:, 4]), pa.array(r[:, 5] + k % r[:, 4] * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    base = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
    pieces = stored(map_arrow(rows, _pieces(path, capacity), f"{base}, nth bigint, part int"))
    by_part = pieces.groupBy("length", "part").agg((F.max("nth") + 1).alias("n"))
    counts = by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most ``capacity`` rows
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    # one number as the key and the small side as a hash table: no task sorts its pieces, whose pages fill the heap
    key = F.shiftleft("length", 31) + F.col("part")
    first = by_part.select(key.alias("run"), earlier.alias("earlier")).hint("shuffle_hash")
    numbered = pieces.withColumn("run", key).join(first, "run").withColumn("nth", F.col("nth") + F.col("earlier")).drop("earlier", "part", "run")
    return map_arrow(numbered, _place(plan([(r["length"], r["n"]) for r in counts], capacity)),
                     f"{base}, sequence_id bigint, offset bigint")
