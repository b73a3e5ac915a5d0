"""Embedding near-duplicates by PCA-ordered, tiled comparison.

Vectors are scaled to length one and rotated into the principal axes of a bounded
sample, so that the first coordinates differ most between unlike vectors. Within a
label the distinct vectors are ordered along the first axes: the label is cut into
cells along the first axis and a cell into strips along the second, both by a fixed
width, so that a strip can only have partners in itself and its neighbours. A strip is
dealt by hash to tiles of about TILE vectors; a pair of tiles sends both to one task, so
larger tiles send less for the same products. A pair is compared only if the boxes of
the tiles' leading coordinates come close enough. Inside a pair, products are accumulated block of dimensions by block:
the rest is bounded by the product of the suffix norms, and what cannot reach the
threshold any more stops. What remains is decided by the cosine in double precision of
the vectors as given.

Equal vectors of a label are one row first, with a count, whatever their number. A
tile pair returns link counts and a spanning forest of its links, never the links
themselves. Components are joined by Spark.

Labels that are null, vectors that are null, empty, zero or hold a null or a value
that is not finite link with nothing; vectors of different length never link. Rows
with one id repeated are equal rows or rows of their own: each gets a result. An empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import map_arrow, stored
from cadence.llm.components import components

THRESHOLD = 0.98
TILE = 1024
#: Bound of the sample that the axes are computed from.
SAMPLE = 4096
#: Dimensions accumulated at a time, and leading dimensions that a tile's box bounds.
BLOCK, BOX = 8, 12
SLACK = 1e-6


def axes(vectors: DataFrame, sample: int) -> dict[int, np.ndarray]:
    """Orthonormal principal axes by vector length, from about ``sample`` vectors chosen by hash."""
    out = {}
    for r in vectors.groupBy("dim").agg(F.count("*").alias("n")).collect():  # one row per vector length
        some = vectors.where(F.col("dim") == r["dim"])
        if r["n"] > sample:
            some = some.where(F.pmod(F.xxhash64("v", F.lit(1)), F.lit(1 << 20)) < int((1 << 20) * sample / r["n"]))
        m = np.asarray([x["v"] for x in some.select("v").collect()], np.float64).reshape(-1, r["dim"])
        m = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300) if len(m) else np.eye(r["dim"])
        m = m - m.mean(axis=0) if len(m) > 1 else m  # the rotation keeps all angles, centred or not
        out[r["dim"]] = np.linalg.svd(m, full_matrices=True)[2] if len(m) <= r["dim"] else np.linalg.eigh(m.T @ m)[1][:, ::-1].T
    return out


def _rotate(shared, width: float):
    def run(batches):
        for b in batches:
            vs = b.column("v").to_pylist()
            lead, cell = [], []
            for v in vs:
                x = np.asarray(v, np.float64)
                x = x / np.abs(x).max()
                p = shared.value[len(v)] @ (x / np.linalg.norm(x))
                lead.append(p[:BOX].tolist())
                cell.append(int(np.floor(p[0] / width)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lead, pa.list_(pa.float64())), pa.array(cell, pa.int32())],
                                             [*b.schema.names, "lead", "cell"])
    return run


def compare(a: np.ndarray, b: np.ndarray, rot: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of ``a`` and ``b`` with cosine >= threshold (below the diagonal if they are the same)."""
    scaled = [x / np.abs(x).max(axis=1, keepdims=True) for x in (a, b)]
    unit = [x / np.linalg.norm(x, axis=1, keepdims=True) for x in scaled]
    p, q = (u @ rot.T for u in unit)
    d = p.shape[1]
    rest = [np.sqrt(np.maximum(np.cumsum((x ** 2)[:, ::-1], axis=1)[:, ::-1], 0)) for x in (p, q)]
    dot = p[:, :BLOCK] @ q[:, :BLOCK].T
    bound = dot if d <= BLOCK else dot + np.outer(rest[0][:, BLOCK], rest[1][:, BLOCK])
    live = bound >= threshold - SLACK
    if same:
        live = np.tril(live, -1)
    i, j = np.nonzero(live)
    dot = dot[i, j]
    for k in range(BLOCK, d, BLOCK):
        dot = dot + np.einsum("nk,nk->n", p[i, k:k + BLOCK], q[j, k:k + BLOCK])
        left = rest[0][i, k + BLOCK] * rest[1][j, k + BLOCK] if k + BLOCK < d else 0.0
        ok = dot + left >= threshold - SLACK
        i, j, dot = i[ok], j[ok], dot[ok]
        if not len(i):
            return i, j
    x, y = scaled[0][i], scaled[1][j]
    cos = np.einsum("nk,nk->n", x, y) / np.sqrt(np.einsum("nk,nk->n", x, x) * np.einsum("nk,nk->n", y, y))
    ok = cos >= threshold
    return i[ok], j[ok]


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Positions of links that join everything the links ``(i, j)`` over n nodes join."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for at, (x, y) in enumerate(zip(i.tolist(), j.tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append(at)
    return np.asarray(out, np.int64)


def _pairs(shared, threshold: float):
    names = ["a", "b", "n"]

    def load(tile: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.asarray(tile["nodes"], np.int64), np.asarray(tile["copies"], np.int64), \
            np.frombuffer(tile["data"], np.float64).reshape(len(tile["nodes"]), -1)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                (na, ca, va), (nb, cb, vb) = load(row["x"]), load(row["y"])
                if va.shape[1] != vb.shape[1]:
                    continue
                same = row["tile"] == row["other"]
                i, j = compare(va, vb, shared.value[va.shape[1]], threshold, same)
                if not len(i):
                    continue
                # links counted for either side, by the copies of the other
                node = np.concatenate([na, nb])
                n = np.bincount(np.concatenate([i, len(na) + j]), np.concatenate([cb[j], ca[i]]), len(node)).astype(np.int64)
                at = forest(i, j if same else len(na) + j, len(node))
                has = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([na[i[at]], node[has]])), pa.array(np.concatenate([nb[j[at]], node[has]])),
                     pa.array(np.concatenate([np.zeros(len(at), np.int64), n[has]]))], names)
    return run


def _tiles(batches):
    for b in batches:
        data = [np.asarray(v, np.float64).tobytes() for v in b.column("data").to_pylist()]
        names = [n for n in b.schema.names if n != "data"]
        yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], pa.array(data, pa.binary())], [*names, "data"])


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, tile: int = TILE, sample: int = SAMPLE) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    ``n_links`` are the other rows linked directly, ``component_id`` the least vec_id
    reachable, ``kept`` whether that is the row's own id."""
    spark = vectors.sparkSession
    rows = stored(vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v")))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    fine = F.coalesce(F.col("label").isNotNull() & (F.size("v") > 0) & ~F.exists("v", bad) & F.exists("v", lambda x: x != 0), F.lit(False))
    ok = rows.where(fine)
    # equal vectors of a label are one node, named by its least id (ids are unique per node: equal ids are told apart by the vector)
    each = ok.groupBy("label", "v").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    nodes = stored(each.withColumn("dim", F.size("v")))
    per = stored(nodes.select("label", "v", "copies", "least", "dim", F.monotonically_increasing_id().alias("node")))
    rot = spark.sparkContext.broadcast(axes(per, sample))
    reach = float(np.sqrt(2 - 2 * threshold) + 1e-6)  # unit vectors further apart on any axis cannot link
    s = per.schema
    led = map_arrow(per, _rotate(rot, reach), f"label {s['label'].dataType.simpleString()}, v array<double>, copies bigint, "
                    f"least {s['least'].dataType.simpleString()}, dim int, node bigint, lead array<double>, cell int")
    # strips of a cell: cut along the second axis, then dealt evenly to tiles
    led = led.withColumn("strip", F.floor(F.coalesce(F.get("lead", F.lit(1)), F.lit(0.0)) / reach).cast("int"))
    strip = ["label", "dim", "cell", "strip"]
    by_strip = led.groupBy(*strip).agg(F.count("*").alias("m"))
    led = led.join(stored(by_strip), strip).withColumn("salt", F.pmod(F.xxhash64("node"), F.ceil(F.col("m") / tile)).cast("int"))
    box = [F.min(F.get("lead", F.lit(k))).alias(f"lo{k}") for k in range(BOX)] + [F.max(F.get("lead", F.lit(k))).alias(f"hi{k}") for k in range(BOX)]
    cells = led.groupBy(*strip, "salt").agg(F.collect_list("node").alias("nodes"), F.collect_list("copies").alias("copies"),
                                            F.flatten(F.collect_list("v")).alias("data"), *box)
    tiles = stored(map_arrow(cells.withColumn("tile", F.monotonically_increasing_id()), _tiles,
                             cells.withColumn("tile", F.lit(1).cast("long")).withColumn("data", F.lit(b"")).select(
                                 *[c for c in [*cells.columns, "tile"] if c != "data"], "data").schema))
    meta = tiles.drop("nodes", "copies", "data")
    near = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    around = meta.select("*", near.alias("to")).select("*", (F.col("cell") + F.col("to.i")).alias("cell2"), (F.col("strip") + F.col("to.j")).alias("strip2"))
    y = meta.select(*[F.col(c).alias(f"y_{c}") for c in meta.columns])
    gap = lambda k: F.coalesce(F.greatest(F.col(f"lo{k}") - F.col(f"y_hi{k}"), F.col(f"y_lo{k}") - F.col(f"hi{k}"), F.lit(0.0)), F.lit(0.0))
    far2 = sum((gap(k) * gap(k) for k in range(BOX)), F.lit(0.0))
    close = around.join(y, (F.col("label") == F.col("y_label")) & (F.col("dim") == F.col("y_dim")) & (F.col("cell2") == F.col("y_cell")) & (F.col("strip2") == F.col("y_strip"))) \
        .where((F.col("tile") >= F.col("y_tile")) & (far2 <= reach * reach)).select("tile", F.col("y_tile").alias("other"))
    body = tiles.select("tile", F.struct("nodes", "copies", "data").alias("x"))
    both = stored(close).join(body, "tile").join(body.select(F.col("tile").alias("other"), F.col("x").alias("y")), "other")
    found = stored(map_arrow(both, _pairs(rot, threshold), "a bigint, b bigint, n bigint"))
    links = found.where("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    group = components(found.where("a != b").select("a", "b"))
    named = per.select("node", "label", "v", "copies", "least").join(links, "node", "left").join(group, "node", "left")
    named = stored(named.select("label", "v", "least", F.coalesce("root", "node").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    least = stored(named.groupBy("root").agg(F.min("least").alias("component_id")))
    named = named.join(least, "root").select("label", "v", "n_links", "component_id")
    out = ok.join(named, ["label", "v"]).select("vec_id", "n_links", "component_id")
    out = out.unionByName(rows.where(~fine).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
