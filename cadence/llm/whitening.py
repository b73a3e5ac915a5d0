"""Embedding whitening by a distributed block Jacobi-Davidson eigensolver.

Entries become integers ``x = floor(64 * c) + 1000000``. The fit list is each distinct x vector
once; its count n and sums S are exact, and so are ``n * x - S``, from which every centred
entry is made (``(n * x - S) / n``): nothing of the size of the offset is ever multiplied.

The covariance is never formed. The solver only asks for its product with a block of vectors,
``sum over the list of c (c . q)``, one Spark job over blocks of centred vectors; a task
returns its partial product, a row of d numbers for each vector of the block. Outer steps project the covariance on
a growing subspace (Rayleigh-Ritz). Each wanted Ritz vector that has not converged gives a correction
equation ``(I - QQ')(V - e I)(I - QQ') t = -r``, Q being it and the locked vectors; inner MINRES
steps solve all of them side by side, one product a step. Ritz vectors whose residual has
reached double precision are locked and left alone. It ends when all are locked.

A row's whitened value is its centred vector on the component over the root of the eigenvalue.
Components whose eigenvalue is zero (up to double precision) have no whitened values: there are as many
components as the rank of the list allows, at most ``components``. Null vectors and those
with an entry that is null or not finite are dropped; so are empty ones and those of another length than most
vectors have (the longer one in a tie). Rows with one id repeated and null ids are rows
of their own; an empty table, or a list of a single vector, gives no rows; other columns are ignored.
An exact deviation beyond a long is an error.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import map_arrow, stored

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Vectors of one block, inner steps of a correction equation, and Ritz vectors kept at a restart as a multiple of the components.
BLOCK_ROWS, INNER, KEEP = 4096, 6, 2
#: Residuals have reached double precision at this many units of roundoff of the largest eigenvalue.
PRECISION = 64 * np.finfo(np.float64).eps
OUTER = 200

Product = Callable[[np.ndarray], np.ndarray]


def _orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to the orthonormal columns of ``against``."""
    for _ in range(3):
        for q in against:
            new = new - q @ (q.T @ new)
        norm = np.linalg.norm(new, axis=0)
        new = new[:, norm > 0] / norm[norm > 0]
        if not new.shape[1]:
            break
        u, s, _ = np.linalg.svd(new, full_matrices=False)
        new = u[:, s > 1e-8 * s[0]]
    return new


def minres(apply: Product, rhs: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of symmetric systems, one a column, by ``steps`` MINRES steps side by side."""
    beta = np.linalg.norm(rhs, axis=0)
    safe = np.where(beta > 0, beta, 1)
    v, v_old = rhs / safe, np.zeros_like(rhs)
    d1, d2, x = np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs)
    phi, beta_k = beta.copy(), np.zeros_like(beta)
    c, s, c_old, s_old = np.ones_like(beta), np.zeros_like(beta), np.ones_like(beta), np.zeros_like(beta)
    live = beta > 0
    for _ in range(steps):
        w = apply(v) - v_old * beta_k
        alpha = (v * w).sum(axis=0)
        w = w - v * alpha
        beta_next = np.linalg.norm(w, axis=0)
        # the last two rotations on the new column of the tridiagonal matrix, then one that clears beta_next
        epsilon, rest = s_old * beta_k, c_old * beta_k
        delta, gamma = c * rest + s * alpha, c * alpha - s * rest
        r = np.hypot(gamma, beta_next)
        live = live & (r > 0)
        r = np.where(live, r, 1)
        c_old, s_old, c, s = c, s, gamma / r, beta_next / r
        d2, d1 = d1, (v - d1 * delta - d2 * epsilon) / r
        x = x + np.where(live, d1 * (phi * c), 0)
        phi = -phi * s
        live = live & (beta_next > 1e-14 * beta)
        v_old, v = v, w / np.where(beta_next > 0, beta_next, 1)
        beta_k = beta_next
        if not live.any():
            break
    return x


def jacobi_davidson(product: Product, d: int, k: int, inner: int = INNER, precision: float = PRECISION, seed: int = 1) -> tuple[np.ndarray, np.ndarray, int]:
    """The k largest eigenvalues (falling), their unit eigenvectors and the number of products of a positive semidefinite operator."""
    k = min(k, d)
    calls = 0

    def apply(q):
        nonlocal calls
        calls += 1
        return product(q)

    most = min(d, max(4 * k, 24))
    basis = _orthonormal(np.random.default_rng(seed).standard_normal((d, min(d, k + 4))))
    image = apply(basis)
    locked, values, images = np.zeros((d, 0)), np.zeros(0), np.zeros((d, 0))
    scale, best = 0.0, np.inf
    stalled = 0
    for _ in range(OUTER):
        # Rayleigh-Ritz over the locked vectors and the subspace; locked ones are never rotated again
        e, y = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        e, y = e[::-1], y[:, ::-1]
        want = k - locked.shape[1]
        scale = max(scale, float(np.abs(e).max(initial=0)), float(np.abs(values).max(initial=0)))
        if scale == 0:
            return np.zeros(k), basis[:, :k], calls
        u, e_u = basis @ y[:, :want], e[:want]
        au = image @ y[:, :want]
        r = au - u * e_u
        r = r - locked @ (locked.T @ r)
        size = np.linalg.norm(r, axis=0) / scale
        done = size <= precision
        whole = basis.shape[1] + locked.shape[1] == d
        worst = float(size.max(initial=0))
        stalled = stalled + 1 if whole and worst > best / 2 else 0
        best = min(best, worst)
        lock = np.cumprod(done).astype(bool)  # from the largest down, so that none is passed over
        if stalled >= 2:  # the subspace is the whole space: what is left is the roundoff of the products themselves
            lock[:] = True
        if lock.any():
            locked, values, images = np.hstack([locked, u[:, lock]]), np.append(values, e_u[lock]), np.hstack([images, au[:, lock]])
            keep = np.flatnonzero(np.append(~lock, np.ones(len(e) - want, bool)))
            basis, image = basis @ y[:, keep], image @ y[:, keep]
            u, e_u, r = u[:, ~lock], e_u[~lock], r[:, ~lock]
        if locked.shape[1] == k:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order], calls
        if whole:  # refine: the same subspace with fresh products
            basis = _orthonormal(basis, locked)
            image = apply(basis)
            image = image - locked @ (locked.T @ image)
            continue

        def project(t, u=u):
            t = t - locked @ (locked.T @ t)
            return t - u * (u * t).sum(axis=0)

        def operator(t, e_u=e_u):
            return project(apply(project(t)) - project(t) * e_u)

        t = project(minres(operator, -project(r), inner))
        if basis.shape[1] + t.shape[1] > most:  # restart from the best Ritz vectors
            e, y = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
            y = y[:, ::-1][:, :max(KEEP * k - locked.shape[1], 1)] if most < d else y
            basis, image = basis @ y, image @ y
        new = _orthonormal(t, locked, basis)
        if not new.shape[1]:
            new = _orthonormal(np.random.default_rng(seed + calls).standard_normal((d, k)), locked, basis)
        if new.shape[1]:
            fresh = apply(new)
            basis, image = np.hstack([basis, new]), np.hstack([image, fresh - locked @ (locked.T @ fresh)])
    raise ArithmeticError(f"no convergence in {OUTER} outer steps")


def _blocks(n: int, sums: np.ndarray):
    """Centred vectors as blocks of doubles, from rows of x."""
    def run(batches):
        rows, have = [], 0
        for b in batches:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(sums))
            rows.append((n * x - sums) / n)
            have += len(x)
            if have >= BLOCK_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(rows).tobytes()], pa.binary())], ["block"])
                rows, have = [], 0
        if have:
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(rows).tobytes()], pa.binary())], ["block"])
    return run


def _squares(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([float((np.frombuffer(raw.as_buffer(), np.float64) ** 2).sum()) for raw in b.column("block")])], ["squares"])


def _partial(q: np.ndarray):
    d = len(q)

    def run(batches):
        total = None
        for b in batches:
            for raw in b.column("block"):
                c = np.frombuffer(raw.as_buffer(), np.float64).reshape(-1, d)
                part = c.T @ (c @ q)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])
    return run


def products(blocks: DataFrame, n: int) -> Product:
    """Covariance times a block of vectors, a Spark job each. What comes back is d numbers a vector and task."""
    def product(q: np.ndarray) -> np.ndarray:
        parts = map_arrow(blocks, _partial(q), "part binary").collect()
        found = sorted(bytes(r["part"]) for r in parts)  # the order of tasks is not theirs to choose
        return np.sum([np.frombuffer(p, np.float64).reshape(q.shape) for p in found], axis=0) / n
    return product


def _usable(c):
    return c.isNotNull() & (F.size(c) > 0) & F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))


def _whiten(n: int, sums: np.ndarray, vectors: np.ndarray, values: np.ndarray, trace: float, identity: float):
    k, root = len(values), np.sqrt(values)
    explained = values / trace

    def run(batches):
        for b in batches:
            m = b.num_rows
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(m, len(sums))
            if ((float(n) * x.astype(np.float64) - sums) ** 2).sum(axis=1).max(initial=0) > 2.0 ** 62.9:
                raise OverflowError("the deviation does not fit a long")
            wide = n * x - sums
            white = (wide / n) @ vectors / root
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, n)), pa.array(np.repeat((wide * wide).sum(axis=1), k)), pa.array(white.ravel()),
                 pa.array(np.tile(explained, m)), pa.array(np.full(m * k, identity))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    v = F.col(vector_col).cast("array<double>")
    rows = embeddings.select(F.col(id_col).alias("vec_id"), v.alias("v")).where(_usable(F.col("v")))
    id_type = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    none = embeddings.sparkSession.createDataFrame([], schema)
    dims = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if dims is None:
        return none
    d = dims["d"]
    rows = rows.where(F.size("v") == d).select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))
    fit = stored(rows.select("x").distinct())
    total = fit.agg(F.count("*").alias("n"), *[F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(d)]).first()
    n, sums = total["n"], np.asarray(total[1:], np.int64)
    blocks = stored(map_arrow(fit, _blocks(n, sums), "block binary"))
    product = products(blocks, n)
    trace = math.fsum(r["squares"] for r in map_arrow(blocks, _squares, "squares double").collect()) / n  # a number a block
    if not trace > 0:
        return none
    values, vectors, _ = jacobi_davidson(product, d, components)
    keep = values > d * np.finfo(np.float64).eps * values[0]
    values, vectors = values[keep], vectors[:, keep]
    scaled = vectors / np.sqrt(values)
    identity = float(np.abs(scaled.T @ product(scaled) - np.eye(len(values))).max())
    return map_arrow(rows, _whiten(n, sums, vectors, values, trace, identity), schema)
