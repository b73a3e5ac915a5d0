"""The eigensolver against numpy's, whitened values against a plain computation, and odd rows."""

import numpy as np
import pandas as pd
import pytest

from cadence.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, component int, x string"


@pytest.mark.parametrize("d,k,n", [(64, 16, 2000), (200, 8, 1500), (8, 16, 100), (64, 16, 9), (1, 16, 5)])
def test_solver(d, k, n):
    r = np.random.default_rng(d + k)
    x = r.normal(size=(n, d)) * np.linspace(3, 0.2, d)
    x -= x.mean(axis=0)
    v = x.T @ x / n
    e, u, calls = whitening.jacobi_davidson(lambda q: x.T @ (x @ q) / n, d, k)
    want = np.sort(np.linalg.eigvalsh(v))[::-1][:min(k, d)]
    assert len(e) == min(k, d) and np.allclose(e, want, rtol=0, atol=1e-13 * want[0])
    assert np.linalg.norm(v @ u - u * e, axis=0).max() < 1e-13 * want[0]
    assert np.allclose(u.T @ u, np.eye(len(e)), atol=1e-13)
    assert calls < 150


def test_solver_with_equal_eigenvalues():
    q = np.linalg.qr(np.random.default_rng(3).normal(size=(120, 120)))[0]
    e0 = np.concatenate([[5, 5, 5, 4, 4, 3], np.linspace(1, 0.5, 114)])
    v = (q * e0) @ q.T
    e, u, _ = whitening.jacobi_davidson(lambda b: v @ b, 120, 6)
    assert np.allclose(e, e0[:6], atol=1e-12) and np.linalg.norm(v @ u - u * e, axis=0).max() < 1e-12


def test_minres_solves_side_by_side():
    r = np.random.default_rng(4)
    a = r.normal(size=(30, 30))
    a = a + a.T
    b = r.normal(size=(30, 3))
    shift = np.array([0.0, 1.0, -2.0])
    x = whitening.minres(lambda t: a @ t - t * shift, b, 200)
    for j in range(3):
        assert np.allclose((a - shift[j] * np.eye(30)) @ x[:, j], b[:, j], atol=1e-6)


def brute(vectors, components=16):
    x = (np.floor(64 * vectors) + 1_000_000).astype(np.int64)
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    c = (n * u - s) / n
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1], q[:, ::-1]
    k = min(components, int((e > 1e-10 * e[0]).sum()))
    return n, ((n * x - s) ** 2).sum(axis=1), ((n * x - s) / n) @ q[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def check(got, ids, vectors):
    n, deviation, white, explained = brute(vectors)
    k = white.shape[1]
    assert (got.n == n).all() and len(got) == len(ids) * k and sorted(got.component.unique()) == list(range(1, k + 1))
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    sign = np.sign((wide * white).sum(axis=0))
    assert np.allclose(wide * sign, white, atol=1e-8)
    assert (got.drop_duplicates("vec_id").set_index("vec_id").deviation.loc[ids].to_numpy() == deviation).all()
    assert np.allclose(got.groupby("component").explained.first(), explained, rtol=1e-10)
    assert got.identity_error.nunique() == 1 and got.identity_error.max() < 1e-9


def test_whole_table(spark):
    df = pd.read_parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = whitening.whiten(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")).toPandas()
    check(got, df.vec_id.to_numpy(), np.stack(df.embedding).astype(np.float64))


def test_odd_rows(spark):
    r = np.random.default_rng(9)
    good = [(i, [float(np.float32(v)) for v in r.normal(size=5)], 1, 7, "z") for i in range(40)]
    good += [(100 + i, good[0][1], 1, 7, "z") for i in range(20)]  # copies count once
    bad = [(200, None), (201, [1.0, None, 1.0, 1.0, 1.0]), (202, [float("nan")] * 5), (203, [float("inf"), 0.0, 0.0, 0.0, 0.0]),
           (204, []), (205, [1.0, 2.0])]
    df = spark.createDataFrame(good + [(i, v, None, None, None) for i, v in bad], SCHEMA)
    got = whitening.whiten(df).toPandas()
    check(got, [g[0] for g in good], np.asarray([g[1] for g in good], np.float32).astype(np.float64))
    twice = spark.createDataFrame([*good, (0, good[1][1], 1, 7, "z"), (None, good[2][1], 1, 7, "z")], SCHEMA)
    assert whitening.whiten(twice).count() == 62 * 5


def test_lists_of_low_rank(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    one = spark.createDataFrame([(1, [1.0, 2.0], 1, 1, "z"), (2, [1.0, 2.0], 1, 1, "z")], SCHEMA)
    assert whitening.whiten(one).collect() == []
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0], 1, 1, "z") for i in range(4)], SCHEMA)
    got = whitening.whiten(line).toPandas()
    assert list(got.component.unique()) == [1] and np.allclose(got.explained, 1) and np.allclose((got.whitened ** 2).mean(), 1)
