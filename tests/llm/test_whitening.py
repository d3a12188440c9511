"""Whitening against numpy's eigenvectors and exact integers."""

import numpy as np
import pytest

from vigil.llm import queries, whitening

NAN, INF = float("nan"), float("inf")


def _check(rows, out, most=8):
    """rows: id -> vector; out: id -> row of whiten()."""
    ids = sorted(rows)
    x = [[int(np.floor(1024 * float(c))) + 100000 for c in rows[i]] for i in ids]
    n, d = len(ids), len(x[0])
    s = [sum(v[k] for v in x) for k in range(d)]
    dev = [sum((n * v[k] - s[k]) ** 2 for k in range(d)) for v in x]
    assert [int(out[i].deviation) for i in ids] == dev and {out[i].n for i in ids} == {n}
    y = np.array([[(n * v[k] - s[k]) / n for k in range(d)] for v in x])
    e, u = np.linalg.eigh(y.T @ y / n)
    keep = [k for k in np.argsort(-e) if e[k] > 1e-9 * e.max()][:most]
    got = np.array([out[i].whitened for i in ids])
    want = y @ u[:, keep] / np.sqrt(e[keep])
    assert got.shape == want.shape
    turn = np.sign((got * want).sum(axis=0))
    assert np.abs(got * turn - want).max() < 1e-6
    assert np.allclose(out[ids[0]].explained, e[keep] / e.sum(), rtol=1e-9)
    assert np.abs(got.T @ got / n - np.eye(len(keep))).max() < 1e-9 and out[ids[0]].identity_error < 1e-9


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    df = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")
    _check(rows, {r.vec_id: r for r in whitening.whiten(df).collect()})
    out = queries.QUERIES["op13_whitening"](spark, sf)
    assert dict(out.dtypes) | {"n": "bigint", "deviation": "bigint", "component": "int", "whitened": "double"} == dict(out.dtypes)
    assert out.count() == 8 * len(rows)


@pytest.mark.parametrize("spread", [1.0, 1e7, 1e14, 1e300])
def test_sizes_and_rank(spark, spread):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(400, 3)) * [spread, 2.0, 1.0]
    rows = {i: [float(a), float(b), float(c), float(a), 0.5] for i, (a, b, c) in enumerate(base)}
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>").repartition(7)
    out = {r.vec_id: r for r in whitening.whiten(df).collect()}
    if spread == 1.0:
        _check(rows, out)
    x = [[(int(c) * 1024 if abs(c) > 2**53 else int(np.floor(1024 * c))) + 100000 for c in rows[i]] for i in sorted(rows)]
    s = [sum(v[k] for v in x) for k in range(5)]
    assert [int(out[i].deviation) for i in sorted(rows)] == [sum((400 * v[k] - s[k]) ** 2 for k in range(5)) for v in x]
    got = np.array([out[i].whitened for i in sorted(rows)])
    assert got.shape[1] <= 3 and np.abs(got.T @ got / 400 - np.eye(got.shape[1])).max() < 1e-4


def test_small_eigenvalues_keep_their_digits():
    rng = np.random.default_rng(5)
    u = np.linalg.qr(rng.normal(size=(12, 12)))[0]
    want = 10.0 ** -np.arange(12)
    v = (u.astype(np.longdouble) * want) @ u.T.astype(np.longdouble)
    values, vectors = whitening.components(v)
    assert np.allclose(np.asarray(values[:9], float), want[:9], rtol=1e-6)
    assert np.abs(np.asarray(vectors @ vectors.T, float) - np.eye(len(vectors))).max() < 1e-12


def test_odd_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, None), (3, [NAN, 1.0]), (4, [1.0, INF]), (5, [1.0, None]), (6, []), (7, [3.0, 2.5]), (7, [3.0, 2.5]),
            (None, [0.0, 0.0]), (8, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(i, v, "mine", "mine") for i, v in rows], "vec_id long, embedding array<double>, n string, _v string")
    out = whitening.whiten(df).collect()
    assert sorted((str(r.vec_id), r.width, r.n) for r in out) == [
        ("1", 2, 4), ("6", 0, 1), ("7", 2, 4), ("7", 2, 4), ("8", 3, 1), ("None", 2, 4)]
    assert {r._v for r in out} == {"mine"} and all(r.whitened == [] for r in out if r.width != 2)
    two = np.array([r.whitened for r in out if r.width == 2])
    assert np.abs(two.T @ two / 4 - np.eye(2)).max() < 1e-9
    assert whitening.whiten(df.limit(0)).count() == 0
