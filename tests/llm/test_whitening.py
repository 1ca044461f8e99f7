"""Whitening against a dense eigensolver, and odd embeddings."""

import numpy as np
import pytest

from twinscope.llm import queries, whitening

from .conftest import rows_of

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def dense(rows):
    x = np.unique(np.floor(256 * np.array(rows, float)).astype(np.int64), axis=0)
    e, q = np.linalg.eigh(np.cov(x.T.astype(float), bias=True).reshape(x.shape[1], x.shape[1]))
    return x, e[::-1], q[:, ::-1]


def test_query_against_dense(spark):
    rows = {r.vec_id: list(r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    x, e, q = dense(list(rows.values()))
    got = rows_of(queries.op12_whitening(spark, SF))
    assert len(got) == 4 * len(rows)
    signs = {}
    for r in got:
        own, k = np.floor(256 * np.array(rows[r["vec_id"]])).astype(np.int64), r["component"] - 1
        assert r["n"] == len(x)
        assert r["deviation"] == int(((len(x) * own - x.sum(axis=0)) ** 2).sum())
        want = (own - x.mean(axis=0)) @ q[:, k] / np.sqrt(e[k])
        signs.setdefault(k, np.sign(want * r["whitened"]))
        assert r["whitened"] * signs[k] == pytest.approx(want, rel=1e-9, abs=1e-10)
        assert r["explained"] == pytest.approx(e[k] / e.sum(), rel=1e-10)
        assert r["identity_error"] < 1e-10


@pytest.mark.parametrize(("dim", "wanted"), [(1, 4), (3, 4), (40, 4), (300, 6)])
def test_eigenvectors(dim, wanted):
    rng = np.random.default_rng(dim)
    q = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    # Close, equal and zero eigenvalues.
    e = np.sort(rng.random(dim) + 0.1)[::-1]
    e[2:5] = e[2:3]
    e[dim // 2 + 3 :] = 0
    a = (q * e) @ q.T
    values, vectors = whitening.jacobi_davidson(lambda u: a @ u, dim, wanted)
    assert np.allclose(values, np.sort(e)[::-1][:wanted], rtol=1e-12, atol=1e-13)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
    assert np.linalg.norm(a @ vectors - vectors * values, axis=0).max() < 1e-12


def test_inner_solver_solves_the_projected_equation(monkeypatch):
    monkeypatch.setattr(whitening, "INNER_STEPS", 60)
    monkeypatch.setattr(whitening, "INNER_LEFT", 1e-13)
    rng = np.random.default_rng(1)
    a = rng.standard_normal((20, 20))
    a = a + a.T
    locked = np.linalg.qr(rng.standard_normal((20, 2)))[0]
    u = whitening._orthonormal(rng.standard_normal((20, 2)), locked)
    theta = np.einsum("ij,ij->j", u, a @ u)
    r = whitening._outside(a @ u - u * theta, locked)
    t = whitening.corrections(lambda v: a @ v, theta, u, r, locked)
    for c in range(2):
        base = np.hstack([locked, u[:, c : c + 1]])
        p = np.eye(20) - base @ base.T
        assert np.allclose(p @ (a - theta[c] * np.eye(20)) @ p @ t[:, c], -p @ r[:, c], atol=1e-8)


ODD = [(1, [0.5, -0.25]), (1, [0.5, -0.25]), (None, [0.1, 3.0]), (2, None), (3, [NAN, 1.0]), (4, [INF, 1.0]), (5, [None, 1.0]), (6, []), (7, [-0.0, 0.0]), (8, [0.001, 0.0])]
SCHEMA = "vec_id long, embedding array<float>"


def test_odd_rows(spark):
    rows = spark.createDataFrame(ODD, SCHEMA).selectExpr("*", "'x' AS deviation", "'y' AS whitened", "'z' AS label")
    model = whitening.fit(rows)
    good = [v for _, v in ODD if v and None not in v and np.isfinite(v).all()]
    x, e, q = dense(np.array(good, np.float32))
    # Vectors that differ by less than a step are one.
    assert model.n == len(x) == 3 and model.sums == x.sum(axis=0).tolist() and len(model.values) == 2
    assert np.allclose(model.values, e) and model.identity_error < 1e-12
    out = rows_of(whitening.transform(rows, model))
    assert sorted(str(r["vec_id"]) for r in out) == ["1", "1", "7", "8", "None"]
    assert all(r["label"] == "z" and len(r["whitened"]) == 2 for r in out)


def test_few_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    model = whitening.fit(none)
    assert model.n == 0 and rows_of(whitening.transform(none, model)) == []
    one = spark.createDataFrame([(1, [1.0, 2.0])] * 3, SCHEMA)
    model = whitening.fit(one)
    assert model.n == 1 and len(model.values) == 0
    assert [(r["deviation"], r["whitened"]) for r in rows_of(whitening.transform(one, model))] == [(0, [])] * 3
    line = spark.createDataFrame([(k, [float(k), 2.0 * k, 0.0]) for k in range(5)], SCHEMA)
    model = whitening.fit(line)
    assert len(model.values) == 1 and model.values[0] / model.trace == pytest.approx(1)
    only_null = spark.createDataFrame([(1, None)], SCHEMA)
    assert rows_of(whitening.transform(only_null, whitening.fit(only_null))) == []


def test_errors(spark):
    with pytest.raises(Exception, match="lengths"):
        whitening.fit(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], SCHEMA).coalesce(1))
    with pytest.raises(Exception, match="not below"):
        whitening.fit(spark.createDataFrame([(1, [1e30])], SCHEMA))
    far = spark.createDataFrame([(1, [3e13]), (2, [-3e13]), (3, [1.0])], "vec_id long, embedding array<double>")
    model = whitening.fit(far)
    assert model.n == 3
    with pytest.raises(Exception, match="64 bits"):
        rows_of(whitening.transform(far, model))
