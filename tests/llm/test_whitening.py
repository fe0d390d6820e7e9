import math

import numpy as np
import pytest

from vaultfeed.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows):
    """n, deviation by vec_id, eigenvalues, unit vectors and centred rows, by exact integers and a library solver."""
    good = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    deviation = {i: sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)) for i, x in good}
    z = np.array([[(n * a - s) / n for a, s in zip(x, sums, strict=True)] for x in fit])
    values, vectors = np.linalg.eigh(z.T @ z / n)
    centred = {i: np.array([(n * a - s) / n for a, s in zip(x, sums, strict=True)]) for i, x in good}
    return n, deviation, values[::-1], vectors[:, ::-1], centred


def compare(df, rows):
    n, deviation, values, vectors, centred = brute(rows)
    got = df.collect()
    k = min(16, int((values > values[0] * 1e-12).sum()))
    assert sorted((r.vec_id, r.component) for r in got) == sorted((i, c) for i in centred for c in range(1, k + 1))
    signs = {}
    for r in got:
        c = r.component - 1
        assert r.n == n and r.deviation == deviation[r.vec_id]
        assert r.explained == pytest.approx(values[c] / values.sum(), rel=1e-9)
        assert r.identity_error < 1e-9
        want = centred[r.vec_id] @ vectors[:, c] / math.sqrt(values[c])
        if abs(want) > 1e-6:
            assert signs.setdefault(c, np.sign(want * r.whitened)) == np.sign(want * r.whitened)
        assert abs(r.whitened) == pytest.approx(abs(want), rel=1e-6, abs=1e-6)


def test_query_equals_library_solver(spark, sf, con):
    rows = con.sql("select vec_id, embedding from embeddings").fetchall()
    compare(queries.op11_whitening(spark, sf), rows)


def test_eigen_of_an_ill_conditioned_matrix():
    dice = np.random.default_rng(3)
    q, _ = np.linalg.qr(dice.normal(size=(40, 40)))
    truth = 10.0 ** -np.arange(40)
    values, vectors = whitening.eigen(q * truth @ q.T, 8)
    assert np.allclose(values, truth[:8], rtol=1e-8)
    assert np.allclose(np.abs((vectors * q[:, :8]).sum(axis=0)), 1)


def test_cholesky_has_the_rank():
    base = np.random.default_rng(1).normal(size=(9, 4))
    factor, order = whitening.pivoted_cholesky(base @ base.T)
    assert factor.shape == (9, 4)
    assert np.allclose(factor @ factor.T, (base @ base.T)[np.ix_(order, order)])
    assert np.allclose(np.triu(factor, 1), 0)


def test_awkward_rows(spark):
    dice = np.random.default_rng(5)
    rows = [(i, dice.normal(size=3).astype(np.float32).tolist()) for i in range(30)]
    odd = [(100, None), (101, [1.0, None, 2.0]), (102, [1.0, float("nan"), 2.0]), (103, [float("inf"), 0.0, 0.0]), (3, rows[3][1]), (104, rows[4][1])]
    got = whitening.digests(spark.createDataFrame(rows + odd, SCHEMA).selectExpr("*", "1 as x", "2 as n", "3 as component"))
    assert got.where("vec_id = 3").count() == 6  # a repeated row stays twice
    compare(got.distinct(), rows + [(104, rows[4][1])])


def test_degenerate_tables(spark):
    def run(rows):
        return whitening.digests(spark.createDataFrame(rows, SCHEMA)).collect()

    assert run([]) == [] and run([(1, None)]) == [] and run([(1, [])]) == []
    assert run([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []  # no variance, no component
    got = run([(1, [1.0, 2.0]), (2, [3.0, 2.0]), (None, [3.0])])  # the short one is (3, 0)
    assert {(r.vec_id, r.component) for r in got} == {(i, c) for i in (1, 2, None) for c in (1, 2)} and got[0].n == 3
    huge = run([(1, [3e38, 0.0]), (2, [-3e38, 1.0])])
    assert {r.deviation for r in huge} == {None} and all(math.isfinite(r.whitened) for r in huge)
