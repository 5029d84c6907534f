"""Shifted CholeskyQR against exact integers and a dense eigenvalue solver."""

from fractions import Fraction

import numpy as np
import pytest

from ledgerlake.llm.whitening import COMPONENTS, Center, solved, triangular, whiten


def brute(vecs, k=COMPONENTS):
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for v in vecs], object)
    n, s = len(x), x.sum(axis=0)
    y = x * n - s
    cov = np.array([[float(Fraction(int(a @ b), n**3)) for b in y.T] for a in y.T])
    value, vector = np.linalg.eigh(cov)
    value, vector = value[::-1], vector[:, ::-1]
    keep = min(k, int((value > 1e-12 * value[0]).sum()))
    white = (y / n).astype(float) @ vector[:, :keep] / np.sqrt(value[:keep])
    return n, [int((r * r).sum()) for r in y], white, value[:keep] / np.trace(cov)


def check(rows, got):
    n, dev, white, explained = brute([v for _, v in rows])
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    use = white.shape[1]
    assert len(got) == len(rows) * use and sorted(by[rows[0][0]]) == list(range(1, use + 1))
    for c in range(use):
        mine = np.array([by[i][c + 1][0].whitened for i, _ in rows])
        side = np.sign(mine @ white[:, c])
        assert np.abs(mine * side - white[:, c]).max() < 1e-7 * max(1, np.abs(white[:, c]).max())
        assert abs(by[rows[0][0]][c + 1][0].explained / explained[c] - 1) < 1e-8
    assert all(r.n == n and r.identity_error < 1e-10 for r in got)
    assert [by[i][1][0].deviation for i, _ in rows] == dev


def test_against_exact_integers(spark):
    r = np.random.default_rng(1)
    mix = r.standard_normal((40, 40)) * np.logspace(0, -1.5, 40)
    rows = [(i, [float(np.float32(c)) for c in r.standard_normal(40) @ mix + 3]) for i in range(400)]
    bad = [(900, None), (901, [None, *rows[0][1][1:]]), (902, [float("nan"), *rows[0][1][1:]]), (903, [float("inf"), *rows[0][1][1:]]), (904, [1.0]), (905, []), (906, [1e300, *rows[0][1][1:]])]
    df = spark.createDataFrame([(i, v, "clash", 1.5) for i, v in rows + bad], "vec_id long, embedding array<double>, component string, whitened double")
    got = whiten(df.repartition(5)).collect()
    assert len(set(r.identity_error for r in got)) == 1
    check(rows, got)


def test_few_directions(spark):
    """A constant entry and a repeated one leave fewer components."""
    r = np.random.default_rng(2)
    rows = []
    for i in range(60):
        a, b, c = r.standard_normal(3) * [50, 1, 0.2]
        rows.append((i, [float(a), 7.0, float(b), float(a), float(c)]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in rows]
    got = whiten(df.repartition(3)).collect()
    assert {x.component for x in got} == {1, 2, 3}
    check(rows, got)


def test_edges(spark):
    schema = "vec_id long, embedding array<double>"
    assert whiten(spark.createDataFrame([], schema)).count() == 0
    assert whiten(spark.createDataFrame([(1, None), (2, [])], schema)).count() == 0
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).count() == 0
    got = whiten(spark.createDataFrame([(None, [0.0]), (3, [1.0]), (3, [1.0])], schema)).collect()
    assert sorted((x.vec_id or 0, round(abs(x.whitened), 9), x.n) for x in got) == [(0, round(2**0.5, 9), 3), (3, round(0.5**0.5, 9), 3), (3, round(0.5**0.5, 9), 3)]


def test_exact_beyond_64_bits():
    c = Center(10**10, [10**10 * 5 + 3])
    x = np.array([[5], [10**9]])
    assert c.deviation(x) == [9, None]
    assert c.rows(x)[1, 0] == pytest.approx(10**9 - 5)


def test_ill_conditioned():
    r = np.random.default_rng(3)
    q, _ = np.linalg.qr(r.standard_normal((300, 12)))
    v, _ = np.linalg.qr(r.standard_normal((12, 12)))
    want = np.logspace(0, -9, 12)
    rows = q * want @ v.T

    def gram(factors):
        a = rows
        for f in factors:
            a = solved(a, f)
        return a.T @ a

    got = np.linalg.svd(triangular(gram, 300), compute_uv=False)
    assert np.abs(got / want - 1).max() < 1e-5
