import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from adledger.llm import bidiagonal, whitening


def brute(rows, components=4):
    """{(id, component): (n, deviation, |whitened|, explained)} by numpy's symmetric eigensolver on exact integers."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in kept), default=0)
    kept = [(i, [math.floor(c * 256) for c in v] + [0] * (width - len(v))) for i, v in kept]
    fit = np.array(sorted({tuple(x) for _, x in kept}), np.float64)
    n, sums = len(fit), [sum(int(c) for c in column) for column in fit.T]
    values, vectors = np.linalg.eigh(np.cov(fit.T, bias=True).reshape(width, width))
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = []
    for i, x in kept:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        centred = np.array([c - s / n for c, s in zip(x, sums)])
        for j, value in enumerate(values):
            out.append((i, j + 1, n, deviation, abs(float(centred @ vectors[:, j])) / math.sqrt(value), value / np.trace(np.cov(fit.T, bias=True).reshape(width, width))))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("extra") for c in ("x", "n", "component", "factor", "part")})
    return whitening.whiten(df.repartition(5), **options).collect()


def compare(got, want):
    got = sorted(((r["vec_id"], r["component"], r["n"], r["deviation"], abs(r["whitened"]), r["explained"]) for r in got), key=str)
    want = sorted(want, key=lambda r: (str(r[0]), r[1], r[4]))
    got = sorted(got, key=lambda r: (str(r[0]), r[1], r[4]))
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-9, atol=1e-9)


def test_equals_eigensolver(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", 16)
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    r = np.random.default_rng(3)
    vectors = r.normal(size=(200, 12)) * np.linspace(3, 0.2, 12) + 5
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(1000 + i, vectors[7].tolist()) for i in range(90)]
    got = run(spark, rows)
    compare(got, brute(rows))
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-10


def test_signs_are_one_choice_for_all_rows(spark):
    r = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(r.normal(size=(50, 6)) * [4, 3, 2, 1, 1, 1])]
    got = {(x["vec_id"], x["component"]): x["whitened"] for x in run(spark, rows)}
    x = np.floor(np.array([v for _, v in rows]) * 256)
    for c in range(1, 5):
        w = np.array([got[i, c] for i in range(50)])
        assert np.allclose(np.abs(np.linalg.lstsq(x - x.mean(axis=0), w, rcond=None)[0] @ (x - x.mean(axis=0)).T), np.abs(w))


def test_odd_rows(spark):
    rows = [(1, [1.0, 2.0, 0.5]), (1, [1.0, 2.0, 0.5]), (None, [0.25, -1.0, 3.0]), (2, None), (3, [None, 1.0, 1.0]), (4, [math.nan, 0.0, 0.0]),
            (5, [math.inf, 0.0, 0.0]), (6, [-0.0, 0.0]), (7, []), (8, [2.0, -2.0, 1.5]), (9, [0.001, -0.001, 0.0])]
    got = run(spark, rows)
    assert sorted({str(r["vec_id"]) for r in got}) == ["1", "6", "7", "8", "9", "None"] and max(r["component"] for r in got) == 3
    compare(got, brute(rows))


def test_too_few_directions(spark):
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(6)]
    got = run(spark, line)
    assert {r["component"] for r in got} == {1} and abs(got[0]["explained"] - 1) < 1e-12 and got[0]["identity_error"] < 1e-9
    assert run(spark, []) == [] and run(spark, [(1, None)]) == [] and run(spark, [(1, []), (2, [])]) == []
    assert run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(2**30 + i * i), float(-(2**29) * i), 3.0]) for i in range(9)]
    got = {r["vec_id"]: r["deviation"] for r in run(spark, rows)}
    x = [[math.floor(c * 256) for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    assert got == {i: min(sum((9 * c - s) ** 2 for c, s in zip(v, sums)), 2**63 - 1) for i, v in enumerate(x)}
    huge = run(spark, [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 0.0])])
    assert {r["deviation"] for r in huge if r["vec_id"] != 3} == {2**63 - 1}


@pytest.mark.parametrize("kind", ["random", "graded", "repeated", "low rank", "diagonal"])
def test_solver(kind):
    r = np.random.default_rng(1)
    q = lambda n: np.linalg.qr(r.normal(size=(n, n)))[0]
    m = {"random": lambda: r.normal(size=(50, 50)), "graded": lambda: r.normal(size=(40, 40)) * np.exp(-np.arange(40.0)),
         "repeated": lambda: q(30) @ np.diag([5, 5, 5, 5, 4.99999, 1] + [0.1] * 24) @ q(30),
         "low rank": lambda: r.normal(size=(30, 3)) @ r.normal(size=(3, 30)), "diagonal": lambda: np.diag([3.0, 3.0, 0.0, 2.0])}[kind]()
    factor = np.linalg.qr(m, mode="r")
    s = np.linalg.svd(m)[1]
    values, vectors = bidiagonal.leading(factor, 4, 1e-10)
    assert len(values) == min(4, int((s > 1e-10 * s[0]).sum())) and np.allclose(np.sqrt(values), s[:len(values)], rtol=1e-12)
    assert np.abs(m.T @ (m @ vectors) - vectors * values).max() < 1e-12 * s[0] ** 2
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    a, b, _ = bidiagonal.bidiagonalise(factor)
    assert np.allclose(np.sqrt(np.maximum(bidiagonal.dqds(a, b), 0)), s, atol=1e-12 * s[0])


def test_small_values_are_relatively_accurate():
    """A bidiagonal fixes its smallest singular values to full relative accuracy; so does dqds."""
    a, b = np.array([1.0, 1e-5, 1e-10, 1e-15]), np.array([1e-3, 1e-8, 1e-12])
    got = np.sqrt(bidiagonal.dqds(a, b))
    assert np.allclose(np.prod(got), np.prod(a), rtol=1e-13) and np.all(np.diff(got) < 0)
