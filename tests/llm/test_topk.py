import math
import random

import pytest
from pyspark.sql import functions as F

from adledger.llm import topk


def expected(rows, asks, k):
    scaled = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [math.floor(float(x) * 1024) for x in v]
        scaled[i] = min(scaled.get(i, v), v)
    out = set()
    for q in filter(asks, scaled):
        found = sorted((-sum(a * b for a, b in zip(scaled[q], v)), i) for i, v in scaled.items() if i != q and len(v) == len(scaled[q]))
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])}
    return out


def run(spark, rows, k=5, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 10 == 0, k, **options).select("query_id", "rank", "vec_id", "score").collect()}


@pytest.mark.parametrize("stretch", [0.0, 3.0])
def test_equals_brute_force(spark, stretch):
    """Equal lengths (no length pruning possible) and lengths over several bands."""
    r = random.Random(5)
    rows = [(i, [r.gauss(0, 1) * math.exp(r.random() * stretch) for _ in range(8)]) for i in range(300)]
    assert run(spark, rows, per_block=32, queries_per_block=8) == expected(rows, lambda i: i % 10 == 0, 5)


def test_clusters_use_coordinate_pruning(spark, monkeypatch):
    r = random.Random(6)
    centres = [[r.gauss(0, 1) for _ in range(12)] for _ in range(6)]
    rows = [(i, [x + r.gauss(0, 0.02) for x in centres[i % 6]]) for i in range(240)]
    assert run(spark, rows, k=3, per_block=40, queries_per_block=8) == expected(rows, lambda i: i % 10 == 0, 3)


def test_odd_rows(spark):
    one = [0.5, 0.25]
    rows = [(0, one), (0, one), (1, one), (2, one), (3, [0.25, 0.5]), (4, None), (5, [None, 1.0]), (6, [math.nan, 1.0]), (7, [math.inf, 0.0]),
            (None, one), (10, [0.0, 0.0]), (20, [1.0, 2.0, 3.0]), (30, [-1.0, -1.0]), (40, []), (50, [])]
    assert run(spark, rows) == expected(rows, lambda i: i % 10 == 0, 5)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**30 + i), 1.0 / 1024]) for i in range(0, 40)]
    got = run(spark, rows)
    want = {(q, r, i, min(s, 2**63 - 1)) for q, r, i, s in expected(rows, lambda i: i % 10 == 0, 40)}
    assert {(q, i, s) for q, _, i, s in got} <= {(q, i, s) for q, _, i, s in want} and len(got) == 20
    assert all(s == 2**63 - 1 for _, _, _, s in got)  # beyond a long: cut to its end


def test_components_of_any_size_take_part(spark):
    """Up to the largest float; scores beyond a long are cut to its ends and tie there."""
    r = random.Random(9)
    big = [8e12, 3.4e38, -3.4e38, 2.0**42, 2.0**60 + 2.0**20, -(2.0**52) / 1024, 0.5, 1.0, 0.0]
    rows = [(i, [r.choice(big), r.choice(big)]) for i in range(60)] + [(100, [1.0, 1.0]), (101, [8e12, 0.0]), (110, [2.0**-10, 0.0]), (111, [8e12, -1.0])]
    got = run(spark, rows, k=70)
    long = lambda s: max(-(2**63), min(s, 2**63 - 1))
    scaled = {i: [math.floor(x * 1024) for x in v] for i, v in rows}
    want = set()
    for q in (i for i in scaled if i % 10 == 0):
        found = sorted((-long(sum(a * b for a, b in zip(scaled[q], v))), i) for i, v in scaled.items() if i != q)
        want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(found)}
    assert got == want and any(q == 110 and v == 101 and s == 8192000000000000 for q, _, v, s in got)


def test_empty(spark):
    assert run(spark, []) == set()
    assert run(spark, [(1, [1.0])]) == set()
