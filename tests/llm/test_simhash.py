import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from adledger.llm import simhash
from adledger.llm.components import connected


def plain_print(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return simhash.signed(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))


def plain_components(prints, radius=3):
    """{position: smallest position reachable} by comparing all pairs."""
    a = np.array(prints, np.int64).view(np.uint64)
    root = list(range(len(a)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i] ^ a[:i]) <= radius):
            x, y = find(i), find(int(j))
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(a))]


def clustered(n, r, flips=6):
    centres = [r.getrandbits(64) for _ in range(max(1, n // 25))]
    return [simhash.signed(c ^ sum(1 << b for b in r.sample(range(64), r.randint(0, flips)))) for c in r.choices(centres, k=n)]


def test_fingerprints(spark, docs_of):
    texts = {1: "One two\tthree FOUR five", 2: "a b", 3: "É é x", 4: None, 5: "", 6: "a a a a a a b", 7: "x " * 100_000, 8: "a b c d"}
    got = {r["doc_id"]: r["fingerprint"] for r in simhash.fingerprint(docs_of(texts)).collect()}
    assert got == {i: plain_print(t) for i, t in texts.items()}
    assert got[2] == spark.range(1).select(F.xxhash64(F.lit("a b"))).first()[0]


def test_gray_order():
    values = np.arange(16, dtype=np.uint64)
    code = values ^ (values >> np.uint64(1))
    assert (simhash.gray_rank(code) == values).all()


@pytest.mark.parametrize("n", [1, 2, 9, 700, 1500])
def test_index_finds_every_link(n):
    r = random.Random(n)
    prints = np.unique(np.array(clustered(n, r), np.int64).view(np.uint64))
    prints = prints[np.argsort(simhash.gray_rank(prints))]
    found = set()
    index = simhash.GrayIndex(prints)
    for depth, rows, nodes in index.search(prints, 3):
        span = simhash.FAN**depth
        pairs = [(q, m) for q, node in zip(rows.tolist(), nodes.tolist()) for m in range(node * span, min((node + 1) * span, len(prints)))]
        assert not found & set(pairs)
        found |= set(pairs)
    near = np.bitwise_count(prints[:, None] ^ prints[None]) <= 3
    assert found == {(i, j) for i, j in zip(*map(np.ndarray.tolist, np.nonzero(near)))}
    label = simhash.forest(prints, 3)
    assert label.tolist() == plain_components(prints.view(np.int64).tolist())


@pytest.mark.parametrize("most", [20_000, 4])
def test_components(spark, most):
    """Also with keys that hold more than they may and are dealt again."""
    r = random.Random(1)
    prints = clustered(600, r) + [0, 0, 7, 15, -1]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(prints)], "doc_id long, fingerprint long")
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(df, most=most).collect()}
    assert [got[i] for i in range(len(prints))] == plain_components(prints)


def test_connected(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (101, 100), (200, 105), (105, 104), (None, 3)]
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "u long, v long").filter("u IS NOT NULL")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 200: 104, 105: 104, 104: 104}
    assert connected(spark.createDataFrame([], "u long, v long")).count() == 0


def test_odd_documents(odd_docs, no_docs):
    out = simhash.near_duplicates(simhash.fingerprint(odd_docs))
    assert out.count() == odd_docs.count()
    by_id = {(r["doc_id"], r["component_id"]) for r in out.collect()}
    assert {(1, 1), (2, 1), (None, 1), (3, 3), (4, 3), (None, 3), (5, 3)} <= by_id
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 6, 6, 7, 8]
    assert simhash.near_duplicates(simhash.fingerprint(no_docs)).count() == 0 and simhash.keep_one(no_docs).count() == 0


def test_groups_without_ids_keep_one_row_each(docs_of, spark):
    df = spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e"), (None, "quite another text here")], "doc_id long, text string")
    assert simhash.keep_one(df).count() == 2
