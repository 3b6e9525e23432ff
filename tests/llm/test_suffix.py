import random

import numpy as np
import pytest

from adledger.llm import suffix


def expected(docs):
    """{id: (spans, kept)} by remembering every window of 50 bytes."""
    first, out = {}, {}
    for i in sorted(docs, key=lambda i: (i is None, i)):
        data = (docs[i] or "").encode()
        covered = np.zeros(len(data) + 1, np.int64)
        for p in range(len(data) - 49):
            if first.setdefault(data[p:p + 50], i) != i:
                covered[p] += 1
                covered[min(p + 50, len(data))] -= 1
        mask = np.cumsum(covered[:-1]) > 0
        edge = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]])))
        out[i] = (edge.reshape(-1, 2).tolist(), np.frombuffer(data, np.uint8)[~mask].tobytes())
    return out


def run(df, **options):
    return {r["doc_id"]: ([list(s) for s in r["spans"]], bytes(r["kept"])) for r in suffix.remove_repeats(df, **options).collect()}


def shared_passages(seed=3, n=120):
    r = random.Random(seed)
    letters = "abcé "
    pool = ["".join(r.choices(letters, k=r.randint(30, 300))) for _ in range(15)] + ["To " * 40, "x" * 200]
    docs = {}
    for i in range(n):
        parts = []
        for _ in range(r.randint(0, 5)):
            p = r.choice(pool)
            a = r.randrange(len(p))
            parts += ["".join(r.choices(letters, k=r.randint(0, 40))), p[a // 2:len(p) - a // 3]]
        docs[i] = "".join(parts)
    return docs


@pytest.mark.parametrize("seed", [3, 4])
def test_equals_brute_force(docs_of, seed):
    docs = shared_passages(seed)
    assert run(docs_of(docs)) == expected(docs)


def test_groups_of_few_texts(docs_of, monkeypatch):
    monkeypatch.setattr(suffix, "BATCH_BYTES", 500)
    docs = shared_passages(7)
    assert run(docs_of(docs), least_shards=3) == expected(docs)


def test_edges_of_windows(docs_of):
    r = random.Random(1)
    passage = "".join(r.choices("abcdefghijklm", k=50))
    noise = lambda: "".join(r.choices("nopqrstuvwxyz", k=70))
    docs = {1: passage, 2: noise() + passage + noise(), 3: passage[:49] + noise(), 4: noise() + passage[1:], 5: passage + passage, 6: passage}
    got = run(docs_of(docs))
    assert got == expected(docs) and got[2][0] == [[70, 120]] and got[6] == ([[0, 50]], b"") and got[3][0] == []


def test_many_copies_and_own_repeats(docs_of):
    text = " ".join(f"number {i} of a longer text" for i in range(60))
    docs = {i: text for i in range(40)} | {100: text[200:] + text[:300], 101: "ab" * 500, 102: "ab" * 30}
    assert run(docs_of(docs)) == expected(docs)


def test_loser_merge():
    r = random.Random(2)
    for runs in (1, 2, 3, 7, 16):
        strings = [sorted(bytes(r.choices(b"ab", k=r.randint(1, 12))) for _ in range(r.randint(0, 30))) for _ in range(runs)]
        coded = [suffix.front_code(s) for s in strings]
        assert [suffix.front_decode(*c) for c in coded] == strings
        run, place, shared = suffix.loser_merge([(s, list(c[0])) for s, c in zip(strings, coded)])
        merged = [strings[a][b] for a, b in zip(run, place)]
        assert merged == sorted(x for s in strings for x in s)
        assert shared[1:] == [suffix.common(a, b) for a, b in zip(merged, merged[1:])]


def test_known_prefixes_are_not_compared_again(monkeypatch):
    """Strings with a long common prefix: the merge looks at each byte beyond it only."""
    looked = []
    real = suffix.common
    strings = [sorted(b"p" * 45 + bytes([97 + i, 97 + j, 0, 0, 0]) for j in range(20)) for i in range(8)]
    coded = [suffix.front_code(s) for s in strings]
    monkeypatch.setattr(suffix, "common", lambda a, b, start=0: looked.append(real(a, b, start) - start) or real(a, b, start))
    suffix.loser_merge([(s, list(c[0])) for s, c in zip(strings, coded)])
    assert sum(looked) <= 7 * 45 + 5 * 160


@pytest.mark.parametrize("batch_bytes", [500, 2 << 20])
def test_anchors_of_many_classes(docs_of, monkeypatch, batch_bytes):
    """A footer between different neighbours is settled by string hashes, not in one merge."""
    r = random.Random(9)
    noise = lambda n: "".join(r.choices("abcdefghijklmnop", k=n))
    docs = shared_passages(5, 60) | {1000 + i: noise(60) + "All rights reserved by us, 2024 " * (1 + i % 2) + noise(60) for i in range(150)}
    real = suffix.merge_runs

    def bounded(runs):
        ends = [s[:16] for i in range(runs.num_rows) for s in suffix.front_decode(*(runs.column(n)[i].as_py() for n in ("shared", "lengths", "tails")))]
        assert max(ends.count(e) for e in {*ends}) <= 20
        return real(runs)

    monkeypatch.setattr(suffix, "merge_runs", bounded)
    monkeypatch.setattr(suffix, "BATCH_BYTES", batch_bytes)
    assert run(docs_of(docs), most_classes=20) == expected(docs)
    with pytest.raises(Exception, match="AssertionError"):
        run(docs_of(docs))


@pytest.mark.parametrize("partitions", [1, 4])
def test_groups_with_equal_ids(spark, monkeypatch, partitions):
    """Null ids that fill several groups, short and long, and one long document landed again."""
    monkeypatch.setattr(suffix, "BATCH_BYTES", 400)
    long = " ".join(f"number {i} of a longer text" for i in range(40))
    rows = [(None, f"null {i}") for i in range(400)] + [(None, f"{i} " * 300) for i in range(10, 18)] + [(7, long)] * 9
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    got = suffix.remove_repeats(df, least_shards=3).collect()
    assert sorted((r["doc_id"] or 0, bytes(r["kept"]).decode()) for r in got) == sorted((i or 0, t) for i, t in rows)


def test_odd_documents(odd_docs, no_docs):
    rows = suffix.remove_repeats(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert sorted((r["n_bytes"], len(r["kept"])) for r in rows if r["doc_id"] == 1) == [(80, 80)] * 2 or all(r["n_bytes"] == len(r["kept"]) for r in rows if r["doc_id"] == 1)
    assert [len(r["kept"]) for r in rows if r["doc_id"] == 2] == [0] and sorted(len(r["kept"]) for r in rows if r["doc_id"] is None) == [0, 0]
    assert [r["n_bytes"] for r in rows if r["doc_id"] == 3] == [0] and suffix.remove_repeats(no_docs).count() == 0


@pytest.mark.parametrize("seed", [5, 6])
def test_sql_equals_brute_force(docs_of, spark, tmp_path, seed):
    """The registered SQL, which shares no step with the operator, on planted passages and odd texts."""
    import hashlib

    import duckdb

    from adledger.llm.oracles import OP8_SQL

    docs = {**shared_passages(seed, 60), 200: None, 201: "", 202: "é" * 700, 203: "ü" + "é" * 24 + "e", 204: "z" * 2500, 205: "y" * 49 + "z" * 1200}
    place = str(tmp_path / "documents")
    docs_of(docs).write.parquet(place)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{place}/*.parquet'")
    got = {r[0]: r[1:] for r in con.execute(f"SELECT doc_id, n_bytes, n_removed, n_spans, kept_sha256 FROM ({OP8_SQL})").fetchall()}
    want = {}
    for i, (spans, kept) in expected(docs).items():
        size = len((docs[i] or "").encode())
        want[i] = (size, size - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
    assert got == want and sum(w[2] for w in want.values()) > 20
