import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from adledger.llm import linededup, queries


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(line, r, edits, letters="abcdé "):
    out = list(line)
    for _ in range(edits):
        i = r.randrange(len(out) + 1)
        kind = r.random()
        if kind < 0.33:
            out.insert(i, r.choice(letters))
        elif kind < 0.66 and out:
            out.pop(min(i, len(out) - 1))
        elif out:
            out[min(i, len(out) - 1)] = r.choice(letters)
    return "".join(out)


def expected(docs, k=2, least=24):
    """{id: (n_lines, n_removed, n_links, text)} by comparing all pairs of lines."""
    first = {}
    for i in sorted(docs):
        for n, line in enumerate((docs[i] or "").split("\n")):
            if len(line) >= least:
                first.setdefault(line, (i, n))
    near, links = set(), Counter()
    lines = list(first)
    for x, a in enumerate(lines):
        for b in lines[x + 1:]:
            if abs(len(a) - len(b)) <= k and distance(a, b) <= k:
                near.add(max(a, b, key=first.get))
                links.update({first[a][0], first[b][0]})
    out = {}
    for i, text in docs.items():
        lines = (text or "").split("\n")
        stay = [x for n, x in enumerate(lines) if len(x) < least or first[x] == (i, n) and x not in near]
        out[i] = (len(lines) if text else 0, len(lines) - len(stay), links[i], text if len(stay) == len(lines) else "\n".join(stay))
    return out


def run(df, **options):
    return {r["doc_id"]: (r["n_lines"], r["n_removed"], r["n_links"], r["text"]) for r in linededup.dedup_lines(df, **options).collect()}


@pytest.mark.parametrize("k", [1, 2, 3])
def test_banded_distance(spark, k):
    r = random.Random(k)
    pairs = [(a, edited(a, r, r.randint(0, k + 2))) for a in ("".join(r.choices("abé", k=r.randint(1, 50))) for _ in range(800))]
    df = spark.createDataFrame([p for p in pairs if p[1] and abs(len(p[0]) - len(p[1])) <= k], "a string, b string")
    out = df.select(linededup.banded_distance(F.col("a"), F.col("b"), k).alias("d"), F.levenshtein("a", "b").alias("e"))
    assert out.filter(f"(e <= {k} AND d <> e) OR (e > {k} AND d <= {k})").count() == 0


def planted(seed=4):
    r = random.Random(seed)
    stems = ["".join(r.choices("abcdé ", k=r.randint(24, 60))) for _ in range(25)]
    return {i: "\n".join([*(edited(s, r, r.randint(0, 4)) for s in r.sample(stems, r.randint(0, 4))), "short"][:: r.choice([1, -1])]) for i in range(60)}


@pytest.mark.parametrize("most", [200_000, 3])
def test_equals_brute_force(docs_of, most):
    """Also when nearly every segment counts as too common and is cut again."""
    docs = planted()
    assert run(docs_of(docs), most_pairs=most) == expected(docs)


def test_lines_that_share_all_but_a_number(docs_of):
    docs = {i: f"visitor number {i * 37 % 1000:03d} has entered the main hall" for i in range(80)}
    assert run(docs_of(docs), most_pairs=50) == expected(docs)


def test_copies_and_places(docs_of):
    line, other = "this very line stands in many documents", "and this one stands nowhere else at all"
    docs = {5: line, 3: f"{line}\n{other}\n{line}", 9: f"x\n\n{line}!", 10: "\n".join([line] * 500), 11: "", 12: None, 13: "\n\n", 14: line + "\r"}
    got = run(docs_of(docs))
    assert got == expected(docs)
    assert got[3] == (3, 1, 2, f"{line}\n{other}") and got[10][3] == ""


def test_long_lines(docs_of):
    r = random.Random(8)
    long = "".join(r.choices("abcdefgh ", k=30_000))
    docs = {1: long, 2: long[:15_000] + "X" + long[15_001:], 3: long[:9_000] + "YYY" + long[9_000:]}
    got = run(docs_of(docs))
    assert [got[i][1] for i in (1, 2, 3)] == [0, 1, 0]


def test_short_lines(spark, docs_of, tmp_path):
    """Exact repeats of lines of any length go, near ones and blank ones stay."""
    docs = {i: f"Home\n \n\nstory number {i} of a kind\nRead more" for i in range(20)} | {30: "Read mor\né\n\u00a0\n\u00a0", 31: "é"}
    docs[40] = "Home\nRead more"
    plain = run(docs_of(docs))
    got = run(docs_of(docs), shortest=1)
    assert [got[i][1] - plain[i][1] for i in (0, 1, 19, 30, 31, 40)] == [0, 2, 2, 0, 1, 2]
    assert got[30][3] == docs[30] and got[31][3] == "" and got[40][3] == ""
    docs_of(docs).write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r["doc_id"]: r["n_removed"] for r in queries.op3_line_dedup(spark, str(tmp_path)).collect()}
    assert rows == {i: x[1] for i, x in got.items()}
    left = {r["doc_id"] for r in corpus_pipeline.line_dedup(spark, docs_of(docs), str(tmp_path)).collect()}
    assert left == {*docs} - {31, 40}


def test_links_of_every_copy(spark, docs_of, tmp_path):
    """Every holder of a line has its links, and copies share a class id."""
    line, other = "this very line stands in many documents", "and this one stands nowhere else at all"
    docs = {1: line, 2: f"{line}!", 3: f"{line}\n{line}\n{other}", 4: f"{line}?\n{other}.", 5: "alone", 6: None} | {i: line for i in range(10, 20)}
    docs_of(docs).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op3_line_dedup(spark, str(tmp_path)).collect()}
    assert {i: r["n_links"] for i, r in got.items()} == {1: 2, 2: 2, 3: 3, 4: 3, 5: 0, 6: 0} | {i: 2 for i in range(10, 20)}
    ids = {i: set(r["line_classes"]) for i, r in got.items()}
    assert len(ids[1]) == 1 and all(ids[i] == ids[1] for i in range(10, 20)) and ids[1] < ids[3] and not ids[2] & ids[1]
    assert [len(ids[i]) for i in (2, 3, 4, 5, 6)] == [1, 2, 2, 0, 0]
    assert {i: r["n_removed"] for i, r in got.items()} == {1: 0, 2: 1, 3: 2, 4: 2, 5: 0, 6: 0} | {i: 1 for i in range(10, 20)}


def test_odd_documents(odd_docs, no_docs):
    out = linededup.dedup_lines(odd_docs)
    assert set(out.columns) == set(odd_docs.columns) | {"n_lines", "n_removed", "n_links"} and out.count() == odd_docs.count()
    rows = [(r["doc_id"], r["n_lines"], r["n_removed"]) for r in out.collect()]
    assert rows.count((1, 1, 0)) == 2 and (2, 1, 1) in rows and (None, 1, 1) in rows and (8, 2, 1) in rows and (3, 0, 0) in rows and (5, 3, 0) in rows
    assert linededup.dedup_lines(no_docs).count() == 0


