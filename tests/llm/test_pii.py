import hashlib
import itertools
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from adledger.llm import pii, queries
from adledger.llm.semicrf import KINDS, OUTSIDE, Model, Segment, decode, entered_from, fit, likelihood, marginals, regions

# the contract's patterns, word for word
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0


def holds(kind, found):
    digits = re.sub("[^0-9]", "", found)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in found.split(".")),
            "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]


def plain(text):
    return sorted((m.start(), n, m.end()) for n, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text) if holds(kind, m.group()))


def test_base_equals_patterns():
    r = random.Random(3)
    parts = ["1", "23", "255", "256", ".", ".", "-", " ", "+", "(", ")", "@", "a", "b.c", "é", "٣", "4111111111111111", "4111-1111 1111-1111", "+1 (212) 555-0100", "x@y.z", "\n", "_%"]
    for n in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(30)))
        assert [(s, k, e) for k, s, e in pii.base_spans(text)] == plain(text), text


def test_long_texts_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000, "1." * 150_000, "1 " * 150_000, "@" * 300_000, "a@" * 150_000, "+1 " * 100_000, "a.b" * 100_000 + "@x.y", "12 - " * 60_000, "(" * 300_000):
        spans = pii.base_spans(text)
        pii.candidates(text[:60_000])
        assert len(spans) <= len(text)


def lattice(r, places):
    out = {}
    for _ in range(r.randrange(1, 7)):
        a, b = sorted(r.sample(range(places), 2))
        out[a, b, r.randrange(len(KINDS))] = None
    return [Segment(a, b, k, [f"f{i}" for i in range(6) if r.random() < 0.5]) for a, b, k in out]


def subsets(region):
    for size in range(len(region) + 1):
        for chosen in itertools.combinations(range(len(region)), size):
            if all(region[x].end <= region[y].start or region[y].end <= region[x].start for x, y in itertools.combinations(chosen, 2)):
                yield list(chosen)


def test_dynamic_programs_equal_enumeration():
    r = random.Random(4)
    for _ in range(60):
        model = Model({f"f{i}": r.gauss(0, 1) for i in range(6)}, [[r.gauss(0, 1) for _ in KINDS] for _ in range(OUTSIDE + 1)])
        for region in regions(lattice(r, 7)):
            score = lambda c: sum(model.score(region[n]) + model.moves[k][region[n].kind] for n, k in entered_from(region, c))
            every = [(score(c), c) for c in subsets(region)]
            whole = math.log(sum(math.exp(s) for s, _ in every))
            found, total = marginals(model, region)
            assert abs(whole - total) < 1e-9
            for n in range(len(region)):
                assert abs(sum(found[n]) - sum(math.exp(s - whole) for s, c in every if n in c)) < 1e-9
            best = decode(model, region)
            assert abs(sum(g for _, g in best) - max(s for s, _ in every)) < 1e-9
            gold = every[-1][1]
            assert abs(likelihood(model, region, gold) - (score(gold) - whole)) < 1e-9


def test_regions_split_only_where_nothing_touches():
    seg = lambda a, b: Segment(a, b, 0, [])
    assert [[(s.start, s.end) for s in r] for r in regions([seg(5, 9), seg(0, 3), seg(3, 4), seg(8, 12), seg(13, 14)])] == [[(0, 3), (3, 4)], [(5, 9), (8, 12)], [(13, 14)]]


def corpus(n=600, seed=1):
    r, texts = random.Random(seed), []
    words = "the quick brown fox met a dog near our old house and said hello at home again".split()

    def card():
        d = "4" + "".join(r.choice("0123456789") for _ in range(14))
        return d + next(c for c in "0123456789" if luhn(d + c))

    for i in range(n):
        told = [lambda: f"{r.choice(words)}.{r.randrange(99)}@mail{r.randrange(9)}.example.org", lambda: ".".join(str(r.randrange(256)) for _ in range(4)), card,
                lambda: f"+1 ({r.randrange(200, 999)}) 555-{r.randrange(1000, 9999)}", lambda: f"{r.randrange(10**15, 10**16 - 1)}", lambda: f"{r.randrange(10**9)}",
                lambda: f"{r.randrange(9)}.{r.randrange(9)}.{r.randrange(99)}"][i % 7]()
        texts.append(" ".join([*r.choices(words, k=9), told, *r.choices(words, k=9)]) + ".")
    return texts


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame(list(enumerate(corpus())), "doc_id long, text string").withColumns({c: F.lit("extra") for c in ("window", "spans", "base", "added")})
    return pii.train(docs)


@pytest.mark.parametrize("text,kind,span", [
    ("please write to ann.lee [at] mail3.example.org soon", "email", "ann.lee [at] mail3.example.org"),
    ("please write to ann.lee(at)mail3.example.org soon", "email", "ann.lee(at)mail3.example.org"),
    ("please write to ann.lee at mail3 dot example dot org soon", "email", "ann.lee at mail3 dot example dot org"),
    ("the dog came from 192[.]168[.]44[.]7 again", "ip", "192[.]168[.]44[.]7"),
    ("said hello 4000.1234.5678.9017 at home", "card", None),
    ("fox met a dog (212) 555-4821 and said", "phone", "(212) 555-4821"),
    ("fox met a dog 212-555-4821 and said", "phone", "212-555-4821"),
])
def test_respelled_data_are_found(model, text, kind, span):
    found = [(KINDS[k], text[a:b]) for k, a, b, _ in pii.added_spans(text, pii.base_spans(text), model, 2.2)]
    assert found == [(kind, span)] if span else all(k == kind for k, _ in found)


@pytest.mark.parametrize("text", [
    "on 2024-01-02 at 10:20 the fox", "order 98079157628 was sent", "4111 2222 3333 4445 is no card", "version 1.2.3 of 2015-2019", "we look at home.Then go",
    "met at noon dot", "12 34 56 78 90 11 22 33 44 55 66 77", "pages 100-200 and 300-400", "$1,234,567.89 in all", "no numbers here", ""])
def test_clean_texts_are_left_alone(model, text):
    assert pii.added_spans(text, pii.base_spans(text), model, 2.2) == []


def test_accuracy_on_new_texts(spark, model):
    """Held out: respelled data of other documents are found, other numbers are not."""
    r, right, wrong, total = random.Random(77), 0, 0, 0
    for text in corpus(400, seed=9):
        spans = pii.base_spans(text)
        for kind, start, end in spans:
            hidden = pii.respelled(kind, text[start:end], r)
            new = text[:start] + hidden + text[end:]
            found = [(k, a, b) for k, a, b, _ in pii.added_spans(new, pii.base_spans(new), model, 2.2)]
            total += 1
            right += found == [(kind, start, start + len(hidden))] or (found == [] and pii.base_spans(new) != [])
        if not spans:
            wrong += bool(pii.added_spans(text, [], model, 2.2))
    assert right >= 0.9 * total and wrong == 0


def test_training_raises_likelihood():
    texts = corpus(200)
    examples = [x for t in texts for x in pii.example(t, pii.base_spans(t))]
    trained = fit(examples)
    assert sum(likelihood(trained, *x) for x in examples) > 0.2 * sum(likelihood(Model(), *x) for x in examples)


def test_odd_rows(spark, odd_docs, model):
    rows = pii.train_and_find(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r["base"] == [] for r in rows)
    docs = spark.createDataFrame([(1, "a@b.c 4111111111111111 " + "x " * 50_000 + "+1 (212) 555-0100"), (None, "1.2.3.4"), (2, None), (2, "é 1.2.3.4")], "doc_id long, text string")
    got = sorted(((r["doc_id"] or 0, [(s["kind"], s["start"], s["end"]) for s in r["base"]]) for r in pii.find(docs, model).collect()), key=str)
    assert got == sorted([(0, [("ip", 0, 7)]), (1, [("email", 0, 5), ("card", 6, 22), ("phone", 100_023, 100_040)]), (2, []), (2, [("ip", 2, 9)])], key=str)


def test_empty(spark, no_docs):
    assert pii.train_and_find(no_docs).collect() == []


def test_query_against_plain_patterns(spark):
    import os

    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    for r in queries.op12_pii(spark, folder).collect():
        base = plain(texts[r["doc_id"]])
        told = [f"{KINDS[k]}:{s}:{e}" for s, k, e in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert [r[f"n_{kind}"] for kind in KINDS] == [sum(k == n for _, k, _ in base) for n in range(4)]
        every = r["spans"].split(",") if r["spans"] else []
        assert set(told) <= set(every) and len(every) == len(told) + r["n_added"]
        keys = [(int(x.split(":")[1]), KINDS.index(x.split(":")[0])) for x in every]
        assert keys == sorted(keys)
