import random
import re
from collections import Counter

from pyspark.sql import functions as F

from adledger.llm import decontaminate


def grams(text, width):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return [tuple(words[i:i + width]) for i in range(len(words) - width + 1)]


def expected(docs, items, similarity=0.8):
    """{(doc, item): best similarity} over every window of every document."""
    out = {}
    for item, text in items.items():
        n = len(re.findall(r"[^\W_]+", (text or "").lower()))
        if not n:
            continue
        width = min(5, n)
        want = grams(text, width)
        bag = Counter(want)
        for doc, body in docs.items():
            have = grams(body, width)
            for at in range(max(1, len(have) - len(want) + 1)) if have else ():
                window = Counter(have[at:at + len(want)])
                both = sum((window & bag).values())
                value = both / (sum(window.values()) + len(want) - both)
                if value >= similarity:
                    out[doc, item] = max(out.get((doc, item), 0), value)
    return out


def items_of(spark, items):
    return spark.createDataFrame(list(items.items()), "item_id long, text string")


def passages(seed=2):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    items = {i: " ".join(r.choices(words, k=r.randint(6, 45))) for i in range(20)} | {50: "the same the same the same the same the same end", 51: None, 52: "...", 53: "w1 w2 w3"}
    docs = {}
    for d in range(80):
        body = r.choices(words, k=r.randint(0, 120))
        if d % 2:
            item = (items[r.randrange(20)]).split()
            for _ in range(r.randint(0, 2)):
                at = r.randrange(len(item))
                r.choice([lambda: item.pop(at), lambda: item.insert(at, "new"), lambda: item.__setitem__(at, "other")])()
            at = r.randrange(len(body) + 1)
            body = body[:at] + item + body[at:]
        docs[d] = " ".join(body)
    docs[100] = "x The SAME, the same; the same the same the same end y"
    docs[101] = "a w1 w2 w3 b"
    return docs, items


def test_equals_brute_force(spark, docs_of):
    docs, items = passages()
    # With radius 64 every fingerprint is near: what is left is the exact check.
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.matches(docs_of(docs), items_of(spark, items), radius=63).collect()}
    want = expected(docs, items)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got) and (100, 50) in got and (101, 53) in got
    near = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(docs_of(docs), items_of(spark, items)).collect()}
    assert near <= want.keys() and {k for k, v in want.items() if v == 1.0} <= near and len(near) >= 0.9 * len(want)


def test_hamming_blocks_find_all_within_the_radius(spark):
    r = random.Random(1)
    pairs = [(i, a := r.getrandbits(62), a ^ sum(1 << b for b in r.sample(range(62), r.randint(0, 16)))) for i in range(300)]
    df = spark.createDataFrame(pairs, "i long, a long, b long")
    same = lambda n: F.array(*decontaminate.blocks(n, 16))
    assert df.filter(~F.exists(F.arrays_zip(same("a").alias("x"), same("b").alias("y")), lambda z: z["x"] == z["y"])).count() == 0


def test_clean_drops_only_matches(spark, docs_of, odd_docs, no_docs):
    items = items_of(spark, {1: "lazy dog and runs away from the farm"})
    kept = decontaminate.clean(odd_docs, items)
    assert kept.columns == odd_docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [3, 4, 5, 6, 6, 7, 8, None]
    assert decontaminate.clean(no_docs, items).count() == 0
    assert decontaminate.clean(odd_docs, items_of(spark, {})).count() == odd_docs.count()
    assert decontaminate.matches(odd_docs, items_of(spark, {1: None, 2: "--"})).count() == 0
    twice = decontaminate.matches(odd_docs, spark.createDataFrame([(1, "lazy dog and runs away"), (1, "lazy dog and runs away"), (2, "lazy dog and runs away")], "item_id long, text string"))
    assert sorted({(r["doc_id"], r["item_id"]) for r in twice.collect()}, key=str) == sorted({(d, i) for d in (1, 2, None) for i in (1, 2)}, key=str)
