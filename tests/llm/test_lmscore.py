import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from adledger.llm import lmscore

K = lmscore.ORDER


def plain_model(texts):
    seen = [defaultdict(Counter) for _ in range(K + 1)]
    for t in texts:
        s = b"\xfe" * K + (t or "").encode().lower() + b"\xff"
        for k in range(K + 1):
            for i in range(K, len(s)):
                seen[k][s[i - k:i]][s[i]] += 1
    return seen


def plain_score(seen, text):
    s, total = b"\xfe" * K + (text or "").encode().lower() + b"\xff", 0.0
    for i in range(K, len(s)):
        out = set()
        for k in range(K, -1, -1):
            counts = {x: n for x, n in seen[k].get(s[i - k:i], {}).items() if x not in out}
            if not counts:
                continue
            n = sum(counts.values())
            if s[i] in counts:
                total += math.log10((counts[s[i]] - 0.5) / n)
                break
            total += math.log10(0.5 * len(counts) / n)
            out |= set(counts)
        else:
            total -= math.log10(256 - len(out))
    return total


def plain_base(train, texts):
    split = lambda t: (t or "").encode().lower().split() + [None]
    counts = Counter(w for t in train for w in split(t))
    n, v = sum(counts.values()), len(counts)
    return {t: (len(split(t)), sum(counts[w] > 0 for w in split(t)), n, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in split(t))) for t in texts}


TEXTS = {1: "the cat sat on the mat", 2: "The Cat ate\tthe rat", 3: "", 4: None, 5: "abababab zzz", 6: "été naïve 日本 \x00", 7: "the cat sat on the mat",
         8: "qqq unseen WORDS here", 9: "mat " * 400, 10: " \n "}


def check(got, train, texts):
    seen, base = plain_model(train), plain_base(train, texts.values())
    for r in got:
        want = base[texts[r["doc_id"]]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[:3]
        assert r["base_score"] == pytest.approx(want[3]) and r["score"] == pytest.approx(plain_score(seen, texts[r["doc_id"]]))


@pytest.mark.parametrize("slice_grams", [3_000_000, 20])
def test_equals_brute_force(docs_of, monkeypatch, slice_grams):
    """Also when the model is sent in many small slices."""
    whole = lmscore.ppm_parts
    monkeypatch.setattr(lmscore, "ppm_parts", lambda rows, learns: whole(rows, learns, slice_grams))
    got = lmscore.score(docs_of(TEXTS), F.col("doc_id") % 4 != 0).collect()
    assert len(got) == len(TEXTS)
    check(got, [t for i, t in TEXTS.items() if i % 4], TEXTS)


def test_small_groups_of_texts(docs_of, monkeypatch):
    monkeypatch.setattr(lmscore, "BATCH_BYTES", 10)
    monkeypatch.setattr(lmscore, "HELD_GRAMS", 30)
    for frequent in (0, 3, 200_000):  # none, some and all words looked up locally
        check(lmscore.score(docs_of(TEXTS), F.lit(True), frequent_words=frequent).collect(), list(TEXTS.values()), TEXTS)


@pytest.mark.parametrize("partitions", [1, 4])
def test_groups_with_equal_rows(spark, monkeypatch, partitions):
    """Equal null ids and one document landed many times fill groups of equal rows."""
    monkeypatch.setattr(lmscore, "BATCH_BYTES", 10)
    texts = {None: "the same words without an id", 3: "one long document that is landed again"}
    df = spark.createDataFrame([x for x in texts.items() for _ in range(12)], "doc_id long, text string").repartition(partitions)
    got = lmscore.score(df, F.lit(True), frequent_words=0).collect()
    assert sorted(r["doc_id"] or 0 for r in got) == [0] * 12 + [3] * 12
    check(got, [*texts.values()] * 12, texts)


def test_probabilities_add_up():
    """What may follow a context has probability one in all."""
    code, n = np.unique(lmscore.grams([b"abracadabra", b"abc"])[0], return_counts=True)
    low = np.zeros((257, 256), np.int64)
    for c, m in zip(code.tolist(), n.tolist()):
        low[c >> 8 & 255, c & 255] += m
        low[256, c & 255] += m
    model = lmscore.Contexts(code, n, low)
    for context in (b"\xfe\xfe\xfe\xfe\xfe", b"\xfe\xfeabr", b"cadab", b"zzzzz", b"zzzzb"):
        following = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], np.uint64)
        assert (10 ** model.log10(following)).sum() == pytest.approx(1)


def test_odd_documents(odd_docs, no_docs):
    got = lmscore.score(odd_docs, F.col("doc_id") < 7).collect()
    assert len(got) == odd_docs.count() and sum(r["doc_id"] is None for r in got) == 2 and sum(r["doc_id"] == 1 for r in got) == 2
    assert lmscore.score(no_docs, F.lit(True)).count() == 0
    untrained = lmscore.score(odd_docs, F.lit(False)).filter("doc_id = 4").first()
    assert untrained["train_tokens"] == 0 and untrained["n_known"] == 0 and untrained["score"] == pytest.approx(-math.log10(256))
