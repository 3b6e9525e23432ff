import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from adledger.llm import langid

SYLLABLES = {"en": ["the", "ing", "and", "th"], "de": ["sch", "ung", "der", "ein"], "fr": ["eau", "oi", "é", "que"]}


def corpus(n=240):
    r = random.Random(3)
    langs = {i: [*SYLLABLES][i % 3] for i in range(n)}
    return {i: " ".join("".join(r.choices(SYLLABLES[langs[i]], k=3)) for _ in range(20)) for i in langs}, langs


def test_held_out_accuracy(docs_of):
    texts, langs = corpus()
    out = langid.train_and_identify(docs_of(texts, langs)).withColumn("held", langid.held_out()).collect()
    assert any(r["held"] for r in out) and all(r["lang_pred"] == langs[r["doc_id"]] and 0 <= r["lang_score"] <= 1 for r in out)


def test_inputs_never_include_the_label(docs_of):
    texts, langs = corpus()
    model = langid.train(docs_of(texts, langs))
    wrong = langid.identify(docs_of(texts, "xx"), model).collect()
    assert all(r["lang_pred"] == langs[r["doc_id"]] for r in wrong)


def test_long_texts_are_read_whole(docs_of, monkeypatch):
    texts, langs = corpus()
    model = langid.train(docs_of(texts, langs))
    long = texts[1] * 30 + " " + texts[2] * 200
    whole = langid.score_batch(model, [long])[1]
    monkeypatch.setattr(langid, "PIECE", 50)
    assert langid.score_batch(model, [long])[0] == ["fr"] and abs(langid.score_batch(model, [long])[1] - whole) < 1e-9


def test_sample_bound(docs_of):
    texts, langs = corpus()
    model = langid.train(docs_of(texts, langs), train_docs=60)
    assert model.languages == ["de", "en", "fr"]


def test_odd_documents(odd_docs, no_docs):
    out = langid.train_and_identify(odd_docs)
    assert out.count() == odd_docs.count() and set(odd_docs.columns) <= set(out.columns)
    found = {(r["doc_id"], r["lang_pred"], r["lang_score"]) for r in out.filter("text IS NULL OR text RLIKE '^[^a-zé]*$'").collect()}
    assert found == {(3, "und", 0.0), (4, "und", 0.0), (None, "und", 0.0), (5, "und", 0.0), (7, "und", 0.0)}
    assert langid.train_and_identify(no_docs).count() == 0
    unlabelled = langid.train_and_identify(odd_docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r["lang_pred"], r["lang_score"]) for r in unlabelled.collect()} == {("und", 0.0)}


def bin_of(points, bins):
    """The counter of one n-gram, in plain integers."""
    code = sum(p << 21 * k for k, p in enumerate(points)) ^ len(points) << 61
    hashed = code * 0x9E3779B97F4A7C15 % 2**64
    return (hashed ^ hashed >> 29) * 0x9E3779B97F4A7C15 % 2**64 >> 64 - (bins.bit_length() - 1)


def grams(text, bins):
    padded = f" {text.lower()} "
    return Counter(bin_of([ord(c) for c in padded[i:i + n]], bins) for n in (1, 2, 3) for i in range(len(padded) - n + 1))


def brute_force(texts, langs, bins=1 << 15):
    """{id: (held out, language, probability)} by counting one text after the other."""
    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in texts}
    seen, docs = {}, Counter()
    for i, t in texts.items():
        if not held[i] and t is not None and langs[i] is not None:
            seen.setdefault(langs[i], Counter()).update(grams(t, bins))
            docs[langs[i]] += 1
    size = {x: sum(c.values()) + bins for x, c in seen.items()}
    out = {}
    for i, t in texts.items():
        if t is None or not any(c.isalpha() for c in t):
            out[i] = (held[i], "und", 0.0)
            continue
        own = grams(t, bins)
        logs = {x: math.log(docs[x] / docs.total()) + math.fsum(n * math.log((seen[x][b] + 1) / size[x]) for b, n in own.items()) for x in seen}
        best = max(sorted(logs), key=logs.get)
        out[i] = (held[i], best, 1 / math.fsum(math.exp(v - logs[best]) for v in logs.values()))
    return out


@pytest.mark.parametrize("piece", [300_000, 37])
def test_equals_brute_force(docs_of, monkeypatch, piece):
    """Texts so short that probabilities are no mere zeros and ones; odd and unlabelled ones; long
    texts, and the same ones cut into short blocks."""
    r = random.Random(11)
    langs = {i: r.choice([*SYLLABLES, None]) for i in range(150)}
    texts = {i: "".join(r.choices(SYLLABLES[langs[i] or "en"] + ["x", "Ä", " "], k=r.randint(1, 6))) for i in langs}
    texts |= {200: None, 201: "", 202: "12 !!", 203: "\U0001F600 a", 204: "THE eau " * 3000, 205: "İI"}
    langs |= dict.fromkeys(range(200, 206), "en")
    want = brute_force(texts, langs)
    model = langid.train(docs_of(texts, langs).filter(~langid.held_out()))
    monkeypatch.setattr(langid, "PIECE", piece)
    names, scores = langid.score_batch(model, [*texts.values()])
    got = langid.train_and_identify(docs_of(texts, langs)).withColumn("held", langid.held_out()).collect()
    for i, name, score in [*zip(texts, names, scores), *[(x["doc_id"], x["lang_pred"], x["lang_score"]) for x in got]]:
        assert name == want[i][1] and score == pytest.approx(want[i][2], abs=1e-9)
    assert {x["doc_id"]: x["held"] for x in got} == {i: w[0] for i, w in want.items()}
    assert sum(0.01 < w[2] < 0.99 for w in want.values()) > 10


def test_ties_and_names(docs_of):
    """Languages learned from the same texts are equally likely: the alphabetically first wins."""
    texts = {i: "same words here" for i in range(40)}
    df = docs_of(texts, {i: ("b", "a")[i % 2] for i in texts}).withColumn("__found_language", F.lit("mine"))
    model = langid.train(df)
    out = langid.identify(df, model).collect()
    assert {r["lang_pred"] for r in out} == {"a"} and {round(r["lang_score"], 9) for r in out} == {0.5}
    assert {r["__found_language"] for r in out} == {"mine"}


def test_many_languages_take_no_more_memory():
    """A block of characters times languages stays bounded."""
    sizes = [langid.piece_size(n) * n for n in (4, 5, 50, 200, 1000)]
    assert langid.piece_size(2) == langid.PIECE and max(sizes) <= langid.PIECE * langid.USUAL
