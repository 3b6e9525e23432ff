import hashlib
import random

import pytest
from pyspark.sql import functions as F

from adledger.llm import bpe

public = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

PATH = public.path("byte_bpe_50k.json")
TEXTS = ["", "  a  b ", "a<|endoftext|>b <|endoftext|>", "　x  y", "don't 's  \n\n x\t", "😀😀😀", "a" * 500 + " " + "ab" * 300, "\x00\x01",
         "é" * 100, "123456 12,3", " " * 5000 + "x", "The quick brown fox. " * 50, "naïve café 日本語", "<|endoftext|", "\r\n\r\n", "x" * 3000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(open(PATH, encoding="utf-8").read())


def digest(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


def test_equals_the_library(spark, library, docs_of):
    out = bpe.encode(docs_of(dict(enumerate([*TEXTS, None]))), PATH).collect()
    assert len(out) == len(TEXTS) + 1
    assert all((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == digest(library, r["text"]) for r in out)


def test_ids_and_round_trip(docs_of, library):
    out = bpe.decode_ids(bpe.encode_ids(docs_of(dict(enumerate(TEXTS))), PATH), PATH).collect()
    assert all(r["ids"] == library.encode(r["text"], add_special_tokens=False).ids and r["decoded"] == r["text"] for r in out)
    odd = docs_of({1: "x"}).select(F.explode(F.array(F.array(F.lit(99_999_999)), F.lit(None).cast("array<int>"), F.array().cast("array<int>"))).alias("ids"))
    assert [r["decoded"] for r in bpe.decode_ids(odd, PATH).collect()] == [None, None, ""]


def test_automaton():
    r = random.Random(1)
    words = sorted({bytes(r.choices(b"abc", k=r.randint(0, 7))) for _ in range(400)})
    found = bpe.Automaton.build(words)
    assert [found.index(w) for w in words] == list(range(len(words)))
    assert all(found.index(w) == -1 for w in {bytes(r.choices(b"abcd", k=r.randint(1, 9))) for _ in range(300)} - set(words))
    suffixes = bpe.Automaton.build(sorted(p + b"ing" for p in (b"walk", b"talk", b"sing")))
    assert len(suffixes.final) < 1 + 3 * 7 - 6  # equal endings are stored once
    assert bpe.Automaton.build([]).index(b"x") == -1


def test_minimal():
    """No two states have the same future."""
    words = sorted(a + b for a in (b"", b"x", b"yy") for b in (b"one", b"two", b"ones"))
    a = bpe.Automaton.build(words)
    edges = [(int(s), t - int(a.base[s]), int(a.target[t])) for t, s in enumerate(a.owner) if s >= 0]
    states = [(bool(a.final[s]), tuple((b, t) for o, b, t in edges if o == s)) for s in range(len(a.final))]
    assert len(set(states)) == len(states)


def test_lexicon_and_merging_agree(vocabulary, library):
    words = [w.encode() for w in (" the", " quick", "ing", " naïve", "x" * 40, "日本")]
    lexicon = bpe.Lexicon(bpe.pack_lexicon(words, vocabulary))
    assert all(lexicon.ids(w) == vocabulary.merge(w) == library.encode(w.decode()).ids for w in words) and lexicon.ids(b"unseen") is None
    r = random.Random(2)
    for _ in range(300):
        w = bytes(r.choices(b"aeinrst", k=r.randint(1, 30)))
        assert vocabulary.merge(w) == vocabulary._merge_long([vocabulary.bytes[b] for b in w])


def test_long_texts_in_pieces(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 37)
    encoder = bpe.Encoder(vocabulary, None)
    r = random.Random(3)
    for _ in range(60):
        text = "".join(r.choices(["a", "b1", " ", "  ", "\n", "'s", "é", "."], k=300))
        assert encoder.ids(text) == library.encode(text).ids


def test_odd_documents(odd_docs, no_docs, library):
    out = bpe.encode(odd_docs, PATH)
    assert out.count() == odd_docs.count() and set(odd_docs.columns) < set(out.columns)
    assert {(r["n_tokens"]) for r in out.filter("text IS NULL OR text = ''").collect()} == {0}
    assert bpe.encode(no_docs, PATH).count() == 0


def test_ascii_pattern(vocabulary):
    """On ASCII texts the quick matcher cuts as the one for all texts does."""
    encoder, r = bpe.Encoder(vocabulary, None), random.Random(4)
    letters = [*map(chr, range(128)), *(" '" * 30), "'s", "'ll", "  ", "\n"]
    for _ in range(3000):
        text = "".join(r.choices(letters, k=40))
        assert encoder.ascii.findall(text) == encoder.compiled.findall(text)


def test_frequent_words_stay_in_memory(vocabulary, monkeypatch):
    """Rare words drive no word of the lexicon out of memory; a word that is met again stays; ids are exact throughout."""
    monkeypatch.setattr(bpe, "MEMORY", 4 * 40 * 300)
    frequent = [f" word{i}" for i in range(50)]
    encoder = bpe.Encoder(vocabulary, bpe.pack_lexicon([w.encode() for w in frequent], vocabulary))
    asked, real = [], encoder.lexicon.ids
    monkeypatch.setattr(encoder.lexicon, "ids", lambda w: asked.append(w) or real(w))
    plain = lambda word: [int(i) for i in vocabulary.merge(word.encode())]
    r = random.Random(6)
    for _ in range(40):
        rare = [" " + "".join(r.choices("abcdefgh", k=12)) for _ in range(15)]
        for w in [*frequent, *rare, " again"]:
            assert [*encoder.word(w)] == plain(w) if w not in encoder.frequent else [*encoder.frequent[w]] == plain(w)
    assert all(asked.count(w.encode()) == 1 for w in [*frequent, " again"] if w.isalpha() or w in encoder.frequent or w == " again")
    assert encoder.held <= bpe.MEMORY // 4 and len(encoder.memory) + len(encoder.older) < 200
