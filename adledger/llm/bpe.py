"""Byte-pair encoding with a minimal acyclic transducer for frequent words.

The most frequent words of the corpus, with the ids they encode to, are compiled into a
minimal automaton: states with equal futures are shared, and the number of words that a
walk leaves behind in order gives each word its index into the table of ids. The
automaton is four flat arrays in one file that every worker maps into memory. A word it
holds costs one walk; any other word is merged exactly, pair by pair in rank order.
"""

from __future__ import annotations

import hashlib
import json
import mmap
import re
import tempfile
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import once_per_worker, stored

#: Fixed value: how the public byte-level tokenizer cuts texts into words.
PATTERN = r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts are cut into words in pieces of about this many characters, at a place where the pattern cuts anyway.
PIECE = 1 << 20
#: Bytes of words met before that an encoder remembers, and what an entry takes beside its characters.
MEMORY, ENTRY = 64 << 20, 240
#: Steps of frequency in an octave; a lexicon ends between two of them.
STEPS = 16
NEVER = 1 << 30


# --- vocabulary -----------------------------------------------------------------------

def byte_letters() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabulary files: printable Latin-1
    stands for itself, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Token bytes by id, merge ranks by pair, and the special tokens, of a tokenizer file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        self.tokens: dict[int, bytes] = {i: raw(t) for t, i in spec["model"]["vocab"].items()}
        ids = {t: i for i, t in self.tokens.items()}
        self.bytes = [ids.get(bytes([b])) for b in range(256)]
        #: Rank of a pair of ids, by its left and then its right one, and the id a rank merges into.
        self.ranks: dict[int, dict[int, int]] = {i: {} for i in self.tokens}
        self.merged: list[int] = []
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = map(raw, merge if isinstance(merge, list) else merge.split(" "))
            self.ranks[ids[left]].setdefault(ids[right], rank)
            self.merged.append(ids[left + right])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: t.encode() for t, i in self.special.items()}

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: the adjacent pair of lowest rank is merged, leftmost first, until none is left."""
        parts = [self.bytes[b] for b in word]
        if len(parts) > 64:
            return self._merge_long(parts)
        ranks, merged = self.ranks, self.merged
        near = [ranks[a].get(b, NEVER) for a, b in zip(parts, parts[1:])]
        while near and (least := min(near)) < NEVER:
            at = near.index(least)
            parts[at] = whole = merged[least]
            del near[at], parts[at + 1]
            if at:
                near[at - 1] = ranks[parts[at - 1]].get(whole, NEVER)
            if at < len(near):
                near[at] = ranks[whole].get(parts[at + 1], NEVER)
        return parts

    def _merge_long(self, parts: list[int | None]) -> list[int]:
        """The same with a heap over a linked list, for words of any length."""
        import heapq

        ranks, merged, n = self.ranks, self.merged, len(parts)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := ranks[parts[i]].get(parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j < 0 or parts[j] != right:
                continue
            parts[i], parts[j], after[i] = merged[rank], None, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else -1
                if b >= 0 and (r := ranks[parts[a]].get(parts[b])) is not None:
                    heapq.heappush(heap, (r, a, parts[a], parts[b]))
        return [p for p in parts if p is not None]


# --- automaton ------------------------------------------------------------------------

class Automaton:
    """A minimal acyclic automaton over sorted words; ``index`` is a word's rank in the order.

    The edge of state s with byte b lies in slot base[s] + b if owner[slot] is s: it leads to
    target[slot], and skipped[slot] words come before those behind it.
    """

    def __init__(self, base, owner, target, skipped, final):
        self.base, self.owner, self.target, self.skipped, self.final = base, owner, target, skipped, final

    @classmethod
    def build(cls, words: list[bytes]) -> Automaton:
        """From sorted, distinct words: finished states are looked up by (final, edges), so
        equal futures are stored once."""
        register: dict[tuple, int] = {}
        states: list[tuple] = []
        words_below: list[int] = []

        def freeze(final: bool, edges: list[tuple[int, int]]) -> int:
            key = (final, tuple(edges))
            if (state := register.get(key)) is None:
                state = register[key] = len(states)
                states.append(key)
                words_below.append(int(final) + sum(words_below[t] for _, t in edges))
            return state

        path: list[list] = [[False, []]]
        last = b""
        for word in words:
            same = next((i for i, (a, b) in enumerate(zip(last, word)) if a != b), min(len(last), len(word)))
            while len(path) - 1 > same:
                state = freeze(*path.pop())
                path[-1][1].append((last[len(path) - 1], state))
            path += [[False, []] for _ in word[same:]]
            path[-1][0] = True
            last = word
        while len(path) > 1:
            state = freeze(*path.pop())
            path[-1][1].append((last[len(path) - 1], state))
        root = freeze(*path[0])
        order = [root, *(s for s in range(len(states)) if s != root)]  # the root is state 0
        place = {s: i for i, s in enumerate(order)}
        used, base = bytearray(512), [0] * len(states)
        owner, target, skipped = {}, {}, {}
        low = last = 0
        for s in sorted(range(len(states)), key=lambda s: -len(states[s][1])):  # states with many edges choose first
            final, edges = states[s]
            if not edges:
                continue
            if len(edges) == 1 and last:
                low = last = 0  # single edges fill the holes
            low = max(used.find(0, low), last - 1024 if len(edges) > 1 else 0)  # not every early hole is tried again
            slot = max(low, edges[0][0])
            while any(used[slot - edges[0][0] + b] for b, _ in edges):
                slot = used.find(0, slot + 1)
            base[place[s]], last = slot - edges[0][0], slot
            before = int(final)
            for b, t in edges:
                at = base[place[s]] + b
                used[at], owner[at], target[at], skipped[at] = 1, place[s], place[t], before
                before += words_below[t]
            if len(used) < base[place[s]] + 1024:
                used.extend(bytes(len(used)))
        size = max(owner, default=0) + 512
        flat = lambda d, empty: np.array([d.get(i, empty) for i in range(size)], "<i4")
        return cls(np.array(base, "<i4"), flat(owner, -1), flat(target, 0), flat(skipped, 0), np.array([states[s][0] for s in order], "u1"))

    def arrays(self) -> list[np.ndarray]:
        return [self.base, self.owner, self.target, self.skipped, self.final]

    def index(self, word: bytes) -> int:
        """Rank of the word among the words of the automaton, or -1."""
        state = rank = 0
        base, owner, target, skipped = self.base, self.owner, self.target, self.skipped
        for b in word:
            slot = base[state] + b
            if owner[slot] != state:
                return -1
            rank += skipped[slot]
            state = target[slot]
        return rank if self.final[state] else -1


TYPES = ("<i4", "<i4", "<i4", "<i4", "u1", "<i4", "<i4")


def pack_lexicon(words: list[bytes], vocabulary: Vocabulary) -> bytes:
    """The automaton of the words and the table of their ids as one block of bytes."""
    words = sorted(set(words))
    ids = [vocabulary.merge(w) for w in words]
    ends = np.cumsum([0, *map(len, ids)])
    parts = [*Automaton.build(words).arrays(), ends.astype("<i4"), np.array([i for x in ids for i in x], "<i4")]
    blocks = [p.tobytes() for p in parts]
    return np.array([len(b) for b in blocks], "<i8").tobytes() + b"".join(b + b"\0" * (-len(b) % 8) for b in blocks)


class Lexicon:
    """A packed lexicon mapped into memory from a file without a name."""

    def __init__(self, packed: bytes):
        with tempfile.TemporaryFile() as file:
            file.write(packed)
            file.flush()
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        sizes = np.frombuffer(self.map, "<i8", len(TYPES))
        at, parts = 8 * len(TYPES), []
        for size, kind in zip(sizes.tolist(), TYPES):
            parts.append(memoryview(self.map)[at:at + size].cast({"<i4": "i", "u1": "B"}[kind]))
            at += size + -size % 8
        self.automaton, self.ends, self.flat = Automaton(*parts[:5]), parts[5], parts[6]

    def ids(self, word: bytes) -> list[int] | None:
        rank = self.automaton.index(word)
        return None if rank < 0 else self.flat[self.ends[rank]:self.ends[rank + 1]].tolist()


# --- texts ----------------------------------------------------------------------------

def ascii_pattern() -> re.Pattern:
    """`PATTERN` on ASCII texts, for the standard library's matcher: it is twice as fast, but knows
    no classes of Unicode. Their ASCII members are taken from the regex library."""
    import regex

    members = {kind: "".join(f"\\x{ord(c):02x}" for c in map(chr, range(128)) if regex.fullmatch(kind, c)) for kind in (r"\p{L}", r"\p{N}", r"\s")}
    pattern = PATTERN.replace(r"(?!\S)", f"(?![^{members[chr(92) + 's']}])")
    for kind, inside in members.items():
        pattern = pattern.replace(f"{kind}+", f"[{inside}]+").replace(kind, inside)
    return re.compile(pattern)


def cut_words(text: str, compiled) -> Iterator[str]:
    """The words of a text. Long texts are cut before a blank that stands between two
    characters that are none: a word always begins there, whatever surrounds it."""
    start = 0
    while len(text) - start > PIECE:
        at = start + PIECE
        while at < len(text) and not (text[at] == " " and not text[at - 1].isspace() and at + 1 < len(text) and not text[at + 1].isspace()):
            at += 1
        yield from compiled.findall(text[start:at])
        start = at
    yield from compiled.findall(text[start:] if start else text)


class Encoder:
    """Encodes and decodes with a lexicon for frequent words and a bounded memory of others."""

    def __init__(self, vocabulary: Vocabulary, packed: bytes | None):
        import regex

        self.vocabulary, self.lexicon = vocabulary, Lexicon(packed) if packed else None
        self.compiled, self.ascii = regex.compile(PATTERN), ascii_pattern()
        self.marks = regex.compile("(" + "|".join(regex.escape(t) for t in vocabulary.special) + ")") if vocabulary.special else None
        every = range(max(vocabulary.tokens) + 1)
        self.names, self.tokens = [str(i) for i in every], [vocabulary.tokens.get(i, b"") for i in every]
        #: The one object that all remembered words use for an id.
        self.shared = {i: i for i in vocabulary.tokens}.__getitem__
        #: Words of the lexicon met so far; others met lately, and those before them, which are kept if met again.
        self.frequent: dict[str, tuple[int, ...]] = {}
        self.memory: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.held_frequent = 0
        self.held = 0

    def word(self, word: str) -> tuple[int, ...]:
        """Ids of a word."""
        if found := self.memory.get(word):
            return found
        if (found := self.older.get(word)) is None:
            raw = word.encode()
            if (ids := self.lexicon and self.lexicon.ids(raw)) is not None:
                found = self.frequent[word] = tuple(map(self.shared, ids))
                self.held_frequent += self.weight(word, found)
                if self.held_frequent > MEMORY // 2:
                    self.frequent.clear()
                    self.held_frequent = 0
                return found
            found = tuple(map(self.shared, self.vocabulary.merge(raw)))
        if len(word) <= 64:
            self.memory[word] = found
            self.held += self.weight(word, found)
            if self.held > MEMORY // 4:
                self.older, self.memory, self.held = self.memory, {}, 0
        return found

    @staticmethod
    def weight(word: str, found: tuple[int, ...]) -> int:
        return ENTRY + 2 * len(word) + 8 * len(found)

    def ids(self, text: str) -> list[int]:
        """Word by word; special tokens in a text are found first, as the library does."""
        out, known, word = [], self.frequent.get, self.word
        for i, part in enumerate(self.marks.split(text) if self.marks else [text]):
            if i % 2:
                out.append((self.vocabulary.special[part],))
            else:
                out += [known(w) or word(w) for w in cut_words(part, self.ascii if part.isascii() else self.compiled)]
        return list(chain.from_iterable(out))

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, and SHA-256 of the ids and of the text decoded from them."""
        ids = self.ids(text)
        decoded = b"".join(map(self.tokens.__getitem__, ids)).decode("utf-8", "replace")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return len(ids), sha(",".join(map(self.names.__getitem__, ids))), sha(decoded)


# --- on Spark -------------------------------------------------------------------------

def count_words(df: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over all texts, counted where they lie before anything is sent. Very long texts
    are cut blindly, and blanks are ASCII ones here: a count may be off by a cut, which only
    decides which words are quick."""
    piece = F.explode(F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{PIECE >> 4}}}"), F.lit(0))).alias("piece")
    word = F.explode(F.regexp_extract_all("piece", F.lit(PATTERN), F.lit(0))).alias("word")
    return df.select(piece).select(word).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def train_lexicon(df: DataFrame, vocabulary: Vocabulary, text: str = "text", words: int = 100_000) -> bytes | None:
    """The packed lexicon of the most frequent words, counted over all texts: those above the
    lowest step of frequency that leaves at most ``words``. Only they reach the driver."""
    counts = stored(count_words(df, text).filter((F.octet_length("word") <= 64) & (F.col("n") > 1))
                    .withColumn("step", F.floor(F.log2("n") * STEPS).cast("int")), "word-counts")
    total, least = 0, None
    for row in sorted(counts.groupBy("step").agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True):
        total += row["words"]
        if total > words:
            break
        least = row["step"]
    if least is None:
        return None
    return pack_lexicon([r["word"].encode() for r in counts.filter(F.col("step") >= least).select("word").collect()], vocabulary)


def encode(df: DataFrame, tokenizer: str, text: str = "text", lexicon_words: int = 100_000) -> DataFrame:
    """Add n_tokens, ids_sha256 and decoded_sha256 of every text (null text: empty).

    ``tokenizer`` is the path of a byte-level tokenizer file on the driver; its contents
    travel with the job. Ids equal those of the public library without special tokens
    added; decoding keeps special tokens. Columns of these names are replaced.
    """
    return _apply(df, tokenizer, text, lexicon_words, "n_tokens long, ids_sha256 string, decoded_sha256 string", "digests")


def encode_ids(df: DataFrame, tokenizer: str, text: str = "text", into: str = "ids", lexicon_words: int = 100_000) -> DataFrame:
    """Add the ids of every text as an array."""
    return _apply(df, tokenizer, text, lexicon_words, f"{into} array<int>", "ids")


def decode_ids(df: DataFrame, tokenizer: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the text that an array of ids decodes to; a null array, or one with an unknown
    id, gives null."""
    tokens = Vocabulary(open(tokenizer, encoding="utf-8").read()).tokens
    shared = df.sparkSession.sparkContext.broadcast(tokens)

    @F.arrow_udf("string")
    def decoded(column: pa.Array) -> pa.Array:
        known = shared.value
        return pa.array([None if x is None or any(i not in known for i in x) else
                         b"".join(known[i] for i in x).decode("utf-8", "replace") for x in column.to_pylist()], pa.string())

    return df.withColumn(into, decoded(F.col(ids)))


def _apply(df: DataFrame, tokenizer: str, text: str, lexicon_words: int, fields: str, kind: str) -> DataFrame:
    spec = open(tokenizer, encoding="utf-8").read()
    packed = train_lexicon(df, Vocabulary(spec), text, lexicon_words)
    shared = df.sparkSession.sparkContext.broadcast((spec, packed))
    key = uuid.uuid4().hex
    names = [f.split()[0] for f in fields.split(", ")]

    @F.arrow_udf(fields)
    def encoded(texts: pa.Array) -> pa.Array:
        worker = once_per_worker(key, lambda: Encoder(Vocabulary(shared.value[0]), shared.value[1]))
        values = (t.as_py() or "" for t in texts)
        if kind == "ids":
            arrays = [pa.array([worker.ids(t) for t in values], pa.list_(pa.int32()))]
        else:
            out = [worker.digest(t) for t in values]
            arrays = [pa.array(c, t) for c, t in zip(list(zip(*out)) or [[], [], []], (pa.int64(), pa.string(), pa.string()))]
        return pa.StructArray.from_arrays(arrays, names)

    found = "__encoded"
    return df.withColumn(found, encoded(F.col(text))).withColumns({n: F.col(f"{found}.{n}") for n in names}).drop(found)
