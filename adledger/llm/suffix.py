"""Repeated-substring removal by a distributed merge sort of suffixes.

Two places that share a string of 50 bytes share the anchor chosen inside it: the smallest
hash of 16 bytes. So documents are cut by anchors, and three exchanges settle them:

1. Every group of texts sends the hashes of its anchors and of the full context of each to
   the shard of the anchor. The same context in a smaller document settles all strings
   of an anchor; an anchor that occurs in one context only is settled as well.
2. For what is left, the suffixes that begin at the anchors travel as sorted, front-coded
   runs with the bytes before them. A loser tree combines the runs: each suffix carries the
   length of the prefix it is known to share with the last winner, so known prefixes are
   never compared again, and the merged order comes out with its common prefixes. From
   these, equal strings around an anchor are found for every offset at once. An anchor with
   very many classes left is not merged: the hashes of its strings are counted instead, which
   Spark adds up before it deals them out.
3. Answers return to the texts, which cut out what is covered.

Texts travel compressed with the first and the last exchange. Nothing is held per corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import group_name, stored, text_bytes
from .rolling import Substrings

WINDOW = 50
GRAM = 16
#: Starts of 16-byte strings inside a window.
SPAN = WINDOW - GRAM + 1
BATCH_BYTES = 2 << 20
BATCH_TEXTS = 32_768
LAST = 2**63 - 1
#: Open classes up to which an anchor is merged; each takes up to 1 KB there.
MOST_CLASSES = 10_000
#: Compression of texts on their way.
LEVEL = 5


# --- anchors --------------------------------------------------------------------------

@dataclass
class Anchors:
    """Anchors of a group of texts: each speaks for the windows that start in first .. last."""

    at: np.ndarray
    first: np.ndarray
    last: np.ndarray
    key: np.ndarray
    context: np.ndarray
    owner: np.ndarray


def find_anchors(data: np.ndarray, ends: np.ndarray) -> Anchors:
    """Anchors of texts joined to one array, text i ending at ends[i]."""
    none = np.zeros(0, np.int64)
    if len(data) < WINDOW:
        return Anchors(none, none, none, none.astype(np.uint64), none.astype(np.uint64), none)
    parts = Substrings(data)
    n = len(data) - GRAM + 1
    grams = parts.hashes(slice(0, n), slice(GRAM, GRAM + n), GRAM)
    low = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)  # ties go to the first
    width = 1
    while 2 * width <= SPAN:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < SPAN:
        low = np.minimum(low[:width - SPAN], low[SPAN - width:])
    starts = np.concatenate([[0], ends[:-1]])
    inside = np.zeros(len(data) + 1, np.int8)
    fits = ends - starts >= WINDOW
    inside[starts[fits]] += 1
    inside[ends[fits] - WINDOW + 1] -= 1
    windows = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
    anchor = (low[windows] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1))) if len(windows) else none
    first, at = windows[new], anchor[new]
    last = windows[np.append(new[1:], len(windows)) - 1] if len(new) else none
    context = parts.hashes(first, last + WINDOW, (last + WINDOW - first) * 64 + (at - first))
    return Anchors(at, first, last, grams[at], context, np.searchsorted(ends, first, side="right"))


@dataclass
class Classes:
    """Anchors folded by (key, context), in this order: number of each anchor's class, and each
    class's smallest document and one anchor of that document."""

    of: np.ndarray
    key: np.ndarray
    context: np.ndarray
    least: np.ndarray
    anchor: np.ndarray


def fold(found: Anchors, docs: np.ndarray) -> Classes:
    doc = docs[found.owner]
    order = np.lexsort((doc, found.context, found.key))
    key, context = found.key[order], found.context[order]
    first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (context[1:] != context[:-1]))) if len(key) else order
    number = np.zeros(len(order), np.int64)
    number[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
    return Classes(number, key[first], context[first], doc[order[first]], order[first])


# --- exchange 1: hashes of contexts ---------------------------------------------------

ASKED = pa.schema([("shard", pa.int32()), ("batch", pa.int64()), ("keys", pa.binary()), ("contexts", pa.binary()),
                   ("owners", pa.binary()), ("docs", pa.binary()), ("texts", pa.binary()), ("ends", pa.binary()), ("marks", pa.binary())])
ASKED_SQL = "shard int, batch long, keys binary, contexts binary, owners binary, docs binary, texts binary, ends binary, marks binary"
TOLD = pa.schema([("batch", pa.int64()), ("shard", pa.int32()), ("states", pa.binary()), ("docs", pa.binary()),
                  ("texts", pa.binary()), ("ends", pa.binary()), ("marks", pa.binary())])
TOLD_SQL = "batch long, shard int, states binary, docs binary, texts binary, ends binary, marks binary"
#: A hot class is open, and its anchor has too many open classes for one merge.
SETTLED, COVERED, OPEN, HOT = 0, 1, 2, 3
#: Parts of the runs table: texts of a group, and strings of hot anchors.
TEXTS, STRINGS = -1, -2


def blobs(arrays, kind: str | None = None) -> pa.Array:
    return pa.array([None if a is None else (a if kind is None else a.astype(kind)).tobytes() for a in arrays], pa.binary())


def ask(shards: int):
    """Each group of texts sends its classes to their shards, and itself to one of them."""

    def run(batches):
        import zstandard

        number = 0
        for batch in batches:
            docs, marks = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("doc", "mark"))
            held, size, first = [], 0, 0
            for i, text in enumerate(text_bytes(batch.column("text"))):
                held.append(text)
                size += len(text)
                if size < BATCH_BYTES and len(held) < BATCH_TEXTS and i + 1 < batch.num_rows:
                    continue
                joined, ends = b"".join(held), np.cumsum([len(t) for t in held])
                own = docs[first:i + 1]
                classes = fold(found := find_anchors(np.frombuffer(joined, np.uint8), ends), own)
                owner = found.owner[classes.anchor].astype("<u2")
                shard = (classes.key % np.uint64(shards)).astype(np.int64)
                parts = [np.flatnonzero(shard == s) for s in range(shards)]
                name = group_name(number, own.tobytes(), marks[first:i + 1].tobytes())
                number += 1
                home = [s == name % shards for s in range(shards)]
                packer = zstandard.ZstdCompressor(level=LEVEL)
                packed, ids = packer.compress(joined), packer.compress(own.astype("<i8").tobytes())
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(shards, dtype=np.int32)), pa.array([name] * shards, pa.int64()),
                    blobs([(classes.key[p] >> np.uint64(32)) for p in parts], "<u4"), blobs([classes.context[p] for p in parts]),
                    blobs([owner[p] for p in parts]), pa.array([ids] * shards, pa.binary()),
                    pa.array([packed if h else None for h in home], pa.binary()), blobs([ends if h else None for h in home], "<i8"),
                    blobs([marks[first:i + 1] if h else None for h in home], "<i8")], schema=ASKED)
                held, size, first = [], 0, i + 1

    return run


def unpacked(ids: pa.Scalar) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(ids.as_py()), "<i8")


def whole(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.concatenate([np.frombuffer(x.as_py(), kind) for x in column])


def tell(most_classes: int):
    """State of every class of a shard: settled, covered by a smaller document, open, or hot."""
    return lambda asked: told_states(asked, most_classes)


def told_states(asked: pa.Table, most_classes: int) -> pa.Table:
    lengths = [len(x.as_py()) // 8 for x in asked.column("contexts")]
    key, context = whole(asked.column("keys"), "<u4"), whole(asked.column("contexts"), "<u8")
    doc = np.concatenate([unpacked(d)[np.frombuffer(o.as_py(), "<u2")] for d, o in zip(asked.column("docs"), asked.column("owners"))])
    order = np.lexsort((doc, context, key))
    key, context, doc = key[order], context[order], doc[order]
    state = np.zeros(len(order), np.uint8)
    if len(order):
        new_key = np.append(True, key[1:] != key[:-1])
        new_class = new_key | np.append(True, context[1:] != context[:-1])
        least = np.repeat(doc[new_class], np.diff(np.append(np.flatnonzero(new_class), len(doc))))
        first = np.flatnonzero(new_key)
        sizes = np.diff(np.append(first, len(doc)))
        several = (np.add.reduceat(new_class.astype(np.int64), first) > 1) & (np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first))
        hot = np.add.reduceat((doc == least).astype(np.int64), first) > most_classes
        state[order] = np.where(doc > least, COVERED, np.repeat(np.where(several, np.where(hot, HOT, OPEN), SETTLED), sizes))
    states = np.split(state, np.cumsum(lengths)[:-1])
    docs = pa.array([d.as_py() if t.is_valid else None for d, t in zip(asked.column("docs"), asked.column("texts"))], pa.binary())
    return pa.table([asked.column("batch"), asked.column("shard"), blobs(states), docs, *(asked.column(n) for n in ("texts", "ends", "marks"))], schema=TOLD)


# --- exchange 2: front-coded suffix runs ----------------------------------------------

RUN = pa.schema([("batch", pa.int64()), ("part", pa.int32()), ("shared", pa.binary()), ("lengths", pa.binary()), ("tails", pa.binary()),
                 ("lefts", pa.binary()), ("left_lengths", pa.binary()), ("least_offsets", pa.binary()), ("docs", pa.binary()), ("numbers", pa.binary()),
                 ("texts", pa.binary()), ("ends", pa.binary()), ("marks", pa.binary()), ("text_docs", pa.binary()), ("from", pa.binary()), ("to", pa.binary()),
                 ("open_number", pa.binary()), ("open_at", pa.binary()), ("strings", pa.binary())])
RUN_SQL = ("batch long, part int, shared binary, lengths binary, tails binary, lefts binary, left_lengths binary, least_offsets binary, docs binary, "
           "numbers binary, texts binary, ends binary, marks binary, text_docs binary, `from` binary, `to` binary, open_number binary, open_at binary, strings binary")


def common(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix of two strings known to share ``start`` bytes."""
    stop = min(len(a), len(b))
    while start < stop and a[start] == b[start]:
        start += 1
    return start


def united(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals in order of their starts, with those that touch made one."""
    if not len(first):
        return first, last
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order])
    new = np.flatnonzero(np.append(True, first[1:] > reach[:-1]))
    return first[new], reach[np.append(new[1:], len(first)) - 1]


def front_code(strings: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """Sorted strings as lengths shared with the string before, full lengths, and tails."""
    shared = [0, *(common(a, b) for a, b in zip(strings, strings[1:]))][:len(strings)]
    return bytes(shared), bytes(map(len, strings)), b"".join(s[n:] for s, n in zip(strings, shared))


def front_decode(shared: bytes, lengths: bytes, tails: bytes) -> list[bytes]:
    out, last, at = [], b"", 0
    for n, length in zip(shared, lengths):
        last = last[:n] + tails[at:at + length - n]
        at += length - n
        out.append(last)
    return out


#: Hot classes of a group that travel in one row.
HOT_ROWS = 20_000


def hot_strings(data: bytes, found: Anchors, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All strings of 50 bytes that the given anchors speak for: the number of the anchor among
    those given, the string's hash, and the anchor's offset in it."""
    first, counts = found.first[anchor], found.last[anchor] - found.first[anchor] + 1
    of = np.repeat(np.arange(len(anchor)), counts)
    start = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts) + first[of]
    offset = found.at[anchor][of] - start
    return of, Substrings(np.frombuffer(data, np.uint8)).hashes(start, start + WINDOW, WINDOW * 64 + offset), offset


def make_runs(parts: int):
    def run(key: tuple, told: pa.Table) -> pa.Table:
        import zstandard

        home = next(i for i, x in enumerate(told.column("texts")) if x.is_valid)
        packed, ends, marks = (told.column(n)[home].as_py() for n in ("texts", "ends", "marks"))
        data = zstandard.ZstdDecompressor().decompress(packed)
        docs = unpacked(told.column("docs")[home])
        found = find_anchors(np.frombuffer(data, np.uint8), np.frombuffer(ends, "<i8"))
        classes = fold(found, docs)
        state = np.zeros(len(classes.key), np.uint8)
        shard = (classes.key % np.uint64(told.num_rows)).astype(np.int64)
        for s, states in zip(told.column("shard").to_pylist(), told.column("states")):
            state[shard == s] = np.frombuffer(states.as_py(), np.uint8)
        own = docs[found.owner]
        covered = (state[classes.of] == COVERED) | (own > classes.least[classes.of])
        again = (state[classes.of] >= OPEN) & ~covered
        open_ = np.flatnonzero(state == OPEN)
        rows = []
        part = (classes.key[open_] >> np.uint64(16)) % np.uint64(parts)
        for p in np.unique(part).tolist():
            mine = open_[part == p]
            at, first, last = (x[classes.anchor[mine]].tolist() for x in (found.at, found.first, found.last))
            suffixes = [data[a:b + WINDOW] for a, b in zip(at, last)]
            order = sorted(range(len(mine)), key=suffixes.__getitem__)
            shared, lengths, tails = front_code([suffixes[i] for i in order])
            lefts = [data[first[i]:at[i]] for i in order]
            rows.append((key[0].as_py(), p, shared, lengths, tails, b"".join(lefts), bytes(map(len, lefts)), bytes(at[i] - last[i] for i in order),
                         classes.least[mine][order].astype("<i8").tobytes(), mine[order].astype("<u4").tobytes(), *[None] * 9))
        hot = np.flatnonzero(state == HOT)
        for some in np.split(hot, range(HOT_ROWS, len(hot), HOT_ROWS)) if len(hot) else []:
            of, string, offset = hot_strings(data, found, classes.anchor[some])
            rows.append((key[0].as_py(), STRINGS, *[None] * 5, offset.astype(np.uint8).tobytes(), classes.least[some][of].astype("<i8").tobytes(),
                         some[of].astype("<u4").tobytes(), *[None] * 8, string.astype("<u8").tobytes()))
        gone = united(found.first[covered], found.last[covered] + WINDOW)
        rows.append((key[0].as_py(), TEXTS, *[None] * 8, packed, ends, marks, docs.astype("<i8").tobytes(), *(x.astype("<u4").tobytes() for x in gone), classes.of[again].astype("<u4").tobytes(), found.at[again].astype("<u4").tobytes(), None))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), RUN)], schema=RUN)

    return run


def loser_merge(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int], list[int]]:
    """Merged order of sorted runs with their shared-prefix lengths: (run, place in it, length
    shared with the string before). A contender keeps the length it shares with the last
    winner: of two, the one sharing more is smaller; bytes are compared only on a tie, and
    only beyond it."""
    k = 1
    while k < len(runs):
        k *= 2
    heads = [r[0][0] if r[0] else None for r in runs] + [None] * (k - len(runs))
    known, place = [0] * k, [0] * k
    losers = [-1] * k

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        n = common(x, y, known[a])
        if n == len(x) or n < len(y) and x[n] < y[n]:
            known[b] = n
            return a, b
        known[a] = n
        return b, a

    winners = [*range(k)]
    row = k
    while row > 1:
        row //= 2
        for i in range(row):
            winners[i], losers[row + i] = play(winners[2 * i], winners[2 * i + 1])
    winner = winners[0]
    out_run, out_place, out_shared = [], [], []
    while heads[winner] is not None:
        at = place[winner]
        out_run.append(winner)
        out_place.append(at)
        out_shared.append(known[winner])
        strings, shared = runs[winner]
        at += 1
        place[winner] = at
        if at < len(strings):
            heads[winner], known[winner] = strings[at], shared[at]
        else:
            heads[winner] = None
        node = (winner + k) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2
    return out_run, out_place, out_shared


FOUND = pa.schema([("batch", pa.int64()), ("numbers", pa.binary()), ("offsets", pa.binary())])
FOUND_SQL = "batch long, numbers binary, offsets binary"


def merge_runs(runs: pa.Table) -> pa.Table:
    """For every class of a part, the offsets (as bits) at which its string also stands in a
    smaller document."""
    decoded = [front_decode(*(runs.column(n)[i].as_py() for n in ("shared", "lengths", "tails"))) for i in range(runs.num_rows)]
    run, place, shared = loser_merge([(s, list(runs.column("shared")[i].as_py())) for i, s in enumerate(decoded)])
    bounds = np.cumsum([0, *map(len, decoded)])
    order = bounds[np.array(run, np.int64)] + np.array(place, np.int64)  # merged order -> place in the columns
    shared = np.array(shared, np.int64)
    docs, numbers = whole(runs.column("docs"), "<i8")[order], whole(runs.column("numbers"), "<u4")
    left_lengths, least = (whole(runs.column(n), np.uint8).astype(np.int64) for n in ("left_lengths", "least_offsets"))
    # Bytes before each anchor, nearest first, in rows of equal width.
    left = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in runs.column("lefts")])
    stops = np.cumsum(left_lengths)
    back = stops[:, None] - 1 - np.arange(SPAN)
    near = np.where(np.arange(SPAN) < left_lengths[:, None], left[np.maximum(back, 0)] if len(left) else 0, 0)[order]
    most, least = left_lengths[order], least[order]
    bits = np.zeros(len(order), np.uint64)
    before = np.zeros(len(order), np.int64)  # number of the group of equal left bytes
    for offset in range(SPAN):
        if offset:
            before = np.unique(before << 8 | near[:, offset - 1], return_inverse=True)[1]
        here = np.flatnonzero((least <= offset) & (offset <= most))
        if not len(here):
            continue
        group = np.cumsum(shared < WINDOW - offset)[here] * (len(order) + 1) + before[here]
        sort = np.lexsort((docs[here], group))
        group, doc = group[sort], docs[here][sort]
        new = np.append(True, group[1:] != group[:-1])
        smallest = np.repeat(doc[new], np.diff(np.append(np.flatnonzero(new), len(doc))))
        bits[here[sort[doc > smallest]]] |= np.uint64(1 << offset)
    back_bits = np.zeros(len(order), np.uint64)
    back_bits[order] = bits
    out = []
    for i in range(runs.num_rows):
        own, named = back_bits[bounds[i]:bounds[i + 1]], numbers[bounds[i]:bounds[i + 1]]
        out.append((own[own > 0], named[own > 0]))
    return pa.table([runs.column("batch"), blobs([n for _, n in out], "<u4"), blobs([b for b, _ in out], "<u8")], schema=FOUND)


def spread(batches):
    """One row per string of a hot anchor."""
    for batch in batches:
        for r in range(batch.num_rows):
            name, strings, docs, numbers, offsets = (batch.column(n)[r].as_py() for n in ("batch", "strings", "docs", "numbers", "least_offsets"))
            string = np.frombuffer(strings, "<i8")
            for a in range(0, len(string), HOT_ROWS):
                own = slice(a, a + HOT_ROWS)
                yield pa.RecordBatch.from_arrays([
                    pa.array(string[own]), pa.array(np.frombuffer(docs, "<i8")[own]), pa.array(np.full(len(string[own]), name)),
                    pa.array(np.frombuffer(numbers, "<u4")[own].astype(np.int64)), pa.array(np.frombuffer(offsets, np.uint8)[own].astype(np.int32))], schema=SPREAD)


SPREAD = pa.schema([("string", pa.int64()), ("doc", pa.int64()), ("batch", pa.int64()), ("number", pa.int64()), ("offset", pa.int32())])
SPREAD_SQL = "string long, doc long, batch long, number long, offset int"


def pack_bits(rows: pa.Table) -> pa.Table:
    """The offsets found for the hot classes of one group, as ``merge_runs`` returns them."""
    number, bits = (rows.column(n).to_numpy() for n in ("number", "bits"))
    return pa.table([rows.column("batch")[:1], blobs([number], "<u4"), blobs([bits], "<u8")], schema=FOUND)


def count_strings(made: DataFrame) -> DataFrame:
    """What ``merge_runs`` finds, for hot anchors: strings are counted by hash, and those of
    several documents looked up. No string's rows meet anywhere, as counts are added up first."""
    strings = made.filter(F.col("part") == STRINGS).select("batch", "strings", "docs", "numbers", "least_offsets").mapInArrow(spread, SPREAD_SQL)
    least = stored(strings.groupBy("string").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).filter("least < most").drop("most"), "hot-strings")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("offset"))
    return strings.join(least, "string").filter("doc > least").groupBy("batch", "number").agg(F.bit_or(bit).alias("bits")).groupBy(
        "batch").applyInArrow(pack_bits, FOUND_SQL)


# --- exchange 3: cutting --------------------------------------------------------------

CUT = pa.schema([("doc", pa.int64()), ("mark", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])
CUT_SQL = "doc long, mark long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"


def cut(rows: pa.Table) -> pa.Table:
    """Texts of one group without their covered bytes, and the covered spans."""
    import zstandard

    home = next(i for i, x in enumerate(rows.column("texts")) if x.is_valid)
    at = {n: rows.column(n)[home].as_py() for n in ("texts", "ends", "marks", "text_docs", "from", "to", "open_number", "open_at")}
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(at["texts"]), np.uint8)
    ends, docs, marks = (np.frombuffer(at[n], "<i8") for n in ("ends", "text_docs", "marks"))
    steps = np.zeros(len(data) + 1, np.int32)
    np.add.at(steps, np.frombuffer(at["from"], "<u4"), 1)
    np.add.at(steps, np.frombuffer(at["to"], "<u4"), -1)
    number, place = np.frombuffer(at["open_number"], "<u4"), np.frombuffer(at["open_at"], "<u4").astype(np.int64)
    bits = np.zeros(int(number.max(initial=0)) + 1, np.uint64)
    for i in range(rows.num_rows):
        if rows.column("numbers")[i].is_valid:
            bits[np.frombuffer(rows.column("numbers")[i].as_py(), "<u4")] |= np.frombuffer(rows.column("offsets")[i].as_py(), "<u8")
    mine = bits[number]
    for offset in range(SPAN):
        start = place[(mine >> np.uint64(offset)) & np.uint64(1) > 0] - offset
        np.add.at(steps, start, 1)
        np.add.at(steps, start + WINDOW, -1)
    covered = np.cumsum(steps[:-1]) > 0
    starts = np.concatenate([[0], ends[:-1]])
    spans, kept, sizes = [], [], []
    for a, b in zip(starts.tolist(), ends.tolist()):
        own = covered[a:b]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
        spans.append([{"start": x, "end": y} for x, y in edge.reshape(-1, 2).tolist()])
        kept.append(data[a:b][~own].tobytes())
    return pa.table([pa.array(docs), pa.array(marks), pa.array(ends - starts), pa.array(spans, CUT.field("spans").type), pa.array(kept, pa.binary())], schema=CUT)


def remove_repeats(df: DataFrame, text: str = "text", order: str = "doc_id", classes_per_part: int = 150_000, bytes_per_shard: int = 36_000_000,
                   least_shards: int = 24, most_classes: int = MOST_CLASSES) -> DataFrame:
    """doc_id, n_bytes, spans, kept: the bytes of every text that no string of 50 bytes covers
    which also starts in a document of smaller id, and the maximal spans taken out.

    Strings are judged on the input. Null texts are empty; a null id counts as larger than
    any, and ids that are equal never cover each other, so repeated rows get equal results.
    A document is handled in one piece; texts of under 50 bytes are never touched. An anchor
    with more than ``most_classes`` open classes is settled by the hashes of its strings.
    """
    rows = df.select(F.coalesce(F.col(order).cast("long"), F.lit(LAST)).alias("doc"), F.col(order).isNull().cast("long").alias("mark"), F.col(text).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(least_shards, total // bytes_per_shard)
    told = rows.mapInArrow(ask(shards), ASKED_SQL).groupBy("shard").applyInArrow(tell(most_classes), TOLD_SQL)
    parts = max(least_shards, total // (40 * classes_per_part))
    made = stored(told.groupBy("batch").applyInArrow(make_runs(parts), RUN_SQL), "suffix-runs")
    texts = ("texts", "ends", "marks", "text_docs", "from", "to", "open_number", "open_at")
    answers = made.filter("part >= 0").select(*RUN.names[:10]).groupBy("part").applyInArrow(merge_runs, FOUND_SQL)
    if not made.filter(F.col("part") == STRINGS).isEmpty():
        answers = answers.unionByName(count_strings(made))
    empty = F.lit(None).cast("binary")
    last = made.filter(F.col("part") == TEXTS).select("batch", *texts, empty.alias("numbers"), empty.alias("offsets")).unionByName(
        answers.select("batch", *[empty.alias(n) for n in texts], "numbers", "offsets"))
    return last.groupBy("batch").applyInArrow(cut, CUT_SQL).select(
        F.when(F.col("mark") == 0, F.col("doc")).alias("doc_id"), "n_bytes", "spans", "kept")
