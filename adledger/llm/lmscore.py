"""Language-model scores: prediction by partial matching over bytes, and a word base line.

Training gathers the counts of every byte with the five bytes before it, over all training
texts; shorter contexts follow by adding up. A byte is predicted in its longest context that
training has seen. Of n sightings there, each different byte gives up one half to the escape;
a byte that never followed the context escapes to the next shorter one, in which bytes already
offered by the longer contexts are excluded; at last all bytes never seen share the rest.

The counts grow with the corpus, so they are never broadcast whole: contexts are dealt by
their last two bytes into slices of bounded size, each slice is broadcast once, and texts
add up the predictions that fall into it. Word counts are sharded by word hash: frequent
words are broadcast, of the others texts send theirs to the shards and get sums back.

Texts are UTF-8 with A-Z lower-cased. Bytes 0xFE (before a text) and 0xFF (its end) occur in
no UTF-8 text; the end is predicted like any other byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import group_name, stored, text_bytes
from .rolling import Substrings

ORDER = 5
START, END = b"\xfe" * ORDER, b"\xff"
BATCH_BYTES = 3 << 19
HELD_GRAMS = 2_000_000
BATCH_TEXTS = 32_768
SIXTEEN = np.uint64(16)


def joined_texts(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[dict[str, np.ndarray], list[bytes]]]:
    """Lower-cased texts in groups of bounded size, with their other columns."""
    for batch in batches:
        columns = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
        held, size, first = [], 0, 0
        for i, text in enumerate(text_bytes(batch.column("text"))):
            held.append(text.lower())
            size += len(text)
            if size >= BATCH_BYTES or len(held) == BATCH_TEXTS or i + 1 == batch.num_rows:
                yield {n: c[first:i + 1] for n, c in columns.items()}, held
                held, size, first = [], 0, i + 1


# --- byte contexts --------------------------------------------------------------------

def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For every byte (and end) of the texts: its six bytes as a number, and its text's number."""
    data = np.frombuffer(b"".join([START + t + END for t in texts]), np.uint8)
    lengths = np.array([len(t) + 1 for t in texts])
    mine = np.ones(len(data), bool)
    mine[(np.cumsum(lengths + ORDER) - lengths - ORDER)[:, None] + np.arange(ORDER)] = False
    code = np.zeros(len(data), np.uint64)
    for back in range(ORDER, -1, -1):
        code <<= np.uint64(8)
        code[back:] |= data[:len(data) - back]
    return code[mine], np.repeat(np.arange(len(texts), dtype=np.uint64), lengths)


def added_up(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    return code[first], np.add.reduceat(n, first)


def count_grams(batches):
    """Counts of a partition, sent on whenever there are many."""
    schema = pa.schema([("gram", pa.int64()), ("n", pa.int64())])
    held, size = [], 0
    for _, texts in joined_texts(batches):
        held.append(np.unique(grams(texts)[0], return_counts=True))
        size += len(held[-1][0])
        if size > HELD_GRAMS:
            held = [added_up(*map(np.concatenate, zip(*held)))]
            size = len(held[0][0])
            if 2 * size > HELD_GRAMS:
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in held[0]], schema=schema)
                held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in added_up(*map(np.concatenate, zip(*held)))], schema=schema)


class Contexts:
    """Counts of one slice, for every context length, ready to predict.

    ``low`` holds the counts of contexts of no and of one byte, (256 + 1) x 256, for all
    slices; ``gram`` and ``n`` the six-byte counts whose context ends in the slice.
    """

    def __init__(self, gram: np.ndarray, n: np.ndarray, low: np.ndarray):
        self.none, self.one = low[256], low[:256]
        self.levels = {}
        for order in range(ORDER, 1, -1):
            gram, back = np.unique(gram & np.uint64(2 ** (8 * order + 8) - 1), return_inverse=True)
            n = np.bincount(back, weights=n, minlength=len(gram)).astype(np.int64)
            context, first = np.unique(gram >> np.uint64(8), return_index=True)
            total = np.add.reduceat(n, first) if len(n) else n
            self.levels[order] = {"gram": gram, "n": n, "context": context, "total": total,
                                  "kinds": np.diff(np.append(first, len(gram))), "first": first}
        for order in range(2, ORDER + 1):  # counts the next shorter context has for the bytes seen here
            level = self.levels[order]
            own = level["gram"]
            if order == 2:
                below = self.one[(own >> np.uint64(8)).astype(np.int64) & 255, own.astype(np.int64) & 255]
            else:
                shorter = self.levels[order - 1]
                below = shorter["n"][np.searchsorted(shorter["gram"], own & np.uint64(2 ** (8 * order) - 1))]
            level["below"] = np.add.reduceat(below, level["first"]) if len(own) else below

    def log10(self, code: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of each six-byte number."""
        out = np.zeros(len(code))
        left = np.arange(len(code))
        excluded, kinds = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
        for order in range(ORDER, -1, -1):
            if not len(left):
                return out
            gram = code[left] & np.uint64(2 ** (8 * order + 8) - 1)
            if order >= 2:
                level = self.levels[order]
                if not len(level["gram"]):
                    continue
                at = np.minimum(np.searchsorted(level["context"], gram >> np.uint64(8)), len(level["context"]) - 1)
                known = level["context"][at] == gram >> np.uint64(8)
                total, seen, below = level["total"][at], level["kinds"][at], level["below"][at]
                place = np.minimum(np.searchsorted(level["gram"], gram), len(level["gram"]) - 1)
                n = np.where(level["gram"][place] == gram, level["n"][place], 0)
            else:
                byte = gram.astype(np.int64) & 255
                table = self.one[gram.astype(np.int64) >> 8] if order else None
                if order:
                    total, seen = table.sum(axis=1), (table > 0).sum(axis=1)
                    n, known = table[np.arange(len(byte)), byte], total > 0
                    below = ((table > 0) * self.none).sum(axis=1)
                else:
                    total, seen = np.full(len(byte), self.none.sum()), np.full(len(byte), (self.none > 0).sum())
                    n, known = self.none[byte], total > 0
                    below = np.zeros(len(byte), np.int64)
            free, fresh = total - excluded, seen - kinds
            hit = n > 0
            with np.errstate(divide="ignore", invalid="ignore"):
                out[left[hit]] += np.log10((n - 0.5)[hit] / free[hit])
                escape = np.where(known & (fresh > 0), np.log10(0.5 * fresh / free), 0.0)
            out[left[~hit]] += escape[~hit]
            excluded, kinds = (np.where(known, now, before)[~hit] for now, before in ((below, excluded * 0), (seen, kinds * 0)))
            left = left[~hit]
        out[left] -= np.log10(256 - (self.none > 0).sum())
        return out


def predict_slice(shared, number: int):
    schema = pa.schema([("id", pa.int64()), ("row", pa.int64()), ("slice", pa.int32()), ("part", pa.float64())])

    def run(batches):
        mine, gram, n, low = (np.frombuffer(x, t) for x, t in zip(shared.value, (bool, np.uint64, np.int64, np.int64)))
        model = Contexts(gram, n, low.reshape(257, 256))
        for columns, texts in joined_texts(batches, "id", "row"):
            code, owner = grams(texts)
            inside = mine[(code >> np.uint64(8)).astype(np.int64) & 65_535]
            keyed = np.sort(code[inside] << SIXTEEN | owner[inside])
            code = keyed >> SIXTEEN
            first = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
            value = np.repeat(model.log10(code[first]), np.diff(np.append(first, len(code))))
            total = np.bincount((keyed & np.uint64(65_535)).astype(np.int64), weights=value, minlength=len(texts))
            yield pa.RecordBatch.from_arrays([pa.array(columns["id"]), pa.array(columns["row"]), pa.array(
                np.full(len(texts), number, np.int32)), pa.array(total)], schema=schema)

    return run


def slices(weights: np.ndarray, most: int) -> list[np.ndarray]:
    """The 65,536 two-byte context ends dealt into as few runs of at most ``most`` counts
    as their order allows (one end alone may hold more, up to 2^32 by its definition)."""
    number, room, out = 0, most, np.zeros(len(weights), np.int64)
    for end, weight in enumerate(weights.tolist()):
        if weight > room and room < most:
            number, room = number + 1, most
        room -= weight
        out[end] = number
    return [out == i for i in range(number + 1)]


def ppm_parts(rows: DataFrame, learns: Column, slice_grams: int = 3_000_000) -> DataFrame:
    """rows(id, row, text) -> (id, row, slice, part): the parts of a text's log10 probability."""
    spark = rows.sparkSession
    counted = stored(rows.filter(learns).select("text").mapInArrow(count_grams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    ends = F.shiftright("gram", 8).bitwiseAND(F.lit(65_535))
    low = np.zeros((257, 256), np.int64)
    for r in counted.groupBy(F.col("gram").bitwiseAND(F.lit(65_535)).alias("g")).agg(F.sum("n").alias("n")).collect():
        low[r["g"] >> 8, r["g"] & 255] = r["n"]
        low[256, r["g"] & 255] += r["n"]
    weights = np.zeros(65_536, np.int64)
    for r in counted.groupBy(ends.alias("e")).count().collect():
        weights[r["e"]] = r["count"]
    parts = None
    for number, mine in enumerate(slices(weights, slice_grams)):
        own = np.flatnonzero(mine)
        table = counted.filter(ends.between(int(own[0]), int(own[-1]))).toArrow()
        shared = spark.sparkContext.broadcast((mine.tobytes(), table["gram"].to_numpy().tobytes(), table["n"].to_numpy().tobytes(), low.tobytes()))
        part = rows.select("id", "row", "text").mapInArrow(predict_slice(shared, number), "id long, row long, slice int, part double")
        parts = part if parts is None else parts.unionByName(part)
    return parts


# --- words ----------------------------------------------------------------------------

BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
#: The end of a text is a word of its own; no hash of a word is fixed, so neither can clash by design.
END_WORD = np.uint64(2**64 - 1)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts and of every end, and the text's number."""
    data = np.frombuffer(b" ".join([*texts, b""]) if texts else b"", np.uint8)
    stops = np.cumsum([len(t) + 1 for t in texts])
    inside = np.concatenate([[False], ~BLANK[data], [False]])
    start, end = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(~inside[1:] & inside[:-1])
    words = Substrings(data).hashes(start, end, end - start)
    owner = np.searchsorted(stops, start, side="right")
    return (np.concatenate([words, np.full(len(texts), END_WORD)]), np.concatenate([owner, np.arange(len(texts))]))


SENT = pa.schema([("shard", pa.int32()), ("batch", pa.int64()), ("words", pa.binary()), ("counts", pa.binary()),
                  ("owners", pa.binary()), ("learns", pa.binary()), ("rows", pa.binary())])
BACK = pa.schema([("batch", pa.int64()), ("owners", pa.binary()), ("logs", pa.binary()), ("known", pa.binary()),
                  ("tokens", pa.binary()), ("rows", pa.binary())])
SENT_SQL = "shard int, batch long, words binary, counts binary, owners binary, learns binary, rows binary"
BACK_SQL = "batch long, owners binary, logs binary, known binary, tokens binary, rows binary"


def count_words(batches):
    """Words of a partition with their counts, sent on whenever there are many."""
    schema = pa.schema([("word", pa.int64()), ("n", pa.int64())])
    held, size = [], 0
    for _, texts in joined_texts(batches):
        held.append(np.unique(word_hashes(texts)[0], return_counts=True))
        size += len(held[-1][0])
        if size > HELD_GRAMS:
            held = [added_up(*map(np.concatenate, zip(*held)))]
            size = len(held[0][0])
            if 2 * size > HELD_GRAMS:
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in held[0]], schema=schema)
                held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in added_up(*map(np.concatenate, zip(*held)))], schema=schema)


def looked_up(words: np.ndarray, sorted_words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Count of each word (0 if it is not there), and whether it is there."""
    if not len(sorted_words):
        return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
    at = np.minimum(np.searchsorted(sorted_words, words), len(sorted_words) - 1)
    there = sorted_words[at] == words
    return np.where(there, counts[at], 0), there


def send_words(shards: int, frequent):
    """Each group of texts adds up its frequent words itself and sends every shard the other
    distinct words of its texts that belong there. The ids of the texts, with the sums so
    far, travel once, with one of the shards."""

    def run(batches):
        frequent_words, frequent_counts = (np.frombuffer(x, t) for x, t in zip(frequent.value, (np.uint64, np.int64)))
        for number, (columns, texts) in enumerate(joined_texts(batches, "id", "row", "learns")):
            hashes, owner = word_hashes(texts)
            order = np.lexsort((hashes, owner))
            hashes, owner = hashes[order], owner[order]
            first = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])))
            counts = np.diff(np.append(first, len(hashes)))
            hashes, owner = hashes[first], owner[first]
            seen, local = looked_up(hashes, frequent_words, frequent_counts)
            sums = [np.bincount(owner[local], weights=w, minlength=len(texts)) for w in (
                np.log10(seen[local] + 0.5) * counts[local], counts[local], counts[local])]
            hashes, owner, counts = hashes[~local], owner[~local].astype("<u2"), counts[~local].astype("<u4")
            shard = (hashes % np.uint64(shards)).astype(np.int32)
            order = np.argsort(shard, kind="stable")  # stays ordered by text within a shard
            bounds = np.searchsorted(shard[order], np.arange(shards + 1))
            own = [order[a:b] for a, b in zip(bounds, bounds[1:])]
            rows = np.concatenate([columns["id"], columns["row"]]).astype("<i8").tobytes()
            learns = np.packbits(columns["learns"].astype(bool)).tobytes()
            batch = group_name(number, rows)
            rows += np.concatenate(sums).astype("<f8").tobytes()
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(shards, dtype=np.int32)), pa.array([batch] * shards, pa.int64()),
                *(pa.array([x[o].tobytes() for o in own], pa.binary()) for x in (hashes, counts, owner)),
                pa.array([learns] * shards, pa.binary()),
                pa.array([rows if i == batch % shards else None for i in range(shards)], pa.binary())], schema=SENT)

    return run


def answer_shard(sent: pa.Table) -> pa.Table:
    """Count the training words of a shard and send every text its sums."""
    words = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in sent.column("words")])
    counts = np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in sent.column("counts")])
    owners = [np.frombuffer(x.as_py(), "<u2") for x in sent.column("owners")]
    learns = np.concatenate([np.unpackbits(np.frombuffer(x.as_py(), np.uint8))[o] for x, o in zip(sent.column("learns"), owners)]).astype(bool)
    taught, back = np.unique(words[learns], return_inverse=True)
    total = np.bincount(back, weights=counts[learns], minlength=len(taught)).astype(np.int64)
    seen, _ = looked_up(words, taught, total)
    logs, known = np.log10(seen + 0.5) * counts, np.where(seen > 0, counts, 0)
    out, start = [], 0
    for own in owners:
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, np.int64)
        sums = [np.add.reduceat(x[start:start + len(own)], first) if len(own) else x[:0] for x in (logs, known, counts)]
        out.append([own[first].astype("<u2").tobytes(), *(x.astype(t).tobytes() for x, t in zip(sums, ("<f8", "<u4", "<u4")))])
        start += len(own)
    return pa.table([sent.column("batch"), *(pa.array(x, pa.binary()) for x in zip(*out)), sent.column("rows")], schema=BACK)


def sum_batch(parts: pa.Table) -> pa.Table:
    """Add up what the shards sent to one group of texts."""
    packed = next(x.as_py() for x in parts.column("rows") if x.is_valid)
    ids, rows = np.frombuffer(packed, "<i8", len(packed) // 20).reshape(2, -1)
    logs, known, tokens = np.frombuffer(packed, "<f8", offset=len(packed) // 5 * 2).reshape(3, -1).copy()
    known, tokens = known.astype(np.int64), tokens.astype(np.int64)
    for owners, *values in zip(*(parts.column(n) for n in ("owners", "logs", "known", "tokens"))):
        at = np.frombuffer(owners.as_py(), "<u2")  # each text once
        for total, value, kind in zip((logs, known, tokens), values, ("<f8", "<u4", "<u4")):
            total[at] += np.frombuffer(value.as_py(), kind)
    return pa.table({"id": ids, "row": rows, "logs": logs, "known": known, "tokens": tokens})


def word_sums(rows: DataFrame, frequent_words: int = 200_000, words_per_shard: int = 4_000_000,
              least_shards: int = 48) -> tuple[DataFrame, int, int]:
    """rows(id, row, text, learns) -> (id, row, logs, known, tokens), and the training corpus'
    tokens and distinct words.

    The ``frequent_words`` most frequent training words are broadcast with their counts, so
    no word of a large part of all texts ever meets in one shard. A shard holds its other
    words once; the number of shards grows with the bytes of the texts.
    """
    counted = stored(rows.filter("learns").select("text").mapInArrow(count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    tokens, words = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counted.orderBy(F.desc("n"), "word").limit(frequent_words).toArrow()
    word, n = top["word"].to_numpy().view(np.uint64), top["n"].to_numpy()
    order = np.argsort(word)
    frequent = rows.sparkSession.sparkContext.broadcast((word[order].tobytes(), n[order].tobytes()))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(least_shards, total // (6 * words_per_shard))
    answers = rows.mapInArrow(send_words(shards, frequent), SENT_SQL).groupBy("shard").applyInArrow(answer_shard, BACK_SQL)
    sums = answers.groupBy("batch").applyInArrow(sum_batch, "id long, row long, logs double, known long, tokens long")
    return sums, tokens, words


# --- both -----------------------------------------------------------------------------

def score(df: DataFrame, learns: Column, text: str = "text", order: str = "doc_id", frequent_words: int = 200_000) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score for every row.

    ``learns`` says which rows train. A null text is empty: its score is that of the end
    alone. Without training rows every byte costs log10 256 and every word is unknown.
    Rows equal in id and text get equal results, one row each; a null id stays null.
    """
    flag = F.col(order).isNull()
    rows = df.select(F.coalesce(F.col(order).cast("long"), F.lit(0)).alias("id"),
                     F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND(F.lit(-2)).bitwiseOR(flag.cast("long")).alias("row"),
                     F.col(text).alias("text"), F.coalesce(learns, F.lit(False)).alias("learns"))
    sums, n, v = word_sums(rows, frequent_words)
    copies = sums.groupBy("id", "row").agg(F.count("*").alias("copies"), *[F.max(c).alias(c) for c in ("logs", "known", "tokens")])
    parts = ppm_parts(rows, F.col("learns")).groupBy("id", "row", "slice").agg(F.max("part").alias("part"))
    scores = parts.groupBy("id", "row").agg(F.sum("part").alias("score"))
    return (copies.join(scores, ["id", "row"]).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        F.when(F.col("row").bitwiseAND(F.lit(1)) == 0, F.col("id")).alias("doc_id"), F.col("tokens").alias("n_tokens"),
        F.col("known").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("tokens") * F.log10(F.lit(n + 0.5 * (v + 1)))).alias("base_score"), "score"))
