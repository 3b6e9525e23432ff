"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased and padded with one blank on either side; every run of one, two
and three characters is hashed into ``bins`` counters. Training counts them by language
on Spark; the matrix of log probabilities (bins x languages) is broadcast, its size is
fixed by the parameter ``bins`` and the label set. Scoring sums matrix rows per text, a
bounded piece of a batch at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_hash

GRAM = 3
#: Characters of a block, for up to USUAL languages.
PIECE, USUAL = 300_000, 4
MIX = np.uint64(0x9E3779B97F4A7C15)
UNDETERMINED = "und"


@dataclass
class LanguageModel:
    """languages[j] has log P(bin | language j) in log_prob[:, j] and log prior[j]."""

    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray


def pieces(texts: list[str | None], piece: int) -> Iterator[tuple[int, np.ndarray, int]]:
    """(text number, code points, number of n-gram starts): long texts in pieces that overlap
    by two characters, so every n-gram of every text appears once."""
    for i, text in enumerate(texts):
        points = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        for start in range(0, len(points), piece):
            yield i, points[start:start + piece + GRAM - 1], min(piece, len(points) - start)


def piece_size(languages: int) -> int:
    """Characters scored at a time: a block gathers one number per character and language, so
    many languages get shorter blocks and a worker's memory stays the same."""
    return max(GRAM, PIECE * USUAL // max(USUAL, languages))


def blocks(texts: list[str | None], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces joined up to about ``most`` characters: (text numbers, offsets, code points, starts allowed)."""
    held, size = [], 0
    for piece in pieces(texts, most):
        held.append(piece)
        size += len(piece[1])
        if size >= most:
            yield join(held)
            held, size = [], 0
    if held:
        yield join(held)


def join(held: list[tuple[int, np.ndarray, int]]):
    lengths = np.array([len(p) for _, p, _ in held])
    ends = np.cumsum(lengths)
    offsets = ends - lengths
    points = np.concatenate([p for _, p, _ in held]).astype(np.uint64)
    position = np.arange(len(points))
    last = np.repeat(ends, lengths)
    started = position < np.repeat(offsets + np.array([n for _, _, n in held]), lengths)
    return np.array([i for i, _, _ in held]), offsets, points, [started & (position + n <= last) for n in range(1, GRAM + 1)]


def gram_bins(points: np.ndarray, allowed: list[np.ndarray], bins: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length: the bin at every start (0 where none may start) and the mask of starts."""
    shift = np.uint64(64 - (bins.bit_length() - 1))
    code = np.zeros(len(points), np.uint64)
    for n in range(GRAM):
        following = np.zeros(len(points), np.uint64)
        following[:len(points) - n] = points[n:]
        code = code | (following << np.uint64(21 * n))
        hashed = (code ^ np.uint64(n + 1) << np.uint64(61)) * MIX
        hashed ^= hashed >> np.uint64(29)
        yield (((hashed * MIX) >> shift) * allowed[n]).astype(np.int64), allowed[n]


def count_grams(bins: int, text: str, lang: str):
    schema = pa.schema([("lang", pa.string()), ("bin", pa.int64()), ("n", pa.int64())])

    def run(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(lang).to_pylist()
            for numbers, offsets, points, allowed in blocks(batch.column(text).to_pylist(), PIECE):
                spans = np.diff(np.append(offsets, len(points)))
                for language in {langs[i] for i in numbers}:
                    own = np.repeat(np.array([langs[i] == language for i in numbers]), spans)
                    total = counts.setdefault(language, np.zeros(bins, np.int64))
                    for at, mask in gram_bins(points, allowed, bins):
                        total += np.bincount(at[own & mask], minlength=bins)
        for language, total in counts.items():
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(seen), pa.string()), pa.array(seen), pa.array(total[seen])], schema=schema)

    return run


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", order: str = "doc_id", bins: int = 1 << 15,
          train_docs: int = 500_000) -> LanguageModel | None:
    """Learn from rows with a language and a text; None when there are none.

    ``train_docs`` bounds the training sample: of more labelled rows, those with the
    smallest hash of ``order`` are taken, about that many. Every language label becomes
    a class; add-one smoothing over the bins.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(order).alias("h")).filter(
        F.col("text").isNotNull() & F.col("lang").isNotNull())
    priors = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not priors:
        return None
    share = train_docs / sum(priors.values())
    if share < 1:
        rows = rows.filter(F.col("h") < int(share * 2**64) - 2**63)
    sums = (rows.select("text", "lang").mapInArrow(count_grams(bins, "text", "lang"), "lang string, bin long, n long")
            .groupBy("lang", "bin").agg(F.sum("n").alias("n")).toArrow())
    languages = sorted(priors)
    counts = np.zeros((bins, len(languages)))
    column = {language: j for j, language in enumerate(languages)}
    counts[sums["bin"].to_numpy(), [column[x] for x in sums["lang"].to_pylist()]] = sums["n"].to_numpy()
    prior = np.array([priors[x] for x in languages], float)
    return LanguageModel(languages, np.log(prior / prior.sum()), np.log((counts + 1) / (counts.sum(0) + bins)))


def score_batch(model: LanguageModel | None, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Predicted language and posterior probability of each text."""
    blank = [t is None or not any(map(str.isalpha, t)) for t in texts]
    if model is None:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    total = np.tile(model.log_prior, (len(texts), 1))
    for numbers, offsets, points, allowed in blocks(texts, piece_size(len(model.languages))):
        for at, mask in gram_bins(points, allowed, len(model.log_prob)):
            rows = model.log_prob[at]
            rows[~mask] = 0
            np.add.at(total, numbers, np.add.reduceat(rows, offsets, axis=0))
    best = total.argmax(axis=1)
    score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    names = [UNDETERMINED if b else model.languages[j] for b, j in zip(blank, best)]
    return names, np.where(blank, 0.0, score)


def identify(df: DataFrame, model: LanguageModel | None, text: str = "text", pred: str = "lang_pred",
             score: str = "lang_score") -> DataFrame:
    """Add the predicted language and its posterior probability to every row.

    A null text, or one without a letter, gets ``und`` and 0; so does every text when
    nothing could be learned. Of equally likely languages the alphabetically first wins.
    Columns of these two names are replaced.
    """
    plain = model and (model.languages, model.log_prior, model.log_prob)  # broadcasts use plain pickle
    shared = df.sparkSession.sparkContext.broadcast(plain)

    @F.arrow_udf("lang string, score double")
    def predict(texts: pa.Array) -> pa.Array:
        names, scores = score_batch(shared.value and LanguageModel(*shared.value), texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], ["lang", "score"])

    found = f"__found_{uuid.uuid4().hex}"
    return (df.withColumn(found, predict(F.col(text)))
            .withColumns({pred: F.col(f"{found}.lang"), score: F.col(f"{found}.score")}).drop(found))


def held_out(order: str = "doc_id", folds: int = 5):
    return F.coalesce(id_hash(order) % folds == 0, F.lit(False))


def train_and_identify(docs: DataFrame, text: str = "text", lang: str = "lang", order: str = "doc_id") -> DataFrame:
    """Learn from the labelled rows outside the held-out fold, then predict every row."""
    model = train(docs.filter(~held_out(order)), text, lang, order)
    return identify(docs, model, text)
