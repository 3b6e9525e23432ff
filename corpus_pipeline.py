"""A corpus pipeline: five stages from raw documents to encoded ones.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
to the shared folder and read again as the next stage's docs. Stages keep the columns of
``documents`` and work on all their predecessor kept. The last one adds what it encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adledger.llm import bpe, decontaminate, langid, linededup, simhash
from adledger.llm.common import stored, table
from adledger.llm.queries import tokenizer_path

#: A document goes if no language is at least this likely.
LEAST_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of no determined language: null texts, texts without a letter, and those
    whose likeliest language stays below LEAST_LANGUAGE_SCORE. Without any labelled text no
    language can be told, and every text with a letter stays."""
    model = langid.train(docs.filter(~langid.held_out()))
    if model is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    known = langid.identify(docs, model, pred="__lang", score="__score")
    return known.filter((F.col("__lang") != langid.UNDETERMINED) & (F.col("__score") >= LEAST_LANGUAGE_SCORE)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out lines that repeat earlier ones; n_chars follows the text. A document that
    loses every line goes; one that had no text stays."""
    cleaned = linededup.dedup_lines(docs, shortest=1)
    kept = cleaned.filter((F.col("n_lines") == 0) | (F.col("n_removed") < F.col("n_lines")))
    return kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode every text and decode it again."""
    return bpe.encode(docs, tokenizer_path()).select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: SQL can state neither the language model nor the fingerprints; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
