"""One query per operator over its whole table, and SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import bpe, decontaminate, langid, linededup, lmscore, oracles, pii, repair, shards, simhash, suffix, topk, warc, whitening
from .common import id_hash, stored, table

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def op1_norm_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return topk.top_k(vectors.select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS vec FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.vec, c.vec), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 10
"""


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    warc.write_archives(table(spark, folder, "pages"), path)
    page = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1).try_cast("long")
    sound = F.when(F.col("quarantined").isNull(), True).otherwise(F.raise_error(F.concat_ws(" ", F.lit("unreadable record just written:"), "archive", "quarantined")).cast("boolean"))
    return warc.read_archives(spark, path).filter(sound).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))


OP2_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages
), r AS (SELECT *, strlen(html) >= 100 AND page_id > first AS again FROM p)
SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to
FROM r
"""


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = linededup.dedup_lines(documents(spark, folder).select("doc_id", "text"), shortest=1, every_copy=True)
    return cleaned.select("doc_id", "n_lines", "n_removed", "n_links", "line_classes", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text", "lang")
    return langid.train_and_identify(docs).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.matches(documents(spark, folder), table(spark, folder, "benchmark")).select(
        "doc_id", "item_id", F.round("similarity", 6).alias("similarity"), "distance")


def op6_ppm_score(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.coalesce(id_hash("doc_id") % 5 == 1, F.lit(False))
    scored = lmscore.score(documents(spark, folder).select("doc_id", "text"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_histogram_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select(
        "doc_id", "text", (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    return shards.shard(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffix.remove_repeats(documents(spark, folder).select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def tokenizer_path() -> str:
    """Place of the public tokenizer file; the library ships none."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode(documents(spark, folder).select("doc_id", "text"), tokenizer_path()).drop("text")


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    prints = stored(simhash.fingerprint(docs).select("doc_id", "fingerprint"), "fingerprints")
    return simhash.near_duplicates(prints).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op12_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.train_and_find(documents(spark, folder).select("doc_id", "text"))
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    place = lambda s: F.struct(s["start"].alias("start"), F.array_position(F.array(*map(F.lit, pii.KINDS)), s["kind"]).alias("nth"), s["end"].alias("end"), s["kind"].alias("kind"))
    every = F.array_sort(F.concat(F.transform("base", place), F.transform("added", place)))
    return found.select("doc_id", *map(of, pii.KINDS), F.sha2(told(F.col("base")).cast("binary"), 256).alias("base_sha256"), told(every).alias("spans"),
                        F.size("added").cast("long").alias("n_added"))


def op13_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repair(repair.damage(table(spark, folder, "conversations")), copies="copies")


QUERIES: dict[str, Query] = {
    "op1_norm_topk": op1_norm_topk,
    "op2_warc": op2_warc,
    "op3_line_dedup": op3_line_dedup,
    "op4_language_id": op4_language_id,
    "op5_decontaminate": op5_decontaminate,
    "op6_ppm_score": op6_ppm_score,
    "op7_histogram_shards": op7_histogram_shards,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_bpe": op9_bpe,
    "op10_simhash": op10_simhash,
    "op11_whitening": op11_whitening,
    "op12_pii": op12_pii,
    "op13_repair": op13_repair,
}
ORACLES: dict[str, str] = {"op1_norm_topk": OP1_SQL, "op2_warc": OP2_SQL, "op8_suffix_dedup": oracles.OP8_SQL, "op13_repair": oracles.OP13_SQL}
