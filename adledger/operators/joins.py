"""Equi-joins and lookups.

Spark broadcasts by measured size, and adaptive execution splits a skewed
partition; no broadcast is asked for here. Rows that need no lookup never enter a
join, and a lookup that could hold a key twice is made unique first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.records import norm_source_key
from ..functions.text import clean_listing_text, has_text, text_len


def align_by_id(df: DataFrame, lookup: DataFrame, key: str = "post_id") -> DataFrame:
    """Inner join on the key read as text on both sides."""
    left = df.withColumn(key, F.col(key).cast("string"))
    right = lookup.withColumn(key, F.col(key).cast("string"))
    return left.join(right, key, "inner")


def attach_image_url(
    df: DataFrame, lookup: DataFrame, key: str = "post_id", url: str = "image_url",
    out: str = "display_image_url",
) -> DataFrame:
    """Keep every row, add the image URL of its key when there is one."""
    left = df.withColumn(key, F.col(key).cast("string"))
    right = lookup.select(F.col(key).cast("string").alias(key), F.col(url).alias(out))
    return left.join(right, key, "left")


def skip_existing(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key has no output yet."""
    return df.join(existing.select(*keys), list(keys), "left_anti")


def wanted_only(lookup: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The lookup rows somebody asks for.

    A left join cannot broadcast its left side, so a big lookup would be shuffled whole
    to answer a few keys. Here Spark may send the distinct keys to the lookup when they
    are few; when they are many, this join already deals the lookup out by the key the
    next one needs.
    """
    return lookup.join(wanted.select(key).distinct(), key, "left_semi")


def first_text(lookup: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """One text per key: of the smallest ``order``, then the smallest text, NULL last."""
    first = F.min(F.struct(F.col(order), F.col(text).isNull(), F.col(text).alias("_text")))
    return lookup.groupBy(key).agg(first.alias("_first")).select(key, F.col("_first._text").alias(text))


def backfill_text(
    df: DataFrame, raw: DataFrame, default_bucket: str, text: str = "combined_text",
    source: str = "source_txt", raw_key: str = "path", raw_text: str = "text",
) -> DataFrame:
    """Fill empty texts from the cleaned raw text of their source; recompute length and flag.

    Only rows with an empty text and a readable source key are joined. A source
    that is missing gives ''. Raw rows whose paths name the same object are one
    source: the smallest path speaks for it.
    """
    key = norm_source_key(source, default_bucket)
    marked = df.withColumn("_key", F.when(~has_text(text) & key["key"].isNotNull(), key))
    found = raw.select(norm_source_key(raw_key, default_bucket).alias("_key"),
                       F.col(raw_key).alias("_path"), F.col(raw_text).alias("_raw"))
    empty = marked.where(F.col("_key").isNotNull())
    filled = (
        empty.join(first_text(wanted_only(found, empty, "_key"), "_key", "_path", "_raw"), "_key", "left")
        .withColumn(text, clean_listing_text("_raw"))
        .select(*df.columns if text in df.columns else [*df.columns, text])
    )
    untouched = marked.where(F.col("_key").isNull()).withColumn(
        text, F.coalesce(F.col(text), F.lit(""))).select(*filled.columns)
    return untouched.unionByName(filled).withColumns({
        "combined_text_len": text_len(text), "has_combined_text": has_text(text),
    })


def record_to_source(
    records: DataFrame, raw: DataFrame, key: str = "post_id", source: str = "source_txt",
    raw_key: str = "path", raw_text: str = "text",
) -> DataFrame:
    """Each record beside its raw text; what is missing is named in ``error``. A source that
    was landed twice gives its smallest text."""
    lookup = raw.select(F.col(raw_key).alias(source), F.col(raw_text).alias("raw_text"))
    blank_key = F.coalesce(F.col(key).cast("string"), F.lit("")) == ""
    blank_source = F.coalesce(F.col(source), F.lit("")) == ""
    joinable = records.where(~blank_key & ~blank_source)
    broken = records.where(blank_key | blank_source).withColumns({
        "raw_text": F.lit(None).cast("string"),
        "error": F.when(blank_key, F.lit("missing post_id")).otherwise(F.lit("missing source_txt")),
    })
    found = first_text(wanted_only(lookup, joinable, source), source, source, "raw_text")
    joined = joinable.join(found, source, "left").withColumn(
        "error", F.when(F.col("raw_text").isNull(), F.lit("source text not found")))
    return joined.select(*broken.columns).unionByName(broken)
