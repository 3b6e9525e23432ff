"""Unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.html import extract_links, live_markup, post_id_from_url


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Rows of all frames under the sorted union of their columns; absent cells NULL."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return merged.select(*sorted(merged.columns))


def append_results(*frames: DataFrame) -> DataFrame:
    """Stack result rows of equal shape."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_links(pages: DataFrame, base: str, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """One row per distinct listing link of each page, numbered in order of discovery."""
    # An inner explode would compute the links twice: Spark filters empty arrays before it.
    return pages.withColumn("_live", live_markup(html)).select(
        page_id, F.posexplode_outer(extract_links(html, base, "_live")).alias("position", "url")
    ).where(F.col("url").isNotNull()).withColumn("post_id", post_id_from_url("url"))
