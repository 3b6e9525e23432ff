"""Landed web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """(page_id, url, html) from parquet, or (url, html) from one HTML file per page."""
    if fmt == "parquet":
        return spark.read.parquet(path).select("page_id", "url", "html")
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.html")
    return files.select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))
