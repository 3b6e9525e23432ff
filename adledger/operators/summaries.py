"""Counts and fill rates: one aggregation pass each, partial sums map-side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import has_text, looks_like_path, strip
from ..schemas import TIERS


def tier_rank(tier: str = "price_tier", labels: Sequence[str] = tuple(TIERS)) -> Column:
    return F.array_position(F.array(*[F.lit(t) for t in labels]), F.col(tier))


def tier_summary(df: DataFrame, tier: str = "price_tier", price: str = "price_num",
                 labels: Sequence[str] = tuple(TIERS)) -> DataFrame:
    """Smallest, largest price and row count per tier, tiers in their own order."""
    return df.groupBy(tier).agg(
        F.min(price).alias("min"), F.max(price).alias("max"), F.count(price).alias("count"),
    ).orderBy(tier_rank(tier, labels))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).count().orderBy(column)


def recent_day_counts(df: DataFrame, day: str = "date_local", n: int = 8) -> DataFrame:
    """Rows per day for the last ``n`` days that have rows."""
    counts = df.where(F.col(day).isNotNull()).groupBy(day).count()
    return counts.orderBy(F.desc(day)).limit(n)


def fill_rates(df: DataFrame, price: str = "price_num", body: str = "combined_text",
               image: str = "image_url") -> DataFrame:
    usable = F.coalesce(strip(F.col(image)).startswith("http"), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("rows_total"),
        F.count(price).alias("valid_price_rows"),
        F.count_if(has_text(body)).alias("rows_with_text"),
        F.count_if(looks_like_path(body)).alias("path_like_rows"),
        F.count_if(usable).alias("rows_with_image"),
        F.count_if(~usable).alias("rows_without_image"),
    )


def dropped_for_target(df: DataFrame, day: str, before, price: str = "price_num") -> DataFrame:
    """Rows before a day, and how many of them have no price."""
    earlier = df.where(F.col(day) < before)
    return earlier.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(F.col(price).isNull()).alias("dropped_for_target"),
    )


def distinct_values(df: DataFrame, column: str, out: str) -> DataFrame:
    """The distinct values, sorted, one per row (never gathered into one cell)."""
    return df.select(F.col(column).alias(out)).where(F.col(out).isNotNull()).distinct().orderBy(out)


def distinct_days(df: DataFrame, day: str = "date_local") -> DataFrame:
    return distinct_values(df, day, "day")


def distinct_runs(df: DataFrame, run: str = "run_id") -> DataFrame:
    """Number of distinct runs and of rows."""
    return df.groupBy(run).agg(F.count(F.lit(1)).alias("n")).where(F.col(run).isNotNull()).agg(
        F.count(F.lit(1)).alias("n_runs"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))


def run_summary(df: DataFrame, written: Column, skipped: Column, errors: Column) -> DataFrame:
    """Counters of one job run."""
    return df.agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(written).alias("written"),
        F.count_if(skipped).alias("skipped"),
        F.count_if(errors).alias("errors"),
    )


def materialize_summary(records: DataFrame, latest: DataFrame, run: str = "run_id",
                        key: str = "post_id") -> DataFrame:
    """Runs scanned, distinct listings, rows written."""
    runs = records.select(run).distinct().agg(F.count(run).alias("runs_scanned"))
    rows = latest.agg(F.count(key).alias("unique_listings"), F.count(F.lit(1)).alias("rows_written"))
    return rows.select(runs.scalar().alias("runs_scanned"), "unique_listings", "rows_written")


def image_availability(df: DataFrame, loaded: DataFrame, url: str = "image_url",
                       key: str = "post_id") -> DataFrame:
    """Funnel: all listings, listings with a usable URL, listings whose image was loaded."""
    usable = F.coalesce(strip(F.col(url)).startswith("http"), F.lit(False))
    per_id = df.groupBy(F.col(key).cast("string").alias("_id")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(usable).alias("with_url"))
    ids = loaded.select(F.col(key).cast("string").alias("_id")).distinct().withColumn("_hit", F.lit(True))
    joined = per_id.join(ids, "_id", "left")
    return joined.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_listings"),
        F.coalesce(F.sum("with_url"), F.lit(0)).alias("listings_with_image_urls"),
        F.coalesce(F.sum(F.when(F.col("_hit"), F.col("with_url"))), F.lit(0)).alias("images_successfully_loaded"),
    )
