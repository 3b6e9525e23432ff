"""Projections and filters. All narrow: none of them shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import text
from ..functions.numbers import clean_numeric_column
from ..functions.times import is_run_id

# Bounds of a believable price, both outside the band.
PRICE_FLOOR, PRICE_CEILING = 500, 100_000
# Parts of a column name that hint at images.
IMAGE_TERMS = ["image", "img", "photo", "picture", "url"]


def project_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[c for c in columns if c in df.columns])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns: missing ones NULL, others dropped, types cast."""
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).try_cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def valid_run_filter(df: DataFrame, run: str = "run_id") -> DataFrame:
    return df.where(is_run_id(run))


def newest_run(df: DataFrame, run: str = "run_id") -> DataFrame:
    """Rows of the last run in string order (the default run of a job)."""
    return df.where(F.col(run) == df.agg(F.max(run)).scalar())


def recent_runs(df: DataFrame, n: int = 200, run: str = "run_id") -> DataFrame:
    """Rows of the last ``n`` run ids in string order. A NULL is no run: such rows are
    left out whatever ``n`` is.

    Run ids are counted map-side before the top-n; the kept list has at most
    ``n`` rows, so broadcasting it is safe at any data size.
    """
    kept = df.select(run).where(F.col(run).isNotNull()).distinct().orderBy(F.desc(run)).limit(n)
    return df.join(F.broadcast(kept), run, "left_semi")


def drop_missing_key(df: DataFrame, key: str = "post_id") -> DataFrame:
    return df.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))


def drop_bad_date(df: DataFrame, day: str = "date_local") -> DataFrame:
    return df.where(F.col(day).isNotNull())


def price_band_filter(
    df: DataFrame, price: str = "price_num", low: float = PRICE_FLOOR, high: float = PRICE_CEILING
) -> DataFrame:
    return df.where((F.col(price) > low) & (F.col(price) < high) & ~F.isnan(F.col(price).cast("double")))


def usable_image_filter(df: DataFrame, url: str = "image_url") -> DataFrame:
    trimmed = text.strip(F.col(url))
    return df.withColumn(url, trimmed).where(F.col(url).startswith("http"))


def path_like_filter(df: DataFrame, column: str = "combined_text") -> DataFrame:
    """Rows whose text looks like a file path instead of a listing."""
    return df.where(text.looks_like_path(column))


def price_leak_flag(
    df: DataFrame, price: str = "price_num", body: str = "combined_text",
    out: str = "price_appears_in_text",
) -> DataFrame:
    return df.withColumn(out, text.price_in_text(price, body))


def incorrect_only(df: DataFrame, actual: str = "actual_tier", predicted: str = "predicted_tier") -> DataFrame:
    correct = F.col(actual) == F.col(predicted)
    return df.withColumn("correct_prediction", correct).where(~correct)


def columns_like(df: DataFrame, terms: Sequence[str] = tuple(IMAGE_TERMS)) -> list[str]:
    return [c for c in df.columns if any(t in c.lower() for t in terms)]


def columns_like_counts(df: DataFrame, terms: Sequence[str] = tuple(IMAGE_TERMS)) -> DataFrame:
    """One row per matching column with its non-null count, from a single pass."""
    names = columns_like(df, terms)
    if not names:
        empty = T.StructType([T.StructField("column_name", T.StringType()),
                              T.StructField("non_null", T.LongType())])
        return df.sparkSession.createDataFrame([], empty)
    counts = df.agg(*[F.count(c).alias(c) for c in names])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("non_null")) for c in names
    ])))


def numeric_features(df: DataFrame) -> DataFrame:
    """``*_num`` twins of the year, mileage and cylinder columns that exist."""
    names = [c for c in ("year", "mileage", "engine_cylinders") if c in df.columns]
    return df.withColumns({f"{c}_num": clean_numeric_column(df, c) for c in names})


def derived_columns(
    df: DataFrame, year: str = "year_num", mileage: str = "mileage_num", reference_year: int = 2026
) -> DataFrame:
    """Vehicle age and miles per year; age 0 gives NULL miles per year."""
    out = df
    if year in df.columns:
        out = out.withColumn("vehicle_age", F.lit(reference_year) - F.col(year))
        if mileage in df.columns:
            age = F.nullif(F.col("vehicle_age"), F.lit(0))
            out = out.withColumn("miles_per_year", F.col(mileage) / age)
    return out
