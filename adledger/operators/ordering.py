"""Sorts, limits and samples. Every order is total, so results repeat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def order_by_scraped_at(df: DataFrame, scraped_at: str = "scraped_at", tie: str = "post_id") -> DataFrame:
    """Ascending, NULL first as if it were ''."""
    return df.orderBy(F.coalesce(F.col(scraped_at).cast("string"), F.lit("")), F.col(tie))


def order_runs(df: DataFrame, run_dt: str = "run_dt") -> DataFrame:
    return df.orderBy(run_dt)


def order_importance(df: DataFrame, value: str = "importance_mean", tie: str = "feature") -> DataFrame:
    return df.orderBy(F.desc(value), F.asc(tie))


def order_models(df: DataFrame, score: str = "weighted_f1", tie: str = "model_name") -> DataFrame:
    return df.orderBy(F.desc(score), F.asc(tie))


def cap_files(df: DataFrame, n: int, path: str = "path") -> DataFrame:
    """First ``n`` inputs by path; 0 means all. Paths alone are ranked: of the other columns
    only the rows that stay are read and moved."""
    if n <= 0:
        return df
    last = df.select(path).orderBy(path).limit(n).agg(F.max(path)).first()[0]  # one path
    if last is None:
        return df.limit(0)
    return df.where(F.col(path) <= last).orderBy(path).limit(n)


def sample_key(key: str, seed: int):
    """Pseudo-random text order of a key, equal on every engine that has MD5."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def seeded_sample(df: DataFrame, n: int = 6, key: str = "post_id", seed: int = 42) -> DataFrame:
    """``n`` rows picked by a seeded hash of their key; fewer if fewer exist."""
    return df.withColumn("_h", sample_key(key, seed)).orderBy("_h", key).limit(n).drop("_h")


def usable_flags(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, usable): has the feature any value? One pass over the data."""
    counts = df.agg(*[F.count(f).alias(f) for f in features])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), (F.col(f) > 0).alias("usable")) for f in features
    ])))


def top_usable_features(
    importance: DataFrame, train: DataFrame, holdout: DataFrame, features: Sequence[str],
    n: int = 3, value: str = "importance_mean",
) -> DataFrame:
    """Most important features that have values in both parts."""
    usable = usable_flags(train, features).where("usable").select("feature").join(
        usable_flags(holdout, features).where("usable").select("feature"), "feature", "left_semi")
    return importance.join(usable, "feature", "left_semi").orderBy(F.desc(value), "feature").limit(n)
