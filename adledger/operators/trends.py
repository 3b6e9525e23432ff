"""Run-over-run tables.

Inputs hold one row per run (or per run and feature). Runs are at most hourly, so
these tables are bounded by the calendar, not by the listings; the windows over
all runs below are safe for that reason and must not be used on listings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import round1, round2
from ..functions.records import expand_struct
from .dedup import rank_per_group

# The four error metrics of a run and their labels.
ERROR_METRICS = {
    "mae_today": "MAE ($)", "rmse_today": "RMSE ($)", "mape_today": "MAPE (%)", "bias_today": "Bias ($)",
}


def run_span(df: DataFrame, run_dt: str = "run_dt") -> DataFrame:
    """First and latest run, whole days between them, number of runs."""
    return df.agg(
        F.min(run_dt).alias("first_run"), F.max(run_dt).alias("latest_run"),
        F.count(F.lit(1)).alias("n_runs"),
    ).withColumn(
        "days_spanned",
        F.floor((F.unix_seconds(F.col("latest_run").cast("timestamp"))
                 - F.unix_seconds(F.col("first_run").cast("timestamp"))) / 86400).cast("bigint"))


def half_index(df: DataFrame, run_dt: str = "run_dt", tie: Sequence[str] = ()) -> DataFrame:
    """Position of each run, number of runs, and its half (the first has ``floor(n/2)``)."""
    order = Window.orderBy(run_dt, *tie)
    placed = df.withColumns({
        "position": F.row_number().over(order).cast("bigint"),
        "n_runs": F.count(F.lit(1)).over(Window.partitionBy()),
    })
    return placed.withColumn(
        "half", F.when(F.col("position") <= F.floor(F.col("n_runs") / 2), 1).otherwise(2).cast("bigint"))


def trend_halves(df: DataFrame, run_dt: str = "run_dt",
                 metrics: Sequence[str] = tuple(ERROR_METRICS), tie: Sequence[str] = ()) -> DataFrame:
    """Mean of each metric over the early and the recent half and its direction.

    A metric named ``bias...`` compares absolute means and knows no Stable. Fewer
    than two runs give no rows.
    """
    halves = half_index(df, run_dt, tie)
    means = halves.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(F.when(F.col("half") == h, F.col(m))).alias(f"{m}_{h}") for m in metrics for h in (1, 2)],
    ).where("n >= 2")

    def direction(m: str) -> Column:
        early, recent = F.col(f"{m}_1"), F.col(f"{m}_2")
        if m.startswith("bias"):
            return F.when(F.abs(recent) < F.abs(early), "Improving").otherwise("Worsening")
        return F.when(recent < early, "Improving").when(recent > early, "Worsening").otherwise("Stable")

    return means.select(F.inline(F.array(*[
        F.struct(
            F.lit(m).alias("metric"), F.lit(ERROR_METRICS.get(m, m)).alias("label"),
            F.col(f"{m}_1").alias("early_mean"), F.col(f"{m}_2").alias("recent_mean"),
            direction(m).alias("direction"),
        ) for m in metrics
    ])))


def importance_pivot(df: DataFrame, features: Sequence[str], run: str = "run_dt",
                     feature: str = "feature", value: str = "importance") -> DataFrame:
    """Run by feature matrix of mean importance, gaps 0. The feature list is passed, not scanned."""
    return df.groupBy(run).pivot(feature, list(features)).agg(F.avg(value)).na.fill(0.0, list(features))


def top_features(df: DataFrame, n: int = 8, run: str = "run_dt", feature: str = "feature",
                 value: str = "importance") -> DataFrame:
    """Mean importance over all runs, a feature absent from a run counting 0 there."""
    per_run = df.groupBy(run, feature).agg(F.avg(value).alias("v"))
    runs = df.select(run).distinct().agg(F.count(F.lit(1)).alias("n_runs")).scalar()
    return per_run.groupBy(feature).agg(F.sum("v").alias("total")).select(
        feature, (F.col("total") / runs).alias("avg_importance"),
    ).orderBy(F.desc("avg_importance"), feature).limit(n)


def rank_stability(df: DataFrame, run: str = "run_id", feature: str = "feature",
                   value: str = "importance", tie: str = "feature") -> DataFrame:
    """Mean rank and its sample deviation over the runs a feature is in, with a label.

    Pass ``tie="position"`` to rank equal values as the run's file lists them.

    The deviation is rounded before it is labelled; one run only is Volatile.
    """
    ranks = rank_per_group(df, run, value, tie)
    stats = ranks.groupBy(feature).agg(
        round1(F.avg("rank")).alias("avg_rank"), round2(F.stddev_samp("rank")).alias("rank_std"))
    label = F.when(F.col("rank_std") < 1.0, "Stable").when(F.col("rank_std") < 2.0, "Moderate") \
        .otherwise("Volatile")
    return stats.withColumn("stability", label).orderBy("avg_rank", feature)


def run_params(df: DataFrame, keep: Sequence[str] = ("run_dt", "train_rows", "best_cv_mae"),
               params: str = "best_params") -> DataFrame:
    """Chosen hyper-parameters of each run as columns, ``model__`` removed."""
    return expand_struct(df.select(*keep, params), params, "model__")


def param_usage(df: DataFrame, params: str = "best_params") -> DataFrame:
    """How often each value of each hyper-parameter was chosen."""
    flat = run_params(df, (), params)
    pairs = flat.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("param"), F.col(c).cast("string").alias("value")) for c in flat.columns
    ])))
    return pairs.groupBy("param", "value").count().orderBy("param", F.desc("count"), "value")


def cv_vs_holdout(df: DataFrame, run_dt: str = "run_dt") -> DataFrame:
    return df.select(
        run_dt, "best_cv_mae", "mae_today", (F.col("mae_today") - F.col("best_cv_mae")).alias("gap"))


def training_growth(df: DataFrame, run_dt: str = "run_dt") -> DataFrame:
    """Training and holdout rows of each run, stacked total and holdout share."""
    total = F.col("train_rows") + F.col("holdout_rows")
    return df.select(
        run_dt, "train_rows", "holdout_rows", total.alias("total_rows"),
        F.try_divide(F.col("holdout_rows").cast("double"), total).alias("holdout_share"))
