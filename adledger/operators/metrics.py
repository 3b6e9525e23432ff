"""Regression and classification scores. Big inputs shrink in one partial
aggregation; everything after it works on class counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import round4
from ..schemas import TIERS


def regression_metrics(df: DataFrame, actual: str = "actual_price", predicted: str = "pred_price") -> DataFrame:
    """MAE, RMSE, MAPE in percent and bias (predicted minus actual) over rows with an
    actual value; all NULL if there is none. Zero actuals have no MAPE term and are
    counted in ``n_zero_actual``."""
    scored = df.where(F.col(actual).isNotNull())
    err = F.col(predicted) - F.col(actual)
    return scored.agg(
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        (F.avg(F.abs(F.try_divide(err, F.col(actual)))) * 100).alias("mape"),
        F.avg(err).alias("bias"),
        F.count(F.lit(1)).alias("n_scored"),
        F.count_if(F.col(actual) == 0).alias("n_zero_actual"),
    )


def confusion_matrix(
    df: DataFrame, actual: str = "actual_tier", predicted: str = "predicted_tier",
    labels: Sequence[str] = tuple(TIERS),
) -> DataFrame:
    """One row per actual label, one ``pred_<label>`` column per predicted label, zeros kept.

    All cells come from one aggregate row, so nothing is shuffled by label.
    """
    cells = df.agg(*[
        F.count_if((F.col(actual) == a) & (F.col(predicted) == p)).alias(f"c{i}_{j}")
        for i, a in enumerate(labels) for j, p in enumerate(labels)
    ])
    return cells.select(F.inline(F.array(*[
        F.struct(
            F.lit(i).cast("bigint").alias("position"), F.lit(a).alias("actual"),
            *[F.col(f"c{i}_{j}").alias(f"pred_{p}") for j, p in enumerate(labels)],
        )
        for i, a in enumerate(labels)
    ])))


def class_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Per label: true positives, times predicted, times actual (support)."""
    pairs = df.groupBy(F.col(actual).alias("a"), F.col(predicted).alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    sides = pairs.select(F.inline(F.array(
        F.struct(F.col("a").alias("label"), F.when(F.col("a") == F.col("p"), F.col("n"))
                 .otherwise(F.lit(0)).alias("tp"), F.lit(0).cast("bigint").alias("predicted"),
                 F.col("n").alias("support")),
        F.struct(F.col("p").alias("label"), F.lit(0).cast("bigint").alias("tp"),
                 F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("support")),
    )))
    return sides.groupBy("label").agg(
        F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted"), F.sum("support").alias("support"))


def _class_scores(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    tp, pred, sup = F.col("tp"), F.col("predicted"), F.col("support")
    return class_counts(df, actual, predicted).select(
        "label", "tp", ratio(tp, pred).alias("precision"), ratio(tp, sup).alias("recall"),
        ratio(tp * 2, pred + sup).alias("f1"), "support")


def _weighted(c: str) -> Column:
    return F.coalesce(F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")), F.lit(0.0))


def classification_report(df: DataFrame, actual: str = "actual_tier",
                          predicted: str = "predicted_tier") -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted means.

    The accuracy row carries its value in all three score columns.
    """
    classes = _class_scores(df, actual, predicted)
    names = ["precision", "recall", "f1"]
    accuracy = F.try_divide(F.sum("tp").cast("double"), F.sum("support"))
    totals = classes.agg(
        accuracy.alias("acc"), F.sum("support").alias("support"),
        *[F.avg(c).alias(f"macro_{c}") for c in names],
        *[_weighted(c).alias(f"weighted_{c}") for c in names],
    )
    rows = [("accuracy", ["acc"] * 3), ("macro avg", [f"macro_{c}" for c in names]),
            ("weighted avg", [f"weighted_{c}" for c in names])]
    summary = totals.select(F.inline(F.array(*[
        F.struct(F.lit(label).alias("label"), *[F.col(s).alias(c) for s, c in zip(source, names)],
                 F.col("support"))
        for label, source in rows
    ])))
    return classes.select("label", *names, "support").unionByName(summary)


def accuracy_weighted_f1(df: DataFrame, actual: str = "actual_tier",
                         predicted: str = "predicted_tier") -> DataFrame:
    return _class_scores(df, actual, predicted).agg(
        F.try_divide(F.sum("tp").cast("double"), F.sum("support")).alias("accuracy"),
        _weighted("f1").alias("weighted_f1"),
    )


def error_directions(df: DataFrame, actual: str = "actual_tier",
                     predicted: str = "predicted_tier") -> DataFrame:
    """How often each wrong (actual, predicted) pair occurs, most frequent first."""
    wrong = df.where(F.col(actual) != F.col(predicted))
    return wrong.groupBy(actual, predicted).count().orderBy(F.desc("count"), actual, predicted)


def model_comparison(results: DataFrame) -> DataFrame:
    """Scores rounded to 4 digits, best weighted F1 first, with a ``place`` column.

    ``results`` has one row per model.
    """
    rounded = results.withColumns({"accuracy": round4("accuracy"), "weighted_f1": round4("weighted_f1")})
    place = F.row_number().over(Window.orderBy(F.desc("weighted_f1"), F.asc("model_name")))
    return rounded.withColumn("place", place.cast("bigint")).orderBy("place")


def best_model(results: DataFrame) -> DataFrame:
    return model_comparison(results).where("place = 1")


def comparison_verdict(results: DataFrame, baseline: str) -> DataFrame:
    """Best model, its score, the baseline's score and whether added inputs helped."""
    ranked = model_comparison(results)
    row = ranked.agg(
        F.max(F.when(F.col("place") == 1, F.col("model_name"))).alias("best_model"),
        F.max(F.when(F.col("place") == 1, F.col("weighted_f1"))).alias("best_f1"),
        F.max(F.when(F.col("model_name") == baseline, F.col("weighted_f1"))).alias("baseline_f1"),
    )
    return row.withColumn(
        "verdict",
        F.when(F.col("best_model") == baseline, "baseline is best")
        .when(F.col("best_f1") > F.col("baseline_f1"), "added inputs improve on the baseline")
        .otherwise("added inputs do not improve on the baseline"),
    )
