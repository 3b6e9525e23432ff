"""Permutation importance and partial dependence of a fitted price model."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.entities import bound
from .features import ColumnTransformModel
from .models import SEED
from .quantiles import exact_quantiles
from .splits import global_position

# Grid of a partial dependence curve.
GRID_POINTS, GRID_FROM, GRID_TO = 100, 0.05, 0.95
#: Rounds of a keyed permutation; each changes both halves of a position.
ROUNDS = 4


def permuted(position: Column, n: int, *keys: Column) -> Column:
    """A keyed permutation of 0 .. n - 1, different for every value of the keys: where a position
    goes is computed from the position alone.

    Positions are pairs (x, y) of a grid of at least n cells, about square. A round adds a hash
    of y to x and a hash of the new x to y, which can be undone, so all rounds together permute
    the grid. A position that lands on one of the few cells from n on goes through the rounds
    again, until it does not: that closes the gaps and keeps it a permutation.
    """
    wide = max(1, math.isqrt(max(n - 1, 0)) + 1)
    high = max(1, -(-n // wide))
    outside = 1 - n / (wide * high) if n else 0.0
    # so often that not one of 2^64 positions is expected to need more
    times = 1 if outside <= 0 else 1 + math.ceil(64 * math.log(2) / -math.log(outside))

    def mixed(at: Column) -> Column:
        x = F.pmod(at, F.lit(wide)).cast("long")
        pair = F.struct(x.alias("x"), ((at - x) / F.lit(wide)).cast("long").alias("y"))

        def turn(p: Column, i: Column) -> Column:
            x = F.pmod(p["x"] + F.pmod(F.xxhash64(p["y"], i, *keys), F.lit(wide)), F.lit(wide))
            return bound(x, lambda v: F.struct(v.alias("x"), F.pmod(p["y"] + F.pmod(F.xxhash64(v, -i, *keys), F.lit(high)), F.lit(high)).alias("y")))

        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), pair, turn, lambda p: p["y"] * wide + p["x"])

    once = mixed(position.cast("long"))
    if times == 1:
        return once
    walked = F.aggregate(F.sequence(F.lit(2), F.lit(times)), once, lambda at, _: F.when(at < n, at).otherwise(mixed(at)))
    return bound(walked, lambda at: F.when(at < n, at).otherwise(F.raise_error(F.lit("no place found; choose another seed")).cast("long")))


def shuffle_columns(
    df: DataFrame, features: Sequence[str], key: str, carry: Sequence[str], repeats: int, seed: int,
) -> DataFrame:
    """Rows x (feature, repeat), the named feature's value taken from another row.

    Rows are numbered in the order of ``key``, which must identify a row (checked). For every
    repeat each row sends its features to the place a keyed permutation of the whole table
    gives it; a row then takes one feature at a time from what came to it. One shuffle of rows
    x repeats serves all features, no row meets more than ``repeats`` others, and a value can
    move anywhere in the table. The pair ('', 0) holds the rows as they are.
    """
    n, keys = df.agg(F.count(F.lit(1)), F.countDistinct(key)).first()
    if n != keys:
        raise ValueError(f"{key} does not identify a row: {n} rows, {keys} keys")
    columns = [key, *[c for c in dict.fromkeys([*carry, *features]) if c != key]]
    own, given = F.struct(*columns), F.struct(*features) if features else F.struct(F.lit(0).alias("_none"))
    placed = global_position(df.select(own.alias("_own"), given.alias("_given"), F.col(key).alias("_key")), ["_key"], "_at")
    sent = placed.select("_own", "_given", "_at", F.explode(F.sequence(F.lit(0), F.lit(repeats))).alias("_repeat"))
    to = F.when(F.col("_repeat") == 0, F.col("_at")).otherwise(permuted(F.col("_at"), n, F.col("_repeat"), F.lit(seed)))
    met = sent.select(to.alias("_to"), "_repeat", F.when(F.col("_repeat") == 0, F.col("_own")).alias("_own"), F.when(F.col("_repeat") > 0, F.col("_given")).alias("_given"))
    gathered = met.groupBy("_to").agg(F.max("_own").alias("_own"), F.collect_list(F.when(F.col("_repeat") > 0, F.struct("_repeat", "_given"))).alias("_donors"))
    pairs = F.flatten(F.transform("_donors", lambda d: F.transform(F.array(*[F.lit(f) for f in features]), lambda f: F.struct(
        f.alias("feature"), d["_repeat"].alias("repeat"), d["_given"].alias("given")))))
    plain = F.array(F.struct(F.lit("").alias("feature"), F.lit(0).alias("repeat"), F.lit(None).cast(placed.schema["_given"].dataType).alias("given")))
    each = gathered.select("_own", F.explode(F.concat(plain, pairs) if features else plain).alias("_pair"))
    return each.select(
        F.col("_pair.feature").alias("feature"), F.col("_pair.repeat").alias("repeat"),
        *[(F.when(F.col("_pair.feature") == c, F.col("_pair.given")[c]).otherwise(F.col("_own")[c]) if c in features
           else F.col("_own")[c]).alias(c) for c in columns],
    )


def permutation_importance(
    model: PipelineModel, holdout: DataFrame, features: Sequence[str], key: str = "post_id",
    label: str = "price_num", repeats: int = 30, seed: int = SEED,
) -> DataFrame:
    """Mean rise of the MAE when a feature is shuffled, per original column.

    Only rows with an actual value count. Negative values are legal.
    """
    scored = holdout.where(F.col(label).isNotNull())
    prepared = model.stages[0]
    inputs = [*prepared.numeric, *prepared.categorical] if isinstance(prepared, ColumnTransformModel) else []
    shuffled = shuffle_columns(scored, features, key, [label, *inputs], repeats, seed)
    maes = model.transform(shuffled).groupBy("feature", "repeat").agg(
        F.avg(F.abs(F.col("prediction") - F.col(label))).alias("mae"))
    # 1 + features x repeats rows from here on.
    base = F.max(F.when(F.col("repeat") == 0, F.col("mae"))).over(Window.partitionBy())
    return maes.withColumn("rise", F.col("mae") - base).where("repeat > 0").groupBy("feature").agg(
        F.avg("rise").alias("importance_mean")).orderBy(F.desc("importance_mean"), "feature")


def numeric_grid(df: DataFrame, feature: str, points: int = GRID_POINTS) -> list[float]:
    """Every value if there are fewer than ``points``, else even steps between the
    5th and 95th percentile (median-unbiased style plotting positions)."""
    values = df.select(F.col(feature).cast("double").alias("v")).where("v is not null and not isnan(v)")
    few = [r["v"] for r in values.distinct().limit(points).collect()]
    if len(few) < points:
        return sorted(few)
    n = values.count()

    def position(p: float) -> float:
        return min(1.0, max(0.0, (n * p + 0.4 + 0.2 * p - 1) / (n - 1)))

    low, high = exact_quantiles(values, "v", [position(GRID_FROM), position(GRID_TO)])
    return [low + (high - low) * i / (points - 1) for i in range(points)]


def partial_dependence(model: PipelineModel, holdout: DataFrame, feature: str,
                       points: int = GRID_POINTS) -> DataFrame:
    """Mean prediction over the whole holdout for each value of one feature.

    The grid is at most ``points`` numbers, or the categories some tree splits on plus
    one stand-in for all others (they all predict alike), so its size depends on the
    model and not on the data. Missing categories count as "unknown".
    """
    transform: ColumnTransformModel = model.stages[0]
    categorical = list(transform.categorical)
    base = holdout.fillna("unknown", [c for c in categorical if c in holdout.columns])
    if feature not in categorical:
        grid = numeric_grid(holdout, feature, points)
        return _mean_prediction(model, base, feature, grid, "double").orderBy("value").select(
            F.lit(feature).alias("feature"), F.col("value").cast("string").alias("value"),
            "avg_prediction")
    known = split_categories(model, feature)
    unseen = "\u0000unseen"
    curve = _mean_prediction(model, base, feature, [*known, unseen], "string")
    fallback = curve.where(F.col("value") == unseen).select("avg_prediction")
    present = base.select(F.col(feature).alias("value")).distinct()
    return present.join(curve, "value", "left").select(
        F.lit(feature).alias("feature"), "value",
        F.coalesce("avg_prediction", fallback.scalar()).alias("avg_prediction"),
    ).orderBy("value")


def split_categories(model: PipelineModel, feature: str) -> list[str]:
    """Categories of a feature that any tree of the model tells from the others."""
    transform: ColumnTransformModel = model.stages[0]
    if feature not in transform.categorical:
        raise ValueError(f"{feature} is no categorical feature of the model")
    return transform.categories(feature, sorted({int(i) for i in re.findall(r"feature (\d+) ", model.stages[-1].toDebugString)}))


def _mean_prediction(model: PipelineModel, df: DataFrame, feature: str, grid: Sequence, kind: str) -> DataFrame:
    # One constant, however many categories the model knows.
    values = F.from_json(F.lit(json.dumps(list(grid))), f"array<{kind}>")
    spread = df.drop(feature).withColumn(feature, F.explode(values))
    return model.transform(spread).groupBy(F.col(feature).alias("value")).agg(
        F.avg("prediction").alias("avg_prediction"))
