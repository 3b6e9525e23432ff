"""Price tiers, day splits, stratified splits, folds."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window, functions as F

from ..schemas import TIERS
from ..session import checkpoint_root, stored
from .ordering import sample_key
from .quantiles import exact_quantiles

# Fixed value: a day split needs this many priced training rows.
MIN_TRAIN_ROWS = 40
# Hash buckets of the exact split: hex digits of the key hash that form a bucket.
BUCKET_DIGITS = 4


def tier_edges(df: DataFrame, price: str, labels: Sequence[str] = tuple(TIERS)) -> list[float]:
    """Inner cut points of equal-count tiers (exact, linearly interpolated)."""
    return exact_quantiles(df, price, [i / len(labels) for i in range(1, len(labels))])


def price_tier(
    df: DataFrame, price: str = "price_num", labels: Sequence[str] = tuple(TIERS),
    out: str = "price_tier", edges: Sequence[float] | None = None,
) -> DataFrame:
    """Equal-count tiers, right-closed. Filter the price band before calling.

    ``tier_warning`` is true when cut points coincide, so that fewer tiers exist.
    """
    edges = list(edges) if edges is not None else tier_edges(df, price, labels)
    if any(e is None for e in edges):
        return df.withColumns({out: F.lit(None).cast("string"), "tier_warning": F.lit(True)})
    label = F.lit(labels[-1])
    for cut, name in reversed(list(zip(edges, labels))):
        label = F.when(F.col(price) <= cut, F.lit(name)).otherwise(label)
    return df.withColumns({
        out: F.when(F.col(price).isNotNull(), label),
        "tier_warning": F.lit(len(set(edges)) < len(edges)),
    })


@dataclass
class DaySplit:
    """Result of `day_split`; ``train`` and ``holdout`` are None when status is noop."""

    status: str
    reason: str | None = None
    last_day: object = None
    train: DataFrame | None = None
    holdout: DataFrame | None = None
    stats: dict = field(default_factory=dict)


def day_split(
    df: DataFrame, day: str = "date_local", price: str = "price_num",
    min_train_rows: int = MIN_TRAIN_ROWS,
) -> DaySplit:
    """Train on all days before the last one, hold out the last day.

    Rows without a price leave the training part only. One row of numbers reaches
    the driver; the per-day table it comes from has one row per calendar day.
    """
    days = df.where(F.col(day).isNotNull()).groupBy(F.col(day).alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(price).alias("priced"))
    last = F.max(F.struct("day", "rows", "priced")).alias("last")
    row = days.agg(F.count(F.lit(1)).alias("days"), F.sum("rows").alias("rows"),
                   F.sum("priced").alias("priced"), last).first()
    if row["days"] < 2:
        return DaySplit("noop", "need at least two distinct dates", stats={"days": row["days"]})
    latest = row["last"]
    train_rows = row["priced"] - latest["priced"]
    stats = {
        "days": row["days"],
        "valid_price_rows": row["priced"],
        "train_rows": train_rows,
        "holdout_rows": latest["rows"],
        "dropped_for_target": row["rows"] - latest["rows"] - train_rows,
    }
    if train_rows < min_train_rows:
        return DaySplit("noop", "too few training rows", latest["day"], stats=stats)
    cut = F.lit(latest["day"])
    return DaySplit(
        "ok", None, latest["day"],
        df.where((F.col(day) < cut) & F.col(price).isNotNull()), df.where(F.col(day) == cut), stats,
    )


def stratified_split(
    df: DataFrame, strata: str, key: str, test_size: float = 0.2, seed: int = 42,
    out: str = "split",
) -> DataFrame:
    """Mark each row ``train`` or ``test``, exact share per stratum, same on every run.

    The test set has ``ceil(test_size * n)`` rows, shared out over the strata by
    largest remainder. Within a stratum the rows with the smallest seeded key hash
    are taken. No stratum is ever sorted or shuffled as a whole: counts per hash
    bucket locate the one bucket holding the cut, only its rows are ranked, and
    the cut points (one small row per stratum) are then compared with each row where
    it lies. Rows with equal keys stay together; rows without a stratum are train.
    """
    h = sample_key(key, seed)
    keyed = df.select(F.col(strata).alias("_s"), F.col(key).cast("string").alias("_k"), h.alias("_h")) \
        .where(F.col("_s").isNotNull()).withColumn("_b", F.substring("_h", 1, BUCKET_DIGITS))
    edge = stored(_edge_buckets(keyed, test_size), "edge-buckets")
    # Rank only the rows of each stratum's edge bucket, equal keys counted first.
    inside = keyed.join(edge, ["_s", "_b"]).groupBy("_s", "need", "_h", "_k").agg(
        F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(
        Window.partitionBy("_s").orderBy("_h", "_k").rowsBetween(Window.unboundedPreceding, 0))
    cuts = inside.withColumn("upto", upto).where(F.col("upto") <= F.col("need")).groupBy("_s").agg(
        F.max(F.struct("_h", "_k")).alias("_cut"))
    limits = stored(edge.join(cuts, "_s", "left").select("_s", F.col("_b").alias("_edge"), "_cut"), "cut-points")

    point = F.struct(h.alias("_h"), F.col(key).cast("string").alias("_k"))
    is_test = (F.substring(h, 1, BUCKET_DIGITS) < F.col("_edge")) | (point <= F.col("_cut"))
    joined = df.join(limits, df[strata] == limits["_s"], "left")
    return joined.withColumn(
        out, F.when(F.coalesce(is_test, F.lit(False)), "test").otherwise("train")
    ).select(*df.columns, out)


def _edge_buckets(keyed: DataFrame, test_size: float) -> DataFrame:
    """Per stratum the hash bucket its share ends in, and how many rows it needs from it.

    Works on counts: at most one row per stratum and bucket.
    """
    buckets = stored(keyed.groupBy("_s", "_b").agg(F.count(F.lit(1)).alias("n")), "hash-buckets")
    sizes = buckets.groupBy("_s").agg(F.sum("n").alias("size"))
    total = sizes.agg(F.sum("size")).first()[0]
    if total is None:
        return buckets.select("_s", "_b", F.col("n").alias("need")).limit(0)
    n_test = math.ceil(test_size * total)
    # Largest remainder, in whole numbers. Strata are put in order over all tasks, by ranges and
    # the numbers of strata in the ranges before.
    share = sizes.withColumn("_p", F.col("size").cast("decimal(38,0)") * F.lit(n_test)).withColumns({
        "base": F.expr(f"_p div {total}").cast("bigint"), "rest": F.expr(f"-(_p % {total})")}).drop("_p")
    left_over = n_test - (share.agg(F.sum("base")).first()[0])
    extra = (F.col("_place") < left_over).cast("bigint")
    take = global_position(share, ["rest", "_s"], "_place").select("_s", (F.col("base") + extra).alias("take"))
    running = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    return (
        buckets.withColumn("upto", F.sum("n").over(running)).join(take, "_s")
        .where((F.col("upto") >= F.col("take")) & (F.col("upto") - F.col("n") < F.col("take")))
        .select("_s", "_b", (F.col("take") - F.col("upto") + F.col("n")).alias("need"))
    )


def global_position(df: DataFrame, order: Sequence[str], out: str = "position") -> DataFrame:
    """0-based position of every row in a total order, without a one-task sort.

    Rows are range-partitioned, numbered within their range and shifted by the
    sizes of the ranges before (one row per range). The ranges are checkpointed so
    that counting and numbering see the same ones even if an executor is lost.
    """
    checkpoint_root(df.sparkSession)
    parts = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).checkpoint()
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("_part")) - F.col("n")
    offsets = sizes.select("_part", before.alias("_offset"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return parts.join(offsets, "_part").withColumn(out, within + F.col("_offset") - 1).drop("_part", "_offset")


def contiguous_folds(df: DataFrame, order: Sequence[str], folds: int = 3, out: str = "fold") -> DataFrame:
    """Unshuffled folds over the table order; the first ``n % folds`` folds get one row more.

    ``order`` must identify a row. Only the order columns are sorted, to find the
    first key of each fold; the rows themselves are never shuffled.
    """
    placed = global_position(df.select(*order), order, "_pos")
    n = placed.count()
    starts = [j * (n // folds) + min(j, n % folds) for j in range(1, folds)]
    firsts = placed.where(F.col("_pos").isin([p for p in starts if p < n])).select(*order).collect()
    key = F.struct(*order)
    types = {f.name: f.dataType for f in df.schema.fields}
    past = [key >= F.struct(*[F.lit(r[c]).cast(types[c]).alias(c) for c in order]) for r in firsts]
    fold = F.lit(0)
    for p in past:
        fold = fold + p.cast("int")
    return df.withColumn(out, fold)
