"""Newest, first and ranked rows per key.

``row_number() = 1`` directly under a filter plans a partial group limit before
the exchange, so a key holding a third of all rows shrinks to one row per task
before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.times import parse_run_id
from .filters import drop_missing_key

BLOCK_ROWS = 4096


def _first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_by_key(
    df: DataFrame, key: str = "post_id", run: str = "run_id", folder_run: str | None = None,
    path: str = "source_txt", invalid_run: str = "now",
) -> DataFrame:
    """Newest record per key; of equal run times the first seen wins.

    First seen means ascending landing folder, then file path.
    """
    first_seen = [F.col(folder_run or run).asc(), F.col(path).asc()]
    run_col = F.coalesce(F.col(run), F.col(folder_run)) if folder_run else F.col(run)
    ranked = drop_missing_key(df, key).withColumn("_at", parse_run_id(run_col, invalid_run))
    return _first_per_key(ranked, [key], [F.desc("_at"), *first_seen]).drop("_at")


def first_by_key_capped(df: DataFrame, key: str, position: Sequence[str], n: int | None) -> DataFrame:
    """First row per key in discovery order, then the first ``n`` of those (None: all)."""
    order = [F.asc(p) for p in position]
    return cap_items(_first_per_key(drop_missing_key(df, key), [key], order), position, n)


def cap_items(df: DataFrame, position: Sequence[str], n: int | None) -> DataFrame:
    """First ``n`` rows in the given order (a per-task top-n, merged)."""
    if n is None:
        return df
    return df.orderBy(*[F.asc(p) for p in position]).limit(n)


def rank_per_group(
    df: DataFrame, group: str = "run_id", value: str = "importance", tie: str = "feature",
    out: str = "rank",
) -> DataFrame:
    """Rank 1..n without gaps, largest value first, ties by ``tie``.

    A group is one run's features, so it is small.
    """
    w = Window.partitionBy(group).orderBy(F.desc(value), F.asc(tie))
    return df.withColumn(out, F.row_number().over(w).cast("bigint"))


def adjacent_dedup(df: DataFrame, group: str, position: str, value: str,
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Drop a row whose value equals the row just before it in its group.

    Positions must be gapless whole numbers from 0 or 1 on. A group is cut into
    blocks of positions, so even one huge group spreads over all tasks; the last
    row of a block also goes to the next one, to be compared with and then dropped.
    """
    block = F.floor(F.col(position) / block_rows)
    here = F.struct(block.alias("block"), F.lit(False).alias("carried"))
    there = F.struct((block + 1).alias("block"), F.lit(True).alias("carried"))
    last = F.col(position) % block_rows == block_rows - 1
    placed = df.withColumn("_at", F.explode(F.when(last, F.array(here, there)).otherwise(F.array(here))))
    w = Window.partitionBy(group, "_at.block").orderBy(position)
    marked = placed.withColumns({
        "_first": F.row_number().over(w) == 1, "_before": F.lag(value).over(w)})
    keep = F.col("_first") | ~F.col(value).eqNullSafe(F.col("_before"))
    return marked.where(~F.col("_at.carried") & keep).select(*df.columns)


def best_run_row(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """First row after sorting."""
    return df.orderBy(*order).limit(1)
