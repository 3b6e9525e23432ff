"""Sharding by histogram sort, with DataFrame operations only.

Rows are ordered by (hash of the text, hash of the id), so equal texts lie side by side.
The splitters between shards are found by counting: each round counts the exact bytes
in 4096 equal cells of every key range that still holds an unsettled splitter, and keeps
the one cell around each target. A splitter is settled when a cell boundary lies within
the tolerance of its target; only when no boundary between different texts does, it goes
on into the ids of one group of equal texts. Then rows are exchanged once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

STEP = 12
WIDTH = 128
LOW = -(2**63)


@dataclass
class Probe:
    """A key range: the first ``bits`` bits of the 128-bit key are ``prefix``; ``below`` bytes
    come before it, it holds ``size`` bytes in ``rows`` rows."""

    prefix: int = 0
    bits: int = 0
    below: int = 0
    size: int = 0
    rows: int = 0


def splitter_keys(keyed: DataFrame, shards: int, tolerance: float) -> list[int]:
    """The 128-bit key at which each shard but the first begins.

    keyed(k1, k2, size): key halves as unsigned numbers in longs. Every round is one
    narrow scan; at most 4096 counts per open splitter come back to the driver.
    """
    total, rows = keyed.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    targets = [total * k / shards for k in range(1, shards)]
    allowed = tolerance * total / shards
    open_ = dict.fromkeys(range(len(targets)), Probe(size=total, rows=rows))
    found: dict[int, int] = {}
    while open_:
        for k, p in list(open_.items()):
            low, high = abs(targets[k] - p.below), abs(p.below + p.size - targets[k])
            settled = min(low, high) <= allowed or p.rows <= 1 or p.bits == WIDTH
            if settled:  # at either end of the range, whichever is nearer
                found[k] = (p.prefix if low <= high else p.prefix + 1) << (WIDTH - p.bits)
                del open_[k]
        if not open_:
            break
        # All open ranges are refined from the same number of bits.
        bits = next(iter(open_.values())).bits
        wide = min(STEP, (64 if bits < 64 else WIDTH) - bits)
        cells: dict[int, list[tuple[int, int, int]]] = {}
        ranges = sorted({p.prefix for p in open_.values()})
        inside = _within(bits, ranges)
        counted = keyed.filter(inside).groupBy(*_cell(bits + wide)).agg(F.sum("size").alias("s"), F.count("*").alias("n"))
        for r in counted.collect():
            cell = (r["c1"] % 2**64) << max(0, bits + wide - 64) | r["c2"] % 2**64
            cells.setdefault(cell >> wide, []).append((cell, r["s"], r["n"]))
        for k, p in open_.items():
            below = p.below
            for cell, size, n in sorted(cells[p.prefix]):
                if below + size >= targets[k]:
                    break
                below += size
            open_[k] = Probe(cell, bits + wide, below, size, n)
    return [found[k] for k in range(len(targets))]


def _cell(bits: int) -> list[Column]:
    """The first ``bits`` bits of the key in two columns."""
    if bits <= 64:
        return [F.shiftrightunsigned("k1", 64 - bits).alias("c1"), F.lit(0).cast("long").alias("c2")]
    return [F.col("k1").alias("c1"), F.shiftrightunsigned("k2", WIDTH - bits).alias("c2")]


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _within(bits: int, prefixes: list[int]) -> Column:
    if not bits:
        return F.lit(True)
    if bits <= 64:
        return F.shiftrightunsigned("k1", 64 - bits).isin([_signed(p) for p in prefixes])
    both = F.struct(F.col("k1").alias("a"), (F.shiftrightunsigned("k2", WIDTH - bits) if bits < WIDTH else F.col("k2")).alias("b"))
    return both.isin([F.struct(F.lit(_signed(p >> (bits - 64))).alias("a"), F.lit(_signed(p % 2 ** (bits - 64))).alias("b"))
                      for p in prefixes])


def _shard_of(bounds: list[int], k1: str, k2: str) -> Column:
    """Number of splitters at or below the key of a row."""
    k1, k2 = (F.col(c).bitwiseXOR(F.lit(LOW)) for c in (k1, k2))  # unsigned order

    def reached(bound: int) -> Column:
        if bound >= 2**WIDTH:
            return F.lit(0)
        a, b = (bound >> 64) + LOW, bound % 2**64 + LOW
        return ((k1 > a) | ((k1 == a) & (k2 >= b))).cast("int")

    return sum((reached(b) for b in bounds), F.lit(0))


def shard(df: DataFrame, shards: int = 24, text: str = "text", order: str = "doc_id", size: str = "size",
          tolerance: float = 0.005, rows_per_run: int = 500_000) -> DataFrame:
    """Add ``shard`` (0 to shards - 1) and ``slot`` (0, 1, ... within the shard) to every row.

    Bytes per shard differ from an equal part by at most twice ``tolerance`` of it, or by
    one row where single rows are larger than that. ``size`` is the column of bytes of a
    row. Equal texts share a shard unless a group of them is too large for the tolerance;
    null texts count as one text, null ids sort by their hash like others, and repeated
    rows have slots of their own. Columns named shard or slot are replaced.
    """
    df = df.drop("shard", "slot")
    keys = {"k1": F.xxhash64(F.coalesce(text, F.lit("")), F.col(text).isNull()), "k2": F.xxhash64(order)}
    narrow = stored(df.select(*[c.alias(n) for n, c in keys.items()], F.col(size).cast("long").alias("size")), "shard-keys")
    bounds = splitter_keys(narrow, shards, tolerance)
    # A shard is sorted in runs, so that no task sorts a whole one; runs are numbered through.
    runs = 1 + narrow.count() // (shards * rows_per_run)
    place = lambda k1, k2: {"__shard": _shard_of(bounds, k1, k2), "__run": F.pmod(F.xxhash64(k2, F.lit(7)), F.lit(runs)).cast("int")}
    counts = narrow.withColumns(place("k1", "k2")).groupBy("__shard", "__run").agg(F.count("*").alias("n"))
    before = counts.select("__shard", "__run", (F.sum("n").over(Window.partitionBy("__shard").orderBy("__run")) - F.col("n")).alias("__before"))
    in_run = F.row_number().over(Window.partitionBy("__shard", "__run").orderBy(*[F.col(k).bitwiseXOR(F.lit(LOW)) for k in ("__k1", "__k2")]))
    placed = df.withColumns({f"__{n}": c for n, c in keys.items()}).withColumns(place("__k1", "__k2")).withColumn("__in_run", in_run)
    # The numbered rows already lie by shard and run, which is what this join asks for.
    return placed.join(before, ["__shard", "__run"]).withColumns({
        "shard": F.col("__shard"), "slot": F.col("__before") + F.col("__in_run") - 1}).drop("__shard", "__run", "__k1", "__k2", "__in_run", "__before")


def write_shards(df: DataFrame, path: str) -> None:
    """Write rows that have a shard and a slot, one folder per shard, in slot order."""
    df.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
