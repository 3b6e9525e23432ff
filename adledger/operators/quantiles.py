"""Exact order statistics by selection on the digits of the numbers: nothing is sorted.

The range between the least and the largest value is cut into cells; one pass counts the values
of each cell. A wanted rank lies in one cell, whose own least and largest value bound the next,
finer pass, until a cell holds one value only. A range of several octaves or both signs is cut
by the logarithm, in even steps of the binary exponent; within an octave by the fraction. So two
passes settle the exponent and five more the 52 bits of the fraction, whatever the values are.
All columns and ranks share each pass, and the driver sees a fixed number of counts per open
range, whatever the data's size.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

#: Cells an open range is cut into.
CELLS = 4096
#: No double lies further from 1 than so many octaves.
OCTAVES = 1075.0
Place = tuple[str, int]


def quantiles_of(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], cells: int = CELLS
) -> dict[str, list[float | None]]:
    """Exact linearly interpolated quantiles of several numeric columns (NULL and NaN left out;
    None without values).

    Fits eagerly, like an ML estimator: the answer is a handful of numbers.
    """
    if not columns:
        return {}
    values = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns])
    finite = {c: F.when(F.abs(F.col(c)) < math.inf, F.col(c)) for c in columns}
    seen = values.agg(*[x for c in columns for x in (
        F.count(c), F.count_if(F.col(c) == -math.inf), F.count_if(F.col(c) == math.inf), F.min(finite[c]), F.max(finite[c]))]).first()
    spans = {c: seen[5 * i:5 * i + 5] for i, c in enumerate(columns)}
    ranks = {c: [(spans[c][0] - 1) * p for p in probs] for c in columns if spans[c][0]}
    at: dict[Place, float] = {}
    for c, r in {(c, f(r)) for c, rs in ranks.items() for r in rs for f in (math.floor, math.ceil)}:
        n, lowest, highest, _, _ = spans[c]
        at[c, r] = -math.inf if r < lowest else math.inf if r >= n - highest else math.nan
    at |= _select(values, {c: _Range(c, low, high, below) for c, (_, below, _, low, high) in spans.items() if low is not None},
                  [p for p, v in at.items() if math.isnan(v)], cells)

    def between(c: str, r: float) -> float:
        low, high = math.floor(r), math.ceil(r)
        a, b = at[c, low], at[c, high]
        return a if a == b else (high - r) * a + (r - low) * b

    return {c: [between(c, r) for r in ranks[c]] if c in ranks else [None] * len(probs) for c in columns}


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float], cells: int = CELLS) -> list[float | None]:
    return quantiles_of(df, [column], probs, cells)[column]


@dataclass(frozen=True)
class _Range:
    """A closed range of a column's values whose ends occur, and the number of values below it."""

    column: str
    low: float
    high: float
    below: int

    def holds(self) -> Column:
        return F.col(self.column).between(self.low, self.high)

    def cell(self, cells: int) -> Column:
        """Number of the cell of a value inside: grows with the value, and differs for both ends."""
        v = F.col(self.column)
        if self.low > 0 and self.high <= 2 * self.low or self.high < 0 and self.low >= 2 * self.high:
            return F.floor((v - self.low) / (self.high - self.low) * cells)
        if self.low > 0 or self.high < 0:  # one sign: octaves between the ends
            first, last = sorted((math.log2(abs(self.low)), math.log2(abs(self.high))))
        else:
            first, last = -OCTAVES, OCTAVES
        size = F.floor((F.log2(F.abs(v)) - first) / (last - first) * cells) + 1
        return F.when(v < 0, -size).when(v > 0, size).otherwise(0)


def _counted(values: DataFrame, ranges: list[_Range], cells: int) -> list[dict]:
    """Rows, least and largest value of every cell of the ranges, in one pass."""
    columns: dict[str, list[int]] = {}
    for i, r in enumerate(ranges):
        columns.setdefault(r.column, []).append(i)
    tags = []
    for c, own in columns.items():  # ranges of one column do not meet
        tag = F.lit(None)
        for i in own:
            tag = F.when(ranges[i].holds(), F.struct(F.lit(i).alias("range"), ranges[i].cell(cells).cast("long").alias("cell"), F.col(c).alias("v"))).otherwise(tag)
        tags.append(tag)
    found = values.select(tags[0].alias("t") if len(tags) == 1 else F.explode(F.array(*tags)).alias("t")).where(F.col("t").isNotNull())
    return found.groupBy("t.range", "t.cell").agg(F.count(F.lit(1)).alias("n"), F.min("t.v").alias("low"), F.max("t.v").alias("high")).collect()


def _select(values: DataFrame, whole: dict[str, _Range], wanted: Iterable[Place], cells: int) -> dict[Place, float]:
    """Values at 0-based ranks of the columns, all narrowed in the same passes."""
    open_: dict[_Range, list[int]] = {}
    found: dict[Place, float] = {}

    def keep(r: _Range, rank: int) -> None:
        if r.low == r.high:
            found[r.column, rank] = r.low
        else:
            open_.setdefault(r, []).append(rank)

    for column, rank in wanted:
        keep(whole[column], rank)
    while open_:
        passed, open_ = list(open_.items()), {}
        counted: dict[int, list] = {}
        for row in _counted(values, [r for r, _ in passed], cells):
            counted.setdefault(row["range"], []).append(row)
        for i, (r, ranks) in enumerate(passed):
            below, left = r.below, sorted(ranks)
            for cell in sorted(counted[i], key=lambda x: x["low"]):
                while left and left[0] < below + cell["n"]:
                    keep(_Range(r.column, cell["low"], cell["high"], below), left.pop(0))
                below += cell["n"]
    return found
