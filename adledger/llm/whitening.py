"""Whitening of embeddings: blockwise QR, then a qd solver for the small triangular factor.

Entries become integers floor(256 c). The distinct vectors are the fit list: their exact
sums give the centre, tasks reduce the centred rows block by block to triangular factors,
and a tree of small joins leaves one factor as wide as a vector. ``bidiagonal`` takes its
singular values and directions; every row is then projected where it lies.

Nulls, ties and odd rows: a null vector, and one with a null or non-finite entry, is left out;
a shorter vector counts as continued by zeros up to the longest. Repeated rows are all returned
and fit once. A null id is returned as null. An entry whose 256-fold lies outside a long is cut
to the long's end, and so is a deviation. Fewer than four components come back where the
vectors have fewer directions (none for a single vector or an empty table). Equal eigenvalues
have any orthonormal directions of their space. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bidiagonal import leading
from .common import stored

SCALE = 256
#: Rows of one QR step, and factors joined in one task.
BLOCK, FAN_IN = 4096, 16
#: Directions whose deviation is at most this part of the first one's are rounding.
FLOOR = 1e-10
LONG_END = 2**63 - 1
OUT = ("component int, n long, deviation long, whitened double, explained double, identity_error double")


def usable(vector: Column) -> Column:
    """Not null, and every entry a finite number."""
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & (F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False))) & ~F.isnan(c))


def quantised(vector: Column, scale: int, width: int) -> Column:
    """floor(scale * c) of every entry as long, continued by zeros up to ``width``."""
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size(x)))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def reach(x: np.ndarray) -> int:
    """Largest absolute entry, as a Python integer."""
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def add_up(width: int):
    """Rows of a task -> (axis, rows, exact sum) for every axis."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sums = 0, [0] * width
        for batch in batches:
            x = matrix(batch.column(0), width)
            rows += len(x)
            part = x.sum(axis=0) if reach(x) * len(x) < 2**62 else x.astype(object).sum(axis=0)
            sums = [a + int(b) for a, b in zip(sums, part)]
        if rows:
            yield pa.record_batch({"axis": pa.array(range(width), pa.int32()), "n": pa.array([rows] * width, pa.int64()),
                                   "total": pa.array([str(s) for s in sums], pa.string())})

    return run


def scaled_offsets(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: as long where that fits with room for squares and their sum, else as Python integers."""
    most = n * reach(x) + max(map(abs, sums), default=0)
    if most * most * max(1, x.shape[1]) < 2**62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def centred(offsets: np.ndarray, n: int) -> np.ndarray:
    """x - S/n, rounded once."""
    return (offsets / n).astype(np.float64)


def triangle(rows: np.ndarray) -> np.ndarray:
    """The square upper factor of a QR decomposition."""
    factor = np.linalg.qr(rows, mode="r")
    if factor.shape[0] < factor.shape[1]:
        factor = np.vstack([factor, np.zeros((factor.shape[1] - factor.shape[0], factor.shape[1]))])
    return factor


def reduce_rows(width: int, n: int, sums: list[int]):
    """Centred rows of a task -> its factor, block after block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        factor = None
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                block = centred(scaled_offsets(matrix(batch.column(0).slice(start, BLOCK), width), n, sums), n)
                factor = triangle(block if factor is None else np.vstack([factor, block]))
        if factor is not None:
            yield pa.record_batch({"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "factor": pa.array([factor.tobytes()], pa.binary())})

    return run


def join_factors(width: int):
    def run(group: pa.Table) -> pa.Table:
        factor = None
        order = np.argsort(group.column("part").to_numpy(), kind="stable")
        for i in order:
            other = np.frombuffer(group.column("factor")[int(i)].as_py()).reshape(width, width)
            factor = other if factor is None else triangle(np.vstack([factor, other]))
        return pa.table({"part": pa.array([group.column("part")[int(order[0])].as_py() // FAN_IN], pa.int32()), "factor": pa.array([factor.tobytes()], pa.binary())})

    return run


def projected(x: np.ndarray, n: int, sums: list[int], directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets n x - S, whitened components)."""
    offsets = scaled_offsets(x, n, sums)
    return offsets, centred(offsets, n) @ directions


def spread(width: int, n: int, sums: list[int], directions: np.ndarray):
    """Rows of a task -> (i, j, sum of whitened i times whitened j); j = -1: sum of whitened i."""
    count = directions.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, plain = np.zeros((count, count)), np.zeros(count)
        for batch in batches:
            _, w = projected(matrix(batch.column(0), width), n, sums, directions)
            products += w.T @ w
            plain += w.sum(axis=0)
        at = [(i, j) for i in range(count) for j in range(-1, count)]
        yield pa.record_batch({"i": pa.array([i for i, _ in at], pa.int32()), "j": pa.array([j for _, j in at], pa.int32()),
                               "total": pa.array([plain[i] if j < 0 else products[i, j] for i, j in at], pa.float64())})

    return run


def apply_to(width: int, n: int, sums: list[int], directions: np.ndarray, explained: list[float], error: float):
    """(key, x) -> one row per component."""
    count = directions.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, w = projected(matrix(batch.column(1), width), n, sums, directions)
            deviation = (offsets * offsets).sum(axis=1)
            if deviation.dtype == object:
                deviation = np.array([min(int(x), LONG_END) for x in deviation], np.int64)
            rows = batch.num_rows
            yield pa.record_batch([
                batch.column(0).take(pa.array(np.repeat(np.arange(rows), count))), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * count, n, np.int64)), pa.array(np.repeat(deviation, count).astype(np.int64)), pa.array(w.reshape(-1)),
                pa.array(np.tile(explained, rows)), pa.array(np.full(rows * count, error)),
            ], names=[batch.schema.names[0], "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = 4, scale: int = SCALE) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): one row per usable
    vector and component, components numbered by falling share of the variance.

    What reaches the driver: the width, one exact sum per axis, one factor of width x width,
    and components squared sums. ``identity_error`` is the largest absolute entry of the
    whitened fit list's covariance minus the identity, measured over all of it.
    """
    rows = vectors.filter(usable(F.col(column)))
    kind = vectors.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, {OUT}"
    width = rows.agg(F.max(F.size(column)).alias("w")).first()["w"] or 0
    nothing = rows.select(F.col(key)).limit(0).selectExpr(f"`{key}`", *(f"CAST(NULL AS {f.split()[1]}) AS {f.split()[0]}" for f in OUT.split(", ")))
    if width == 0:
        return nothing
    rows = rows.select(F.col(key), quantised(F.col(column), scale, width).alias("x"))
    fit = stored(rows.select("x").distinct(), "fit_list")
    axes = fit.mapInArrow(add_up(width), "axis int, n long, total string").groupBy("axis").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total")).orderBy("axis").collect()
    n, sums = int(axes[0]["n"]), [int(r["total"]) for r in axes]
    factors = fit.mapInArrow(reduce_rows(width, n, sums), "part int, factor binary")
    parts = fit.rdd.getNumPartitions()
    while parts > 1:
        factors = factors.groupBy(F.floor(F.col("part") / FAN_IN).alias("joined")).applyInArrow(join_factors(width), "part int, factor binary")
        parts = -(-parts // FAN_IN)
    factor = np.frombuffer(factors.first()["factor"]).reshape(width, width)
    values, directions = leading(factor, components, FLOOR)
    if not len(values):
        return nothing
    explained = (values / (factor * factor).sum()).tolist()
    directions = directions / np.sqrt(values / n)
    totals = {(r["i"], r["j"]): r["total"] for r in fit.mapInArrow(spread(width, n, sums, directions), "i int, j int, total double")
              .groupBy("i", "j").agg(F.sum("total").alias("total")).collect()}
    error = max(abs(totals[i, j] / n - totals[i, -1] / n * (totals[j, -1] / n) - (i == j)) for i, j in totals if j >= 0)
    return rows.mapInArrow(apply_to(width, n, sums, directions, explained, error), schema)
