"""Small helpers the operators share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored  # noqa: F401  operators cut their lineage with it


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_hash(column: str) -> Column:
    """crc32 of the id as text: deals documents into folds."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def group_name(number: int, *contents: bytes) -> int:
    """Name of the ``number``-th group of rows of this task. Groups of equal contents differ by
    their place: the input partition, and the number within it."""
    import xxhash
    from pyspark import TaskContext

    place = TaskContext.get().partitionId().to_bytes(8, "little") + number.to_bytes(8, "little")
    return xxhash.xxh64_intdigest(place + b"".join(contents)) >> 1


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text of a batch, one at a time; a null text has none."""
    raw = column.cast(pa.binary()) if pa.types.is_string(column.type) else column.cast(pa.large_binary())
    for value in raw:
        yield value.as_py() or b""


def once_per_worker(key: str, make: Callable[[], Any]) -> Any:
    """What ``make`` returns, made once by each Python worker and kept for its later tasks; another
    key replaces it. Functions travel to the tasks by value, each with globals of its own, so
    it is kept beside the worker's loaded modules."""
    held = sys.modules.setdefault("adledger_worker_state", types.ModuleType("adledger_worker_state"))
    if getattr(held, "key", None) != key:
        held.key = held.value = None
        held.value = make()
        held.key = key
    return held.value
