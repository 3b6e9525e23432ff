"""CSV tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.filters import require_columns
from ..schemas import field_type


def read_table_csv(spark: SparkSession, path: str, required: Sequence[str] = (),
                   multi_line: bool = True) -> DataFrame:
    """Listing table with the columns its header names, typed by name.

    Nothing is inferred (a zip code keeps its leading zero), and a missing path or
    a missing required column raises. Set ``multi_line=False`` for files without
    line breaks inside cells: they can then be split over tasks.
    """
    raw = spark.read.csv(path, header=True, multiLine=multi_line, escape='"')
    require_columns(raw, required)
    return raw.select(*[F.col(f"`{c}`").try_cast(field_type(c)).alias(c) for c in raw.columns])
