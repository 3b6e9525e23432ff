"""Categories as numbers, kept as a table: no list of them ever reaches the driver.

The distinct (column, category) pairs are range-partitioned in alphabetical order; a category's
ordinal is its place within its partition plus the number of the column's categories in the
partitions before. Applying is one left join per column: Spark broadcasts a column's table
while it is small and shuffles beyond. Vectors are put together from ordinals: short ones
dense, by array functions alone; long ones sparse, so their cost does not depend on how many
categories there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..session import stored

SCHEMA = "column string, value string, ordinal long"
#: Vectors of up to so many entries are written out in full: a copy of 2 KB is cheaper than sparse JSON.
SHORT = 256


@dataclass
class Dictionary:
    """``table`` (column, value, ordinal from 0) and the number of categories of each column."""

    table: DataFrame
    sizes: dict[str, int]

    def of(self, column: str) -> DataFrame:
        return self.table.where(F.col("column") == column).select("value", "ordinal")

    def values(self, column: str, ordinals: Sequence[int]) -> list[str]:
        """The categories with these ordinals, in their order."""
        chosen = self.of(column).where(F.col("ordinal").isin(list(ordinals)))
        return [r["value"] for r in chosen.orderBy("ordinal").collect()] if ordinals else []

    def number(self, df: DataFrame, columns: Sequence[str], suffix: str = "_idx") -> DataFrame:
        """One column of ordinals per column, NULL for a category that is not in the dictionary."""
        for i, c in enumerate(columns):
            known = self.of(c).select(F.col("value").alias(f"__value_{i}"), F.col("ordinal").alias(f"{c}{suffix}"))
            df = df.join(known, F.col(c).cast("string") == F.col(f"__value_{i}"), "left").drop(f"__value_{i}")
        return df

    def save(self, path: str) -> None:
        self.table.write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, sizes: dict[str, int]) -> "Dictionary":
        return cls(spark.read.schema(SCHEMA).parquet(path), sizes)


def fit_dictionary(df: DataFrame, columns: Sequence[str]) -> Dictionary:
    """Every non-null category of the columns, numbered alphabetically (by code point) per column."""
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ]))).where(F.col("value").isNotNull()).distinct()
    ordered = pairs.repartitionByRange("column", "value").sortWithinPartitions("column", "value")
    # stored: places must be the same whoever reads them, also after an executor is lost
    placed = stored(ordered.select("column", "value", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")), "categories")
    runs = placed.groupBy("column", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    # one row per column and partition from here on
    before = F.sum("n").over(Window.partitionBy("column").orderBy("part")) - F.col("n")
    runs = runs.select("column", "part", (before - F.col("first")).alias("shift"), "n")
    numbered = placed.join(runs, ["column", "part"]).select("column", "value", (F.col("place") + F.col("shift")).alias("ordinal"))
    table = stored(numbered, "dictionary")
    found = {r["column"]: r["n"] for r in table.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    return Dictionary(table, {c: found.get(c, 0) for c in columns})


def sparse_vector(size: int, indices: Column, values: Column) -> Column:
    """Vector of ``size`` entries from ascending indices and their values. Spark builds no vector
    from arrays but a dense one; its JSON reader builds any."""
    fields = F.to_json(F.struct(F.lit(0).alias("type"), F.lit(size).alias("size"), indices.cast("array<int>").alias("indices"), values.cast("array<double>").alias("values")))
    vector = F.from_json(F.concat(F.lit('{"v":'), fields, F.lit("}")), T.StructType([T.StructField("v", VectorUDT())]))["v"]
    return vector


def unit_array(size: int, at: Column) -> Column:
    """0.0 and 1.0 as array: 1.0 at ``at``, all zeros if that is NULL. The rows it picks from are one
    constant of ``size`` squared entries, for sizes up to `SHORT`."""
    zeros = F.array_repeat(F.lit(0.0), size)
    if not size:
        return zeros
    places = F.sequence(F.lit(0), F.lit(size - 1))
    rows = F.transform(places, lambda i: F.transform(places, lambda j: (i == j).cast("double")))
    return F.coalesce(F.get(rows, at.cast("int")), zeros)


def with_size(vector: Column, name: str, size: int) -> Column:
    """The vector under a name, its size told to pyspark.ml without a look at the rows."""
    return vector.alias(name, metadata={"ml_attr": {"num_attrs": size}})
