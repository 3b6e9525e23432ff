"""Run artifacts: metrics and importance of one run per file.

Two layouts are read: files named ``<YYYYMMDDHH>-<kind>.json`` in one folder, and
folders per run hour and kind as this package writes them. A folder is read with
a name filter, not with a glob path: a glob would start one listing task per file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.times import parse_run_hour
from ..schemas import IMPORTANCE_SCHEMA, RUN_METRICS_SCHEMA
from .texts import list_files

# Where the run hour and the kind stand in a path.
RUN_HOUR = r"/(?:run_hour=)?(\d{10})[-/]"
KIND = r"/(?:run_hour=)?\d{10}[-/](?:kind=)?([A-Za-z0-9_]+)"
METRICS, IMPORTANCE = "metrics", "permutation_importance"
ARTIFACTS = "*.{json,txt}"


def artifact_run(path: Column) -> Column:
    return F.regexp_extract(path, RUN_HOUR, 1)


def artifact_kind(path: Column) -> Column:
    return F.regexp_extract(path, KIND, 1)


def with_run(df: DataFrame, kind: str) -> DataFrame:
    """Rows of one kind of artifact, with run id and time from the path."""
    path = F.col("_metadata.file_path")
    tagged = df.select("*", artifact_run(path).alias("run_id"), artifact_kind(path).alias("_kind"))
    return tagged.where(F.col("_kind") == kind).drop("_kind").withColumn("run_dt", parse_run_hour("run_id"))


def read_run_metrics(spark: SparkSession, path: str) -> DataFrame:
    """One row per run."""
    files = spark.read.schema(RUN_METRICS_SCHEMA).option("recursiveFileLookup", "true")
    # A file is one (possibly indented) document, or one document per line.
    return with_run(files.json(path, multiLine=True, pathGlobFilter=ARTIFACTS), METRICS)


def read_importance(spark: SparkSession, path: str) -> DataFrame:
    """One row per run and feature, with its 0-based place in the run's file.

    A file holds one JSON array of records, as many as there are features.
    """
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=ARTIFACTS)
    arrays = with_run(files, IMPORTANCE)
    records = F.from_json("value", T.ArrayType(IMPORTANCE_SCHEMA))
    return arrays.select("run_id", "run_dt", F.posexplode(records).alias("position", "_rec")).select(
        F.col("_rec.feature").alias("feature"), F.col("_rec.importance_mean").alias("importance"),
        "position", "run_id", "run_dt")


def artifact_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Files, first and last run per kind of artifact. No file is opened."""
    file = F.col("path")
    files = list_files(spark, path).select(artifact_run(file).alias("run_id"), artifact_kind(file).alias("kind"))
    return files.where("run_id <> ''").groupBy("kind").agg(
        F.count(F.lit(1)).alias("files"), F.min("run_id").alias("first_run"),
        F.max("run_id").alias("last_run")).orderBy("kind")
