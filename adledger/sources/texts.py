"""Raw listing texts: one file is one record."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamReader

from ..functions.html import post_id_from_path

#: What Spark tells of a file.
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"

# Fixed value: a run folder below the landing root, in either id style.
RUN_ID = r"\d{8}T\d{6}Z|\d{14}"


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def run_folders(spark: SparkSession, path: str, run_id: str) -> list[str]:
    """The folders of one run below a landing root that exist."""
    folders = [f"{path.rstrip('/')}/{name}" for name in (f"run_id={run_id}", run_id)]
    return [f for f in folders if path_exists(spark, f)]


def landed_files(reader: DataFrameReader | DataStreamReader, path: str | list[str], glob: str = "*") -> DataFrame:
    """Files below a root: ``path`` and ``content``. Whoever selects paths only opens none, and
    all plans built on one such frame share its listing."""
    return reader.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", "true") \
        .option("pathGlobFilter", glob).load(path)


def list_files(spark: SparkSession, path: str | list[str], glob: str = "*") -> DataFrame:
    """Paths only: the content column is pruned, so no file is opened."""
    return landed_files(spark.read, path, glob).select("path")


def folder_run_id(path: Column, tagged_only: bool = False) -> Column:
    """Run id of the folder a file lies in, '' if there is none."""
    tag = "run_id=" if tagged_only else "(?:run_id=)?"
    return F.regexp_extract(path, rf"/{tag}({RUN_ID})/", 1)


def list_runs(spark: SparkSession, path: str, tagged_only: bool = False) -> DataFrame:
    """Run ids found below a root, ascending as text."""
    runs = list_files(spark, path).select(folder_run_id(F.col("path"), tagged_only).alias("run_id"))
    return runs.where("run_id <> ''").distinct().orderBy("run_id")


def layout_rank(path: Column) -> Column:
    """Order in which the four folder layouts of a run are tried."""
    return (
        F.when(path.rlike(rf"/run_id=({RUN_ID})/txt/"), 1)
        .when(path.rlike(rf"/run_id=({RUN_ID})/"), 2)
        .when(path.rlike(rf"/({RUN_ID})/txt/"), 3)
        .otherwise(4)
    )


def source_key(path: Column, root: str) -> Column:
    """Path from the landing root's own folder on (``scrapes/<run>/<post>.txt``), as
    records name their source. The same wherever the root is mounted."""
    name = re.escape(root.rstrip("/").rsplit("/", 1)[-1])
    return F.regexp_replace(path, rf"^.*/(?={name}/(?:run_id=)?(?:{RUN_ID})/)", "")


def best_layout(rows: DataFrame, rank: str) -> DataFrame:
    """Rows of each run's first layout that holds any."""
    return rows.join(rows.groupBy("run_id").agg(F.min(rank).alias(rank)), ["run_id", rank], "left_semi")


def read_run_texts(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """(run_id, post_id, path, text) of every listing text, the path as `source_key`.

    A run may have landed in several layouts; only its first non-empty one counts.
    Which one that is, is decided from the file listing alone, which is made once. Of one run
    only its own folders are listed; one that is not there has no text. Zones that are read
    again and again are better packed once, see `sources.packed`.
    """
    root = path
    if run_id:
        path = run_folders(spark, path, run_id)
        if not path:
            return spark.createDataFrame([], "run_id string, post_id string, path string, text string")
    found = landed_files(spark.read, path, "*.txt").where("length > 0").withColumns({
        "run_id": folder_run_id(F.col("path")), "_rank": layout_rank(F.col("path")), "text": F.col("content").cast("string")})
    found = found.where(F.col("run_id") == run_id if run_id else F.col("run_id") != "")
    return best_layout(found, "_rank").select(
        "run_id", post_id_from_path("path").alias("post_id"), source_key(F.col("path"), root).alias("path"), "text")
