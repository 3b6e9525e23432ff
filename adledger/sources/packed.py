"""Small landed files packed into a table, each file opened once in its life.

A landing zone holds one record per file, millions of them a day: opening each one for every
job costs more than its bytes. `pack_files` takes every file once, as a stream over the list of
files found so far, and writes texts and where they lay as Parquet by batch and run.
Readers then list a few folders, prune runs, and read row groups by byte range.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.html import post_id_from_path
from ..schemas import RECORD_COLUMNS, table_schema
from ..session import stored
from ..sinks import by_run
from .records import typed_records
from .texts import best_layout, folder_run_id, layout_rank, path_exists, source_key

#: Executors get these functions with the task: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LISTED_SCHEMA = "file string, length long"
#: Files and bytes a task reads, and bytes of a batch it hands to Spark.
TASK_FILES, TASK_BYTES, BATCH_BYTES = 10_000, 128 << 20, 8 << 20
PACKED_SCHEMA = "batch_id long, run_id string, file string, path string, layout int, text string"


def located(path: str, stores: dict) -> tuple:
    """The file system of a path as Hadoop writes it, and its place there; ``stores`` keeps those met."""
    from pyarrow import fs

    if path.startswith("file:"):
        return stores.setdefault("file", fs.LocalFileSystem()), "/" + path[5:].lstrip("/")
    head = "/".join(path.split("/", 3)[:3])
    if head not in stores:
        stores[head] = fs.FileSystem.from_uri(f"{head}/")
    store, base = stores[head]
    return store, base.rstrip("/") + path[len(head):]


def list_folder(batches: Iterator) -> Iterator:
    """What lies in each folder: (path, length, folder), the length of a folder being null. Names
    that Spark's readers pass over are left out."""
    from pyarrow import RecordBatch, array, fs

    stores: dict = {}

    def passed_over(name: str) -> bool:
        return (name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_")

    for batch in batches:
        for folder in batch.column(0).to_pylist():
            store, place = located(folder, stores)
            inside = [x for x in store.get_file_info(fs.FileSelector(place)) if not passed_over(x.base_name)]
            for i in range(0, len(inside), 10_000):
                part = inside[i:i + 10_000]
                yield RecordBatch.from_arrays([array([f"{folder}/{x.base_name}" for x in part], "string"), array([x.size for x in part], "int64"),
                                               array([x.type == fs.FileType.Directory for x in part], "bool")], names=["path", "length", "folder"])


def read_whole(batches: Iterator) -> Iterator:
    """(file, content) of each file, in batches of some megabytes."""
    from pyarrow import RecordBatch, array

    stores: dict = {}
    files, contents, held = [], [], 0

    def filled():
        return RecordBatch.from_arrays([array(files, "string"), array(contents, "binary")], names=["file", "content"])

    for batch in batches:
        for file in batch.column(0).to_pylist():
            store, place = located(file, stores)
            with store.open_input_file(place) as opened:
                content = opened.read()
            if files and held + len(content) > BATCH_BYTES:
                yield filled()
                files, contents, held = [], [], 0
            files.append(file)
            contents.append(content)
            held += len(content)
    if files:
        yield filled()


def files_below(spark: SparkSession, landing: str, glob: str) -> DataFrame:
    """(file, length) of the files below ``landing``, listed by tasks, one folder at a time and level
    by level: their names never meet on the driver."""
    place = spark._jvm.org.apache.hadoop.fs.Path(landing)
    roots = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    if not roots:
        raise FileNotFoundError(landing)
    folders = spark.createDataFrame([(r.getPath().toString(),) for r in roots], "path string")
    files = None
    while not folders.isEmpty():
        tasks = folders.repartition(4 * spark.sparkContext.defaultParallelism, "path")
        level = stored(tasks.mapInArrow(list_folder, "path string, length long, folder boolean"), "listing")
        found = level.where(~F.col("folder")).select(F.col("path").alias("file"), "length")
        files = found if files is None else files.unionByName(found)
        folders = level.where("folder").select("path")
    named = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
    return files.where(F.regexp_extract("file", "[^/]*$", 0).rlike(rf"(?s)\A(?:{named})\z"))


def _batches_before(spark: SparkSession, offsets: str) -> int:
    """Number of batches that a stream began, by its folder of offsets."""
    if not path_exists(spark, offsets):
        return 0
    place = spark._jvm.org.apache.hadoop.fs.Path(offsets)
    names = [f.getPath().getName() for f in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)]
    return 1 + max((int(n) for n in names if n.isdigit()), default=-1)


def pack_files(spark: SparkSession, landing: str, out: str, checkpoint: str, glob: str = "*.txt",
               batch_bytes: int = 64 << 30) -> StreamingQuery:
    """Pack the files below ``landing`` that were not packed before; ends when all are.

    Files outside run folders are passed over. A landed file is taken to be final: one that is
    rewritten under its old name is not read again. Each batch, of about ``batch_bytes``, has
    a folder of its own, which a repeated batch writes anew.

    Tasks list the zone; what they find new is added to the list in the checkpoint folder, in one
    Parquet file per batch. The stream reads that list, so the driver knows of a few lists and
    never of single files, however many there are. Files are listed and opened through pyarrow's
    file systems (local and mounted folders, HDFS, S3, GCS). Where a stream over the zone itself
    left its checkpoint, batches are numbered on, and what it packed is not packed again.
    """
    checkpoint = checkpoint.rstrip("/")
    listed, reader, first = f"{checkpoint}/listed", spark.read.schema(LISTED_SCHEMA), _batches_before(spark, f"{checkpoint}/offsets")
    found = files_below(spark, landing, glob).where(folder_run_id(F.col("file")) != "")
    if path_exists(spark, listed):
        found = found.join(reader.parquet(listed), "file", "left_anti")
    if first:
        found = found.join(packed_files(spark, out), "file", "left_anti")
    new = stored(found, "new-files")
    files, size = new.agg(F.count(F.lit(1)), F.sum("length")).first()
    place = spark._jvm.org.apache.hadoop.fs.Path(listed)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
    if files:
        new.repartition(max(1, min(files, -(-size // batch_bytes)))).write.mode("append").parquet(listed)

    def append(batch: DataFrame, batch_id: int) -> None:
        some = batch.where("length > 0")
        files, size = some.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
        if not files:
            return
        tasks = min(files, max(2 * spark.sparkContext.defaultParallelism, files // TASK_FILES, size // TASK_BYTES))
        texts = some.select("file").repartition(tasks).mapInArrow(read_whole, "file string, content binary")
        named = texts.select("file", F.col("content").cast("string").alias("text")).withColumns({
            "run_id": folder_run_id(F.col("file")), "layout": layout_rank(F.col("file")), "path": source_key(F.col("file"), landing)})
        by_run(named, "run_id").write.mode("overwrite").partitionBy("run_id").parquet(f"{out.rstrip('/')}/batch_id={first + batch_id}")

    return spark.readStream.schema(LISTED_SCHEMA).option("maxFilesPerTrigger", 1).parquet(listed).writeStream.foreachBatch(append) \
        .option("checkpointLocation", f"{checkpoint}/lists").trigger(availableNow=True).start()


def packed_files(spark: SparkSession, out: str, run_id: str | None = None) -> DataFrame:
    """Everything packed so far, of one run if given; empty before the first batch."""
    if not path_exists(spark, out):
        return spark.createDataFrame([], PACKED_SCHEMA)
    rows = spark.read.schema(PACKED_SCHEMA).parquet(out)
    return rows.where(F.col("run_id") == run_id) if run_id else rows


def read_packed_texts(spark: SparkSession, out: str, run_id: str | None = None) -> DataFrame:
    """What `read_run_texts` gives for the landing zone: of each run its first non-empty layout.
    Which one that is, is read from the layout column alone."""
    return best_layout(packed_files(spark, out, run_id), "layout").select(
        "run_id", post_id_from_path("path").alias("post_id"), "path", "text")


def read_packed_jsonl(spark: SparkSession, out: str, subdir: str | None = "jsonl",
                      fields: Sequence[str] = tuple(RECORD_COLUMNS), run_id: str | None = None) -> DataFrame:
    """What `read_jsonl` gives for a landing zone of one record per file."""
    return typed_records(packed_files(spark, out, run_id).select(F.col("text").alias("value"), "file"), subdir, fields)
