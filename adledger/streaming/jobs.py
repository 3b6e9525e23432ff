"""File-source streams. A checkpoint folder replaces the test "is the output there?".

Every sink is idempotent per batch id, so a batch that is repeated after a failure
writes the same files again instead of adding rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.html import post_id_from_path
from ..functions.listing import DEFAULT_IMAGE_HOST
from ..functions.times import iso_z, parse_run_id
from ..operators.dedup import latest_by_key
from ..operators.extraction import parse_listing
from ..schemas import RUN_METRICS_SCHEMA
from ..sinks import read_if_exists
from ..sources.artifacts import ARTIFACTS, METRICS, with_run
from ..sources.texts import folder_run_id, landed_files, source_key


def _start(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return stream.writeStream.format("parquet").option("path", path) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def extract_stream(texts: DataFrame, host: str = DEFAULT_IMAGE_HOST) -> DataFrame:
    """Streaming (run_id, post_id, path, text) to regex records. Narrow, no state."""
    named = texts.withColumns({
        "scraped_at": iso_z(parse_run_id("run_id")), "source_txt": F.col("path")}).drop("path")
    return parse_listing(named, "text", host)


def stream_extract(spark: SparkSession, landing: str, out: str, checkpoint: str,
                   host: str = DEFAULT_IMAGE_HOST) -> StreamingQuery:
    """Parse each new listing text once."""
    files = landed_files(spark.readStream, landing, "*.txt")
    texts = files.select("path", F.col("content").cast("string").alias("text")).withColumns({
        "run_id": folder_run_id(F.col("path")), "post_id": post_id_from_path("path"),
        "path": source_key(F.col("path"), landing)})
    return _start(extract_stream(texts.where("run_id <> ''"), host), out, checkpoint)


def _part(path: str, name: str) -> str:
    return f"{path.rstrip('/')}/{name}"


def _layout(spark: SparkSession, path: str) -> int | None:
    """Number of buckets the table was started with, None before its first batch."""
    layout = read_if_exists(spark, _part(path, "layout"))
    return None if layout is None else layout.first()["buckets"]


def stream_latest(
    records: DataFrame, path: str, checkpoint: str, key: str = "post_id", run: str = "run_id",
    tie: str = "source_txt", buckets: int = 64,
) -> StreamingQuery:
    """Keep the newest record per key of a stream, at the cost of each batch only.

    A batch is reduced to one row per key and written to its own folder, each row with the
    bucket its key hashes to; nothing older is touched. `compact_latest` folds the folders into
    a base that holds one folder per bucket, `current_latest` reads the table. A late, older run
    never replaces a newer record. ``buckets`` counts for a new table, which keeps its number:
    choose it so that one bucket of the base is a comfortable job, a thousand and more for
    terabytes.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        n = _layout(spark, path)
        if n is None:
            n = buckets
            spark.range(1).select(F.lit(n).alias("buckets")).write.mode("overwrite").parquet(_part(path, "layout"))
        newest = latest_by_key(batch, key, run, path=tie)
        newest.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(n)).cast("int")).write.mode("overwrite").parquet(
            f"{_part(path, 'deltas')}/batch_id={batch_id}")

    return records.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()


def _current_folders(spark: SparkSession, path: str, upto: int | None = None) -> tuple[int, dict[int, int]]:
    """The batch that the newest manifest (of version ``upto``, if given) reaches to, and the
    version that holds each bucket: at most as many entries as the table has buckets."""
    manifest = read_if_exists(spark, _part(path, "manifest"))
    if manifest is None:
        return -1, {}
    if upto is not None:
        manifest = manifest.where(F.col("reached") == upto)
    newest = manifest.where(F.col("reached") == manifest.agg(F.max("reached")).scalar()).collect()
    return newest[0]["reached"], {r["bucket"]: r["version"] for r in newest if r["bucket"] is not None}


def _bucket_rows(spark: SparkSession, path: str, folders: dict[int, int]) -> DataFrame | None:
    """The base rows of the given buckets; no other folder is listed or read."""
    base = _part(path, "base")
    if not folders:
        return None
    return spark.read.option("basePath", base).option("mergeSchema", "true").parquet(
        *[f"{base}/version={v}/bucket={b}" for b, v in sorted(folders.items())]).drop("version")


def _newer(spark: SparkSession, path: str, reached: int) -> tuple[DataFrame | None, list[int], int]:
    """Batches the base does not hold yet, the buckets they touch and the last of them."""
    deltas = read_if_exists(spark, _part(path, "deltas"), mergeSchema="true")
    if deltas is None:
        return None, [], reached
    newer = deltas.where(F.col("batch_id") > reached)
    seen = newer.groupBy("bucket").agg(F.max("batch_id").alias("last")).collect()  # at most one row per bucket
    return newer, [r["bucket"] for r in seen], max((r["last"] for r in seen), default=reached)


def _merged(spark: SparkSession, path: str, folders: dict[int, int], newer: DataFrame | None, touched: list[int],
            key: str, run: str, tie: str) -> DataFrame | None:
    """Newest rows of the touched buckets: their base folders and the newer batches, ranked."""
    if not touched:
        return None
    old = _bucket_rows(spark, path, {b: v for b, v in folders.items() if b in set(touched)})
    rows = newer.drop("batch_id")
    rows = rows if old is None else old.unionByName(rows, allowMissingColumns=True)
    return latest_by_key(rows, key, run, path=tie)


def current_latest(spark: SparkSession, path: str, key: str = "post_id", run: str = "run_id",
                   tie: str = "source_txt") -> DataFrame:
    """The table `stream_latest` keeps: one row per key. Before the first batch it is empty,
    with the key columns only.

    Merge on read: only buckets that newer batches touch are shuffled and ranked; all others
    are read as they lie.
    """
    reached, folders = _current_folders(spark, path)
    newer, touched, _ = _newer(spark, path, reached)
    settled = _bucket_rows(spark, path, {b: v for b, v in folders.items() if b not in set(touched)})
    merged = _merged(spark, path, folders, newer, touched, key, run, tie)
    parts = [p for p in (settled, merged) if p is not None]
    if not parts:
        if newer is not None:  # batches without a row
            return newer.drop("batch_id", "bucket")
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in dict.fromkeys((key, run, tie))))
    whole = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    return whole.drop("bucket")


def compact_latest(spark: SparkSession, path: str, key: str = "post_id", run: str = "run_id",
                   tie: str = "source_txt") -> None:
    """Fold all batches seen so far into the base, rewriting only the buckets they touch.

    Touched buckets go to a new version's folders. A manifest, written when they are complete,
    then names the folder of each bucket; until it is there readers see the table as before,
    and a failed run is repeated from the same files. Older folders stay until `expire_latest`.
    """
    reached, folders = _current_folders(spark, path)
    newer, touched, last = _newer(spark, path, reached)
    merged = _merged(spark, path, folders, newer, touched, key, run, tie)
    if merged is None:
        return
    merged.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{_part(path, 'base')}/version={last}")
    entries = [(b, v) for b, v in {**folders, **dict.fromkeys(touched, last)}.items()]
    spark.createDataFrame(entries, "bucket int, version long").coalesce(1).write.mode("overwrite").parquet(
        f"{_part(path, 'manifest')}/reached={last}")


def _delete(spark: SparkSession, folder: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def expire_latest(spark: SparkSession, path: str, keep_versions: int = 2) -> None:
    """Remove manifests older than the newest ``keep_versions``, bucket folders that none of the
    kept ones names, and the batches that the oldest kept one already holds. Readers of older
    versions must have ended."""
    manifest = read_if_exists(spark, _part(path, "manifest"))
    if manifest is None:
        return
    versions = sorted(r["reached"] for r in manifest.select("reached").distinct().collect())
    kept = versions[-keep_versions:]
    named = {(v, b) for k in kept for b, v in _current_folders(spark, path, k)[1].items()}
    older = {(v, b) for k in versions if k not in kept for b, v in _current_folders(spark, path, k)[1].items()}
    for k in versions:
        if k not in kept:
            _delete(spark, f"{_part(path, 'manifest')}/reached={k}")
    for v, b in sorted(older - named):
        _delete(spark, f"{_part(path, 'base')}/version={v}/bucket={b}")
    for v in {v for v, _ in older} - {v for v, _ in named}:
        _delete(spark, f"{_part(path, 'base')}/version={v}")
    deltas = read_if_exists(spark, _part(path, "deltas"))
    held = [] if deltas is None else deltas.select("batch_id").distinct().where(F.col("batch_id") <= kept[0]).collect()
    for row in held:
        _delete(spark, f"{_part(path, 'deltas')}/batch_id={row['batch_id']}")


def stream_metrics(spark: SparkSession, artifacts: str, out: str, checkpoint: str) -> StreamingQuery:
    """Append each new metrics file, with its run id and time, to a table of runs."""
    files = spark.readStream.schema(RUN_METRICS_SCHEMA).option("multiLine", "true") \
        .option("recursiveFileLookup", "true").option("pathGlobFilter", ARTIFACTS).json(artifacts)
    return _start(with_run(files, METRICS), out, checkpoint)


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an available-now stream; a failure in it is raised here."""
    query.awaitTermination()
