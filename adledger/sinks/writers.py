"""Writers. All of them write in parallel, one file per task and partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.records import to_json_record
from ..operators.filters import conform
from ..operators.joins import skip_existing
from ..schemas import table_schema
from ..session import stored


def by_run(df: DataFrame, run: str) -> DataFrame:
    """Gather each run's rows into few files. Adaptive execution splits a run that is
    too big for one task and joins runs that are small."""
    return df.hint("rebalance", run)


def write_jsonl(df: DataFrame, path: str, sparse: bool = True, mode: str = "append",
                run: str = "run_id") -> None:
    """Compact JSON, one record per line, in ``run_id=<run>`` folders.

    The record keeps its own run id. ``sparse`` leaves NULL fields out, dense
    records write them.
    """
    lines = df.select(F.col(run).alias("run_id"), to_json_record(df.columns, not sparse).alias("value"))
    by_run(lines, "run_id").write.mode(mode).partitionBy("run_id").text(path)


def write_files(df: DataFrame, path: str, name: str, text: str) -> int:
    """One file per row, as crawlers land listings: the text, whole, at the relative path in column
    ``name``. Returns the number of files.

    Each task writes its own rows through pyarrow's file systems (local and mounted folders, HDFS,
    S3, GCS); a repeated task writes the same files again. A null text is an empty file; a name that
    is null, absolute or leads out of the folder fails the job.
    """
    root = path.rstrip("/")

    def write(batches):
        import posixpath

        from pyarrow import RecordBatch, array, fs

        place = root if "://" in root else root.replace("file:/", "file:///", 1) if root.startswith("file:/") else posixpath.abspath(root)
        store, base = fs.FileSystem.from_uri(place)
        made = set()
        for batch in batches:
            for file, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not file or file.startswith("/") or ".." in file.split("/"):
                    raise ValueError(f"not a file name below the folder: {file!r}")
                folder = posixpath.dirname(f"{base}/{file}")
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(f"{base}/{file}", compression=None) as out:
                    out.write((value or "").encode())
            yield RecordBatch.from_arrays([array([batch.num_rows])], names=["files"])

    written = df.select(F.col(name).cast("string"), F.col(text).cast("string")).mapInArrow(write, "files long")
    return written.agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]


def read_if_exists(spark: SparkSession, path: str, **options: str) -> DataFrame | None:
    """Parquet table, or None when nothing was written there yet."""
    try:
        return spark.read.options(**options).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def touched_partitions(existing: DataFrame, runs: DataFrame, part: str) -> DataFrame:
    """Rows of the partitions named in the small stored table ``runs``, which Spark sends to every
    executor and prunes the scan by. It does so only below a comparison, hence the one on the length."""
    wanted = runs.where(F.length(F.col(part).cast("string")) >= 0)
    return existing.join(wanted, part, "left_semi")


def write_if_absent(df: DataFrame, path: str, keys: Sequence[str] = ("run_id", "post_id"),
                    overwrite: bool = False, dry_run: bool = False) -> DataFrame:
    """Write rows whose key has no output yet; with ``overwrite`` replace those that have.

    The table is parquet partitioned by the first key. Skipping appends only the
    new rows; overwriting rewrites only the partitions the batch touches and
    keeps their other rows. Returns the rows written (nothing is written on a dry run).

    The batch is computed once, into the shared folder; its distinct runs, stored beside it,
    prune the table's partitions when the plan runs. Nothing is collected.
    """
    spark, part = df.sparkSession, keys[0]
    existing = read_if_exists(spark, path)
    if existing is not None:
        df = stored(df, "batch")
        existing = existing.withColumn(part, F.col(part).cast(df.schema[part].dataType))
        touched = touched_partitions(existing, stored(df.select(part).distinct(), "batch-runs"), part)
    new = df if existing is None or overwrite else skip_existing(df, touched, keys)
    if dry_run:
        return new
    if existing is not None and overwrite:
        merged = skip_existing(touched, df, keys).unionByName(df, allowMissingColumns=True)
        by_run(merged, part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)
    else:
        by_run(new, part).write.mode("append").partitionBy(part).parquet(path)
    return new


def write_table_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Exactly the given columns, with a header."""
    out = conform(df, table_schema(list(columns)))
    out.write.mode("overwrite").csv(path, header=True, escape='"')


def write_index(df: DataFrame, path: str) -> None:
    """Crawl index: all columns, sorted by name."""
    df.select(*sorted(df.columns)).write.mode("overwrite").csv(path, header=True, escape='"')


def write_run_outputs(path: str, run_hour: str, predictions: DataFrame, metrics: DataFrame,
                      importance: DataFrame | None = None, dry_run: bool = False) -> str:
    """Predictions, metrics and importance of one run under its UTC hour; the same
    hour overwrites itself."""
    folder = f"{path.rstrip('/')}/{run_hour}"
    if not dry_run:
        predictions.write.mode("overwrite").csv(f"{folder}/preds", header=True, escape='"')
        metrics.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{folder}/metrics")
        if importance is not None:
            # One array of records, largest first: as many as there are features.
            item = F.struct((-F.col("importance_mean")).alias("order"), "feature", "importance_mean")
            ordered = F.transform(F.sort_array(F.collect_list(item)),
                                  lambda x: F.struct(x["feature"].alias("feature"),
                                                     x["importance_mean"].alias("importance_mean")))
            importance.agg(F.to_json(ordered).alias("value")).write.mode("overwrite").text(
                f"{folder}/permutation_importance")
    return folder
