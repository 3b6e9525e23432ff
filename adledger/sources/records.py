"""JSON records below run folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import strip
from ..operators.filters import conform
from ..schemas import RECORD_COLUMNS, table_schema, text_schema
from .texts import folder_run_id, run_folders


def is_single_document(value: Column) -> Column:
    """One JSON object and nothing after it. Quoted text is blanked out first, so
    braces inside strings do not count."""
    bare = F.regexp_replace(value, r'"(?:[^"\\]|\\.)*+"', '""')
    return value.startswith("{") & value.endswith("}") & ~bare.rlike(r"\}\s*[^\s,\]}]")


def parse_records(df: DataFrame, value: str, fields: Sequence[str]) -> DataFrame:
    """Keep rows holding one well-formed JSON object; add its fields as text in ``_rec``."""
    body = strip(F.col(value))
    schema = text_schema([*fields, "_corrupt"])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = df.withColumn("_body", body).where(is_single_document(F.col("_body"))) \
        .withColumn("_rec", F.from_json("_body", schema, options))
    return parsed.where(F.col("_rec").isNotNull() & F.col("_rec._corrupt").isNull()).drop("_body")


def read_jsonl(
    spark: SparkSession, path: str, subdir: str | None = "jsonl", suffix: str = ".jsonl",
    fields: Sequence[str] = tuple(RECORD_COLUMNS), one_per_file: bool = True, run_id: str | None = None,
) -> DataFrame:
    """Typed records below ``run_id=<run>/<subdir>/``; blank and malformed ones are skipped.

    The folder's run id is a default only: a record's own value wins. Landing zones
    hold one record per file; what `write_jsonl` wrote holds one per line
    (``one_per_file=False``) and is splittable. A value that does not fit its
    type becomes NULL, its record stays. With ``run_id`` only that run's folder is listed.
    """
    if run_id:
        path = [f for f in run_folders(spark, path, run_id) if "run_id=" in f]
        if not path:
            return spark.createDataFrame([], table_schema(["folder_run", "file", *fields]))
    files = spark.read.text(path, wholetext=one_per_file, recursiveFileLookup=True,
                            pathGlobFilter=f"*{suffix}")
    return typed_records(files.select("value", F.col("_metadata.file_path").alias("file")), subdir, fields)


def typed_records(raw: DataFrame, subdir: str | None, fields: Sequence[str]) -> DataFrame:
    """Records of (value, file) in tagged run folders, typed; see `read_jsonl`."""
    inside = raw.withColumn("folder_run", folder_run_id(F.col("file"), True)).where("folder_run <> ''")
    if subdir:
        inside = inside.where(F.col("file").contains(f"/{subdir}/"))
    records = parse_records(inside, "value", fields)
    flat = records.select("folder_run", "file", *[F.col("_rec")[f].alias(f) for f in fields])
    typed = conform(flat, table_schema(["folder_run", "file", *fields]))
    return typed.withColumn("run_id", F.coalesce("run_id", "folder_run")) if "run_id" in fields else typed
