"""Streams, run until the available input is used up and compared with their batch twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import trends
from ...session import prepare, scratch_path
from ...streaming.jobs import compact_latest, current_latest, run_to_end, stream_extract, stream_latest, stream_metrics
from .aggregates import TREND_SQL, rounded
from .common import L, landed, listings
from .landing import T_CTE, artifact_landing, supplier_landing
from .relations import LATEST_SQL


def _stream_extract(spark, folder):
    out, checkpoint = scratch_path(spark, "extract"), scratch_path(spark, "extract-state")
    run_to_end(stream_extract(prepare(spark), supplier_landing(spark, folder), out, checkpoint))
    return spark.read.parquet(out).select(
        "run_id", "post_id", "scraped_at", "price", "year", "make", "mileage", "transmission")


def _stream_latest(spark, folder):
    """Listings arrive in several files, one file per batch; older runs come late."""
    source = landed(spark, folder, "stream-source", lambda path: listings(spark, folder).drop("text").repartition(
        4, "listing_id").write.parquet(path))
    out, checkpoint = scratch_path(spark, "latest"), scratch_path(spark, "latest-state")
    schema = spark.read.parquet(source).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(source)
    run_to_end(stream_latest(stream, out, checkpoint, tie="path"))
    compact_latest(spark, out, tie="path")
    return current_latest(spark, out, tie="path").select("listing_id", "post_id", "run_id", "path")


def _stream_latest_merged(spark, folder):
    """Most listings are settled in the base when late ones, older and newer runs, arrive: only
    their buckets are merged on read."""
    rows = listings(spark, folder).drop("text")
    late = (F.col("post_id").cast("long") % 50 == 7) & (F.col("listing_id") % 2 == 0)
    source, out, checkpoint = (scratch_path(spark, n) for n in ("merge-source", "merged", "merged-state"))

    def arrive(part):
        part.write.mode("append").parquet(source)
        run_to_end(stream_latest(spark.readStream.schema(rows.schema).parquet(source), out, checkpoint, tie="path"))

    arrive(rows.where(~late))
    compact_latest(spark, out, tie="path")
    arrive(rows.where(late))
    return current_latest(spark, out, tie="path").select("listing_id", "post_id", "run_id", "path")


def _stream_metrics(spark, folder):
    out, checkpoint = scratch_path(spark, "metrics"), scratch_path(spark, "metrics-state")
    run_to_end(stream_metrics(prepare(spark), artifact_landing(spark, folder), out, checkpoint))
    return rounded(trends.trend_halves(spark.read.parquet(out), "run_dt"), "early_mean", "recent_mean")


QUERIES = {"stream_extract": _stream_extract, "stream_latest": _stream_latest, "stream_latest_merged": _stream_latest_merged,
           "stream_metrics": _stream_metrics}

ORACLES = {
    "stream_extract": f"""WITH {T_CTE} SELECT run_id, post_id,
  '2024-01-0' || substr(run_id, 8, 1) || 'T08:00:00Z' AS scraped_at, CAST(1000 + CAST(post_id AS BIGINT) AS BIGINT) AS price,
  CAST(regexp_extract(text, 'year (\\d+)', 1) AS BIGINT) AS year, 'Honda' AS make, CAST(45000 AS BIGINT) AS mileage, 'automatic' AS transmission FROM t""",
    "stream_latest": f"WITH {L}, {LATEST_SQL.format(src='l', path='path')} SELECT listing_id, post_id, run_id, path FROM latest",
    "stream_latest_merged": f"WITH {L}, {LATEST_SQL.format(src='l', path='path')} SELECT listing_id, post_id, run_id, path FROM latest",
    "stream_metrics": TREND_SQL,
}
