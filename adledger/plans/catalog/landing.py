"""Readers and writers: rows derived from the tables are written to the shared scratch
folder and read back through the source under test."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.times import iso_z, parse_run_id
from ...operators import extraction
from ...schemas import LISTING_COLUMNS, MASTER_COLUMNS
from ...session import scratch_path
from ...sinks import write_files, write_if_absent, write_index, write_jsonl, write_run_outputs, write_table_csv
from ...sources import (
    artifact_inventory, list_runs, pack_files, read_importance, read_jsonl, read_packed_jsonl, read_packed_texts,
    read_pages, read_run_metrics, read_run_texts, read_table_csv,
)
from ..jobs import crawl_index, land_listings, materialize, materialize_listings, materialize_v2
from .aggregates import predicted_events, with_params
from .common import IMPORTANCE_CTE, L, NL, RUNS_CTE, derive, importance, landed, listings, runs, table
from .fields import PARSED_CTE
from .relations import LATEST_SQL
from .texts import BASE, LINKS_SQL, VISIBLE_SQL, clean_sql, search_pages

# ---- whole-file texts: one file per supplier --------------------------------

SUPPLIER_TEXTS = f"""
SELECT '2024010' || CAST(1 + s_suppkey % 5 AS STRING) || CASE WHEN s_suppkey % 5 = 0 THEN 'T080000Z' ELSE '080000' END AS run_id,
  CAST(s_suppkey AS STRING) AS post_id,
  'for sale Honda Civic' || {NL} || 'supplier ' || s_name || {NL} || 'price: $' || CAST(1000 + s_suppkey AS STRING) || {NL}
  || 'year ' || CAST(1990 + s_nationkey AS STRING) || ', 45k miles, CVT' AS text FROM {{supplier}}"""
T_CTE = f"t AS ({SUPPLIER_TEXTS.format(supplier='supplier')})"


#: Folders of a text: its run lies in the first layout that holds any file of it.
LAYOUTS = ["run_id={run}/txt/", "run_id={run}/", "{run}/txt/", "{run}/"]


def laid_out(texts, shift):
    """Each run in one of the four layouts, by its day; ``shift`` layouts behind that if there is one."""
    nth = F.greatest(F.substring("run_id", 8, 1).cast("int") - 2, F.lit(0)) + shift
    place = F.replace(F.get(F.array(*map(F.lit, LAYOUTS)), nth), F.lit("{run}"), F.col("run_id"))
    return texts.select(F.concat(place, "post_id", F.lit(".txt")).alias("name"), F.concat("text", F.lit("\n")).alias("text")).where("name IS NOT NULL")


#: Listings of a later run.
LATE_TEXTS = f"""SELECT '20240106T090000Z' AS run_id, CAST(c_custkey AS STRING) AS post_id,
  'customer ' || c_name || {NL} AS text FROM {{customer}} WHERE c_nationkey = 7"""


def supplier_landing(spark, folder, passed_over=False):
    """One file per supplier, <run folder>/<post id>.txt; with ``passed_over`` also other texts of
    the same runs, in layouts that come after the one a run is read from."""
    def write(path):
        texts = derive(spark, folder, SUPPLIER_TEXTS, "supplier")
        files = laid_out(texts, 0)
        if passed_over:
            other = texts.withColumns({"text": F.concat(F.lit("older "), "text"), "post_id": F.concat(F.lit("9"), "post_id")})
            files = files.unionByName(laid_out(other, 1))
        write_files(files.repartition("name"), path, "name", "text")
    return landed(spark, folder, "supplier-texts", write)


def _read_run_texts(spark, folder):
    texts = read_run_texts(spark, supplier_landing(spark, folder, True))
    return texts.select("run_id", "post_id", "text")


def _read_packed_texts(spark, folder):
    """Two landings packed one after the other: the second run takes only what is new."""
    landing = supplier_landing(spark, folder, True)
    out, checkpoint = scratch_path(spark, "packed"), scratch_path(spark, "packed-state")
    pack_files(spark, landing, out, checkpoint).awaitTermination()
    late = derive(spark, folder, LATE_TEXTS, "customer")
    write_files(late.withColumn("name", F.concat("run_id", F.lit("/"), "post_id", F.lit(".txt"))).repartition("name"), landing, "name", "text")
    pack_files(spark, landing, out, checkpoint).awaitTermination()
    return read_packed_texts(spark, out).select("run_id", "post_id", "text")


def _list_runs(spark, folder):
    return list_runs(spark, supplier_landing(spark, folder))


# ---- JSON records -----------------------------------------------------------

def parsed_records(spark, folder):
    named = listings(spark, folder).withColumnRenamed("path", "source_txt")
    return extraction.parse_listing(named).drop("listing_id").withColumn(
        "scraped_at", iso_z(parse_run_id("run_id", "null")))


def record_landing(spark, folder):
    return landed(spark, folder, "records", lambda path: write_jsonl(parsed_records(spark, folder), path))


def landed_records(spark, folder):
    fields = [*MASTER_COLUMNS, "transmission", "fuel_type", "drivetrain"]
    return read_jsonl(spark, record_landing(spark, folder), None, ".txt", fields, one_per_file=False)


RECORD_FIELDS = ["post_id", "run_id", "source_txt", "price", "year", "make", "model", "mileage"]


def _read_jsonl(spark, folder):
    return landed_records(spark, folder).select(*RECORD_FIELDS)


def _read_packed_jsonl(spark, folder):
    """One file per customer, some of them malformed, packed and read as records."""
    rows = derive(spark, folder, SEGMENT_RUNS, "customer")
    record = F.when(F.col("post_id").cast("long") % 7 == 3, F.lit('{"post_id": ')).otherwise(F.to_json(F.struct("post_id", "price")))
    landing, out, state = (scratch_path(spark, n) for n in ("record-files", "packed-records", "packed-records-state"))
    name = F.concat(F.lit("run_id="), "run_id", F.lit("/jsonl/"), "post_id", F.lit(".jsonl"))
    write_files(rows.select(name.alias("name"), record.alias("text")).repartition("name"), landing, "name", "text")
    pack_files(spark, landing, out, state, "*.jsonl").awaitTermination()
    return read_packed_jsonl(spark, out).select("run_id", "post_id", "price")


def _union_runs(spark, folder):
    return landed_records(spark, folder).groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))


SEGMENT_RUNS = """SELECT CAST(20240100000000 + c_nationkey AS STRING) AS run_id, CAST(c_custkey AS STRING) AS post_id,
  CASE WHEN c_acctbal > 0 THEN CAST(floor(c_acctbal) AS BIGINT) END AS price FROM {customer}"""


def _write_jsonl(sparse):
    def query(spark, folder):
        path = scratch_path(spark, "write-jsonl")
        write_jsonl(derive(spark, folder, SEGMENT_RUNS, "customer"), path, sparse)
        return spark.read.text(path).select(F.col("run_id").cast("string").alias("folder"), F.col("value").alias("record"))
    return query


# ---- CSV tables -------------------------------------------------------------

def _read_table_csv(spark, folder):
    path = scratch_path(spark, "table-csv")
    rows = listings(spark, folder).withColumns({
        "combined_text": F.col("text"), "zip_code": F.lpad((F.col("listing_id") % 100000).cast("string"), 5, "0"),
        "has_combined_text": F.col("listing_id") % 2 == 0, "price": F.col("listing_id")})
    write_table_csv(rows, path, LISTING_COLUMNS)
    back = read_table_csv(spark, path, ["post_id", "price"])
    return back.select("price", "post_id", "run_id", "combined_text", "zip_code", "has_combined_text", "city")


def _write_table_csv(spark, folder):
    path = scratch_path(spark, "master-csv")
    write_table_csv(materialize(parsed_records(spark, folder)), path, MASTER_COLUMNS)
    return read_table_csv(spark, path, MASTER_COLUMNS, multi_line=False).drop("scraped_at")


# ---- pages ------------------------------------------------------------------

def _read_pages(spark, folder):
    return read_pages(spark, f"{folder}/pages.parquet").select("page_id", "url", F.md5("html").alias("html_md5"))


def landed_pages(spark, folder):
    return land_listings(search_pages(spark, folder), table(spark, folder, "pages"), BASE, "20240101000000", None)


def _land_listings(spark, folder):
    return landed_pages(spark, folder)


def _write_index(spark, folder):
    path = scratch_path(spark, "index")
    write_index(crawl_index(landed_pages(spark, folder)), path)
    return spark.read.csv(path, header=True).select("post_id", "url", "object", "error")


# ---- skip existing ----------------------------------------------------------

BATCH = "SELECT o_orderstatus AS run_id, o_orderkey AS post_id, 'new' AS source FROM {orders}"


def _existing(spark, folder, name):
    path = scratch_path(spark, name)
    old = derive(spark, folder, BATCH.replace("'new'", "'old'") + " WHERE o_orderpriority = '5-LOW'", "orders")
    write_if_absent(old, path)
    return path


def _write_if_absent(overwrite):
    def query(spark, folder):
        path = _existing(spark, folder, "absent")
        write_if_absent(derive(spark, folder, BATCH + " WHERE o_orderstatus <> 'P'", "orders"), path, overwrite=overwrite)
        return spark.read.parquet(path).select("run_id", "post_id", "source")
    return query


def _dry_run(spark, folder):
    path = _existing(spark, folder, "dry")
    new = write_if_absent(derive(spark, folder, BATCH, "orders"), path, dry_run=True)
    return new.groupBy("run_id").agg(F.count(F.lit(1)).alias("would_write")).withColumn(
        "rows_in_table", spark.read.parquet(path).agg(F.count(F.lit(1))).scalar())


# ---- artifacts --------------------------------------------------------------

def artifact_landing(spark, folder):
    def write(path):
        metrics = with_params(runs(spark, folder)).withColumns({"run_hour": F.col("run_id"), "kind": F.lit("metrics")})
        metrics.drop("run_id", "max_depth", "n_estimators").write.partitionBy("run_hour", "kind").json(path)
        rows = importance(spark, folder).select(
            F.col("run_id").alias("run_hour"), F.lit("permutation_importance").alias("kind"), "feature",
            F.col("importance").alias("importance_mean"))
        # One JSON array of records per run.
        arrays = rows.groupBy("run_hour", "kind").agg(F.to_json(F.sort_array(F.collect_list(
            F.struct("feature", "importance_mean")))).alias("value"))
        arrays.repartition("run_hour").write.mode("append").partitionBy("run_hour", "kind").option(
            "compression", "none").text(path + "-text")
    return landed(spark, folder, "artifacts", write)


def _read_run_metrics(spark, folder):
    out = read_run_metrics(spark, artifact_landing(spark, folder))
    return out.select("run_id", "train_rows", "mae_today", "bias_today", F.date_format("run_dt", "yyyy-MM-dd HH").alias("run_dt"),
                      F.col("best_params.model__max_depth").alias("max_depth"))


def _read_importance(spark, folder):
    out = read_importance(spark, artifact_landing(spark, folder) + "-text")
    return out.select("run_id", "feature", "importance", "position")


def _artifact_inventory(spark, folder):
    return artifact_inventory(spark, artifact_landing(spark, folder) + "-text").select(
        "kind", "files", "first_run", "last_run")


def _write_run_outputs(spark, folder):
    path = scratch_path(spark, "outputs")
    preds = predicted_events(spark, folder)
    row = preds.agg(F.count(F.lit(1)).alias("holdout_rows"), F.round(F.avg("actual_price"), 6).alias("mae_today"))
    write_run_outputs(path, "2024013000", preds.drop("props"), row)
    back = read_run_metrics(spark, path).select("run_id", "holdout_rows", "mae_today")
    written = spark.read.csv(f"{path}/2024013000/preds", header=True).agg(F.count(F.lit(1))).scalar()
    return back.withColumn("predictions", written)


# ---- materialized tables ----------------------------------------------------

def _materialize(spark, folder):
    return materialize(parsed_records(spark, folder)).drop("scraped_at")


def _materialize_v2(spark, folder):
    return materialize_v2(landed_records(spark, folder), folder_run="folder_run").drop("scraped_at")


def _materialize_listings(spark, folder):
    raw = listings(spark, folder).select("path", "text")
    out = materialize_listings(parsed_records(spark, folder), raw, "main")
    return out.select("post_id", "run_id", "price", "combined_text", "combined_text_len", "has_combined_text")


#: First link per post in order of discovery: a page's own .html anchors come first.
FIRST_LINKS = r"""SELECT page_id, url, regexp_extract(url, '/(\d+)\.html?$', 1) AS post_id FROM links QUALIFY row_number() OVER (
  PARTITION BY post_id ORDER BY page_id, CASE WHEN url IN (SELECT url FROM pages) THEN 0 ELSE 1 END, strpos(url, '/b/') = 0) = 1"""

QUERIES = {
    "read_run_texts": _read_run_texts, "read_packed_texts": _read_packed_texts, "list_runs": _list_runs, "read_jsonl": _read_jsonl,
    "read_packed_jsonl": _read_packed_jsonl,
    "union_runs": _union_runs, "write_jsonl": _write_jsonl(True), "write_jsonl_dense": _write_jsonl(False),
    "read_table_csv": _read_table_csv, "write_table_csv": _write_table_csv, "read_pages": _read_pages,
    "land_listings": _land_listings, "write_index": _write_index, "write_if_absent": _write_if_absent(False),
    "write_overwrite": _write_if_absent(True), "dry_run": _dry_run, "read_run_metrics": _read_run_metrics,
    "read_importance": _read_importance, "artifact_inventory": _artifact_inventory,
    "write_run_outputs": _write_run_outputs, "materialize": _materialize, "materialize_v2": _materialize_v2,
    "materialize_listings": _materialize_listings,
}

_LATEST = f"WITH {PARSED_CTE}, {LATEST_SQL.format(src='p', path='source_txt')}"
_VALID = f"WITH {PARSED_CTE}, v AS (SELECT * FROM p WHERE run_id <> 'zz')"
_JSON = """SELECT run_id AS folder, '{"run_id":"' || run_id || '","post_id":"' || post_id || '"' || %s || '}' AS record FROM (""" \
    + SEGMENT_RUNS.format(customer="customer") + ")"
ORACLES = {
    "read_run_texts": f"WITH {T_CTE} SELECT run_id, post_id, text || chr(10) AS text FROM t",
    "read_packed_texts": f"""WITH {T_CTE}, late AS ({LATE_TEXTS.format(customer='customer')})
SELECT run_id, post_id, text || chr(10) AS text FROM t UNION ALL SELECT * FROM late""",
    "list_runs": f"WITH {T_CTE} SELECT DISTINCT run_id FROM t",
    "read_jsonl": f"{_VALID} SELECT {', '.join(RECORD_FIELDS)} FROM v",
    "read_packed_jsonl": f"SELECT run_id, post_id, price FROM ({SEGMENT_RUNS.format(customer='customer')}) WHERE CAST(post_id AS BIGINT) % 7 <> 3",
    "union_runs": f"{_VALID} SELECT run_id, count(*) AS n FROM v GROUP BY 1",
    "write_jsonl": _JSON % "CASE WHEN price IS NULL THEN '' ELSE ',\"price\":' || price END",
    "write_jsonl_dense": _JSON % "',\"price\":' || coalesce(CAST(price AS VARCHAR), 'null')",
    "read_table_csv": f"""WITH {L} SELECT listing_id AS price, post_id, run_id, text AS combined_text,
  lpad(CAST(listing_id % 100000 AS VARCHAR), 5, '0') AS zip_code, listing_id % 2 = 0 AS has_combined_text, CAST(NULL AS VARCHAR) AS city FROM l""",
    "write_table_csv": f"{_LATEST} SELECT post_id, run_id, price, year, make, model, mileage, source_txt FROM latest",
    "read_pages": "SELECT page_id, url, md5(html) AS html_md5 FROM pages",
    "write_index": rf"""WITH {LINKS_SQL}, f AS ({FIRST_LINKS})
SELECT post_id, url, CASE WHEN url IN (SELECT url FROM pages) THEN 'scrapes/20240101000000/' || post_id || '.txt' END AS object,
  CASE WHEN url NOT IN (SELECT url FROM pages) THEN 'page not landed' END AS error FROM f""",
    "land_listings": rf"""WITH {LINKS_SQL}, f AS ({FIRST_LINKS}), v AS ({VISIBLE_SQL})
SELECT f.post_id, f.url, CASE WHEN v.text IS NULL THEN '' ELSE 'scrapes/20240101000000/' || f.post_id || '.txt' END AS object,
  '' AS image_url, CASE WHEN v.text IS NULL THEN 'page not landed' END AS error, v.text
FROM f LEFT JOIN pages p ON p.url = f.url LEFT JOIN v ON v.page_id = p.page_id""",
    "write_if_absent": """SELECT o_orderstatus AS run_id, o_orderkey AS post_id, CASE WHEN o_orderpriority = '5-LOW' THEN 'old' ELSE 'new' END AS source
  FROM orders WHERE o_orderpriority = '5-LOW' OR o_orderstatus <> 'P'""",
    "write_overwrite": """SELECT o_orderstatus AS run_id, o_orderkey AS post_id, CASE WHEN o_orderstatus = 'P' THEN 'old' ELSE 'new' END AS source
  FROM orders WHERE o_orderpriority = '5-LOW' OR o_orderstatus <> 'P'""",
    "dry_run": """SELECT o_orderstatus AS run_id, count(*) AS would_write, (SELECT count(*) FROM orders WHERE o_orderpriority = '5-LOW') AS rows_in_table
  FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1""",
    "read_run_metrics": f"""WITH {RUNS_CTE} SELECT run_id, train_rows, mae_today, bias_today,
  strftime(strptime(run_id, '%Y%m%d%H'), '%Y-%m-%d %H') AS run_dt, max_depth FROM runs""",
    "read_importance": f"""WITH {IMPORTANCE_CTE} SELECT run_id, feature, importance,
  CAST(row_number() OVER (PARTITION BY run_id ORDER BY feature) - 1 AS INTEGER) AS position FROM imp""",
    "artifact_inventory": f"""WITH {IMPORTANCE_CTE} SELECT 'permutation_importance' AS kind, count(DISTINCT run_id) AS files,
  min(run_id) AS first_run, max(run_id) AS last_run FROM imp""",
    "write_run_outputs": """WITH h AS (SELECT value FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events))
SELECT '2024013000' AS run_id, count(*) AS holdout_rows, round(avg(value), 6) AS mae_today, count(*) AS predictions FROM h""",
    "materialize": f"{_LATEST} SELECT post_id, run_id, price, year, make, model, mileage, source_txt FROM latest",
    "materialize_v2": f"""WITH {PARSED_CTE}, v AS (SELECT * FROM p WHERE run_id <> 'zz'), {LATEST_SQL.format(src='v', path='source_txt')}
SELECT post_id, run_id, price, year, make, model, mileage, transmission, fuel_type, drivetrain, source_txt FROM latest""",
    "materialize_listings": f"""WITH {PARSED_CTE}, {LATEST_SQL.format(src='p', path='source_txt')}, x AS (SELECT post_id, run_id, price, {clean_sql('text')} AS combined_text FROM latest)
SELECT *, length(combined_text) AS combined_text_len, length(combined_text) > 0 AS has_combined_text FROM x""",
}
