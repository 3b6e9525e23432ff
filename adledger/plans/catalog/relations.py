"""Filters, joins, windows, orders, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.times import local_day
from ...operators import dedup, filters, joins, ordering, sets, trends
from ...operators.metrics import regression_metrics
from .common import IMPORTANCE_CTE, L, RUNS_CTE, classes, derive, importance, listings, runs, table
from .fields import E_CTE, event_runs
from .texts import D_CTE, clean_sql, dirty

DAY_RUN = "CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS STRING)"


def _day_runs(spark, folder):
    return derive(spark, folder, f"SELECT event_id, value, {DAY_RUN} AS run_id FROM {{events}}", "events")


# ---- filters ----------------------------------------------------------------

def _newest_run(spark, folder):
    return filters.newest_run(_day_runs(spark, folder))


def _recent_runs(spark, folder):
    return filters.recent_runs(_day_runs(spark, folder), 7).select("event_id", "run_id")


def _valid_run_filter(spark, folder):
    return filters.valid_run_filter(event_runs(spark, folder)).select("event_id", "run_id")


KEYED = """SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN CAST(o_custkey AS STRING) WHEN 'O' THEN '' END AS post_id FROM {orders}"""


def _drop_missing_key(spark, folder):
    return filters.drop_missing_key(derive(spark, folder, KEYED, "orders"))


def _drop_bad_date(spark, folder):
    text = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("ts").cast("string"))
    dated = table(spark, folder, "events").withColumn("date_local", local_day(text, "UTC"))
    return filters.drop_bad_date(dated).select("event_id", F.col("date_local").cast("string").alias("day"))


def _price_band_filter(spark, folder):
    priced = table(spark, folder, "orders").withColumn("price_num", F.col("o_totalprice") / 4)
    return filters.price_band_filter(priced).select("o_orderkey", "price_num")


URLS = """SELECT doc_id, CASE lang WHEN 'en' THEN '  https://images.example.org/' || source || ' ' WHEN 'de' THEN 'n/a'
  WHEN 'fr' THEN NULL ELSE 'http://x' END AS image_url FROM {documents}"""


def _usable_image_filter(spark, folder):
    return filters.usable_image_filter(derive(spark, folder, URLS, "documents"))


def _incorrect_only(spark, folder):
    return filters.incorrect_only(classes(spark, folder))


def _columns_like(spark, folder):
    return filters.columns_like_counts(table(spark, folder, "pages"))


def _project_existing(spark, folder):
    return filters.project_existing(table(spark, folder, "part"), ["p_partkey", "color", "p_size", "p_name", "city"])


VEHICLES = """SELECT o_orderkey AS id, CAST(1990 + o_orderkey % 40 AS DOUBLE) AS year_num,
  CAST(o_custkey * 10 AS DOUBLE) AS mileage_num FROM {orders}"""


def _derived_columns(spark, folder):
    out = filters.derived_columns(derive(spark, folder, VEHICLES, "orders"))
    return out.select("id", "vehicle_age", F.round("miles_per_year", 6).alias("miles_per_year"))


# ---- joins ------------------------------------------------------------------

def _align_by_id(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    lookup = labels.select(F.col("doc_id").cast("string").alias("doc_id"), "quality")
    return joins.align_by_id(docs.select("doc_id", "lang"), lookup, "doc_id")


def _attach_image_url(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    lookup = labels.select("doc_id", F.concat(F.lit("https://images.example.org/"), "quality").alias("image_url"))
    return joins.attach_image_url(docs.select("doc_id", "lang"), lookup, "doc_id")


RECORDS = """SELECT doc_id, CASE lang WHEN 'fr' THEN NULL WHEN 'de' THEN '' ELSE lower(source) END AS combined_text,
  CASE doc_id % 5 WHEN 0 THEN 'gs://main/docs/' || CAST(doc_id AS STRING) || '.txt' WHEN 1 THEN NULL
    WHEN 2 THEN '/docs/missing.txt' ELSE 'docs/' || CAST(doc_id AS STRING) || '.txt' END AS source_txt FROM {documents}"""


def _backfill_text(spark, folder):
    raw = dirty(spark, folder).select(
        F.concat(F.lit("docs/"), "doc_id", F.lit(".txt")).alias("path"), F.col("raw").alias("text"))
    # Every third object landed a second time, under its full name and with another text.
    again = raw.where("length(path) % 3 = 0").select(F.concat(F.lit("gs://main/"), "path").alias("path"), F.lit("landed later").alias("text"))
    raw = raw.unionByName(again)
    records = derive(spark, folder, RECORDS, "documents")
    return joins.backfill_text(records, raw, "main").drop("source_txt")


SOURCED = """SELECT o_orderkey AS listing_id, CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN '' ELSE CAST(o_custkey AS STRING) END AS post_id,
  CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '2-HIGH' THEN 'gone/' || CAST(o_orderkey AS STRING)
    ELSE 'raw/' || CAST(o_orderkey AS STRING) END AS source_txt FROM {orders}"""


def _record_to_source(spark, folder):
    raw = listings(spark, folder).select(F.concat(F.lit("raw/"), "listing_id").alias("path"), "text")
    raw = raw.unionByName(raw.where("length(text) % 3 = 0").select("path", F.lit("z: landed later").alias("text")))
    return joins.record_to_source(derive(spark, folder, SOURCED, "orders"), raw)


def _skip_existing(spark, folder):
    o = table(spark, folder, "orders")
    done = o.where("o_orderstatus = 'F'")
    return joins.skip_existing(o.select("o_custkey", "o_orderkey"), done, ["o_custkey", "o_orderkey"])


# ---- windows ----------------------------------------------------------------

def _latest_by_key(spark, folder):
    return dedup.latest_by_key(listings(spark, folder).drop("text"), path="path")


LATEST_SQL = """latest AS (SELECT * FROM {src} WHERE post_id IS NOT NULL AND post_id <> '' QUALIFY row_number() OVER (PARTITION BY post_id
  ORDER BY CASE WHEN run_id = 'zz' THEN '9' ELSE replace(replace(run_id, 'T', ''), 'Z', '') END DESC, run_id, {path}) = 1)"""


def _first_by_key_capped(spark, folder):
    return dedup.first_by_key_capped(
        table(spark, folder, "lineitem"), "l_partkey", ["l_orderkey", "l_linenumber"], 500,
    ).select("l_partkey", "l_orderkey", "l_linenumber")


def _rank_per_group(spark, folder):
    return dedup.rank_per_group(importance(spark, folder))


def _half_index(spark, folder):
    return trends.half_index(runs(spark, folder), "run_id").select("run_id", "position", "n_runs", "half")


def _adjacent_dedup(spark, folder):
    lines = table(spark, folder, "documents").select("doc_id", F.posexplode(F.split("text", r"[\s]+")).alias("pos", "line"))
    return dedup.adjacent_dedup(lines, "doc_id", "pos", "line")


def _best_run_row(spark, folder):
    return dedup.best_run_row(runs(spark, folder), [F.asc("mae_today"), F.asc("run_id")]).select("run_id", "mae_today")


# ---- orders, limits, samples ------------------------------------------------

SCRAPED = """SELECT o_orderkey AS post_id, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(year(o_orderdate) AS STRING) END AS scraped_at FROM {orders}"""


def _order_by_scraped_at(spark, folder):
    return ordering.order_by_scraped_at(derive(spark, folder, SCRAPED, "orders"))


def _order_runs(spark, folder):
    return ordering.order_runs(runs(spark, folder), "run_id").select("run_id", "train_rows")


def _order_importance(spark, folder):
    return ordering.order_importance(importance(spark, folder), "importance")


def _order_models(spark, folder):
    scores = table(spark, folder, "lineitem").groupBy(F.col("l_returnflag").alias("model_name")).agg(
        F.round(F.avg("l_discount"), 6).alias("weighted_f1"))
    return ordering.order_models(scores)


def _top_usable_features(spark, folder):
    items = table(spark, folder, "lineitem").withColumn("l_none", F.lit(None).cast("double"))
    names = ["l_quantity", "l_discount", "l_tax", "l_none", "l_linenumber"]
    means = items.agg(*[F.round(F.avg(F.coalesce(F.col(n).cast("double"), F.lit(99.0))), 6).alias(n) for n in names])
    rows = means.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("feature"), F.col(n).alias("importance_mean")) for n in names])))
    early, late = items.where("l_linestatus = 'F'"), items.where("l_linestatus = 'O'")
    return ordering.top_usable_features(rows, early, late, names, 3)


def _cap_files(spark, folder):
    return ordering.cap_files(listings(spark, folder), 1000).select("path", "listing_id")


def _cap_items(spark, folder):
    return dedup.cap_items(table(spark, folder, "orders"), ["o_orderdate", "o_orderkey"], 50).select("o_orderkey")


def _seeded_sample(spark, folder):
    return ordering.seeded_sample(table(spark, folder, "orders"), 6, "o_orderkey").select("o_orderkey", "o_totalprice")


# ---- unions -----------------------------------------------------------------

def _union_by_name(spark, folder):
    s = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), "s_acctbal")
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("error"))
    return sets.union_by_name(s, c)


def _append_results(spark, folder):
    items = table(spark, folder, "lineitem")

    def scored(flag: str):
        rows = items.where(F.col("l_returnflag") == flag)
        out = regression_metrics(rows, "l_quantity", "l_linenumber")
        return out.select(F.lit(flag).alias("model_name"), F.round("mae", 6).alias("mae"),
                          F.round("bias", 6).alias("bias"))

    return sets.append_results(scored("A"), scored("N"), scored("R"))


NEEDED = ["o_orderkey", "o_custkey", "post_id", "price", "scraped_at"]


def _missing_columns(spark, folder):
    """Names the table lacks, beside what it has: its columns that were asked for and its rows."""
    orders = table(spark, folder, "orders")
    absent = filters.missing_columns(orders, NEEDED)
    counted = orders.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(F.explode(F.array(*[F.lit(c) for c in absent])).alias("missing"), "n_rows")


QUERIES = {
    "missing_columns": _missing_columns, "newest_run": _newest_run, "recent_runs": _recent_runs, "valid_run_filter": _valid_run_filter,
    "drop_missing_key": _drop_missing_key, "drop_bad_date": _drop_bad_date,
    "price_band_filter": _price_band_filter, "usable_image_filter": _usable_image_filter,
    "incorrect_only": _incorrect_only, "columns_like": _columns_like, "project_existing": _project_existing,
    "derived_columns": _derived_columns, "align_by_id": _align_by_id, "attach_image_url": _attach_image_url,
    "backfill_text": _backfill_text, "record_to_source": _record_to_source, "skip_existing": _skip_existing,
    "latest_by_key": _latest_by_key, "first_by_key_capped": _first_by_key_capped,
    "rank_per_group": _rank_per_group, "half_index": _half_index, "adjacent_dedup": _adjacent_dedup,
    "best_run_row": _best_run_row, "order_by_scraped_at": _order_by_scraped_at, "order_runs": _order_runs,
    "order_importance": _order_importance, "order_models": _order_models,
    "top_usable_features": _top_usable_features, "cap_files": _cap_files, "cap_items": _cap_items,
    "seeded_sample": _seeded_sample, "union_by_name": _union_by_name, "append_results": _append_results,
}

ORACLES = {
    "newest_run": f"SELECT event_id, value, {DAY_RUN} AS run_id FROM events WHERE {DAY_RUN} = (SELECT max({DAY_RUN}) FROM events)",
    "recent_runs": f"""SELECT event_id, run_id FROM (SELECT event_id, {DAY_RUN} AS run_id, dense_rank() OVER (ORDER BY {DAY_RUN} DESC) AS d
  FROM events) WHERE d <= 7""",
    "valid_run_filter": f"WITH {E_CTE} SELECT event_id, run_id FROM e WHERE run_id <> 'zz'",
    "drop_missing_key": "SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS post_id FROM orders WHERE o_orderstatus = 'F'",
    "drop_bad_date": "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events WHERE event_type <> 'error'",
    "price_band_filter": "SELECT o_orderkey, o_totalprice / 4 AS price_num FROM orders WHERE o_totalprice / 4 > 500 AND o_totalprice / 4 < 100000",
    "usable_image_filter": """SELECT doc_id, CASE lang WHEN 'en' THEN 'https://images.example.org/' || source ELSE 'http://x' END AS image_url
  FROM documents WHERE lang NOT IN ('de', 'fr')""",
    "incorrect_only": """SELECT *, actual_tier = predicted_tier AS correct_prediction FROM (
SELECT l_orderkey, l_linenumber,
  CASE l_returnflag WHEN 'A' THEN 'low' WHEN 'N' THEN 'medium' ELSE 'high' END AS actual_tier,
  CASE WHEN l_quantity < 17 THEN 'low' WHEN l_quantity < 34 OR l_returnflag = 'N' THEN 'medium' ELSE 'high' END AS predicted_tier
FROM lineitem) WHERE actual_tier <> predicted_tier""",
    "columns_like": "SELECT 'url' AS column_name, count(url) AS non_null FROM pages",
    "project_existing": "SELECT p_partkey, p_size, p_name FROM part",
    "derived_columns": """SELECT o_orderkey AS id, CAST(36 - o_orderkey % 40 AS DOUBLE) AS vehicle_age,
  round(CAST(o_custkey * 10 AS DOUBLE) / nullif(36 - o_orderkey % 40, 0), 6) AS miles_per_year FROM orders""",
    "align_by_id": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, quality FROM documents JOIN labels USING (doc_id)",
    "attach_image_url": """SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, lang, CASE WHEN quality IS NOT NULL THEN
  'https://images.example.org/' || quality END AS display_image_url FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "backfill_text": f"""WITH {D_CTE}, r AS (
SELECT doc_id, CASE WHEN lang NOT IN ('fr', 'de') THEN lower(source) WHEN doc_id % 5 IN (0, 3, 4) THEN {clean_sql('raw')} ELSE '' END AS combined_text
FROM documents JOIN d USING (doc_id))
SELECT doc_id, combined_text, length(combined_text) AS combined_text_len, length(combined_text) > 0 AS has_combined_text FROM r""",
    "record_to_source": f"""WITH {L}, r AS ({SOURCED.format(orders='orders')})
SELECT r.listing_id, r.post_id, source_txt,
  CASE WHEN r.post_id <> '' AND starts_with(source_txt, 'raw/') THEN text END AS raw_text,
  CASE WHEN r.post_id = '' THEN 'missing post_id' WHEN source_txt IS NULL THEN 'missing source_txt'
    WHEN starts_with(source_txt, 'gone/') THEN 'source text not found' END AS error
FROM r JOIN l ON r.listing_id = l.listing_id""",
    "skip_existing": "SELECT o_custkey, o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM orders x WHERE x.o_orderkey = o.o_orderkey AND x.o_custkey = o.o_custkey AND x.o_orderstatus = 'F')",
    "latest_by_key": f"WITH {L}, {LATEST_SQL.format(src='l', path='path')} SELECT listing_id, post_id, run_id, path FROM latest",
    "first_by_key_capped": """SELECT l_partkey, l_orderkey, l_linenumber FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber) = 1) ORDER BY l_orderkey, l_linenumber LIMIT 500""",
    "rank_per_group": f"WITH {IMPORTANCE_CTE} SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY importance DESC, feature) AS rank FROM imp",
    "half_index": f"""WITH {RUNS_CTE}, p AS (SELECT run_id, row_number() OVER (ORDER BY run_id) AS position, count(*) OVER () AS n_runs FROM runs)
SELECT *, CAST(CASE WHEN position <= n_runs // 2 THEN 1 ELSE 2 END AS BIGINT) AS half FROM p""",
    "missing_columns": "SELECT unnest(['post_id', 'price', 'scraped_at']) AS missing, (SELECT count(*) FROM orders) AS n_rows",
    "adjacent_dedup": r"""WITH w AS (SELECT doc_id, regexp_split_to_array(text, '\s+') AS l FROM documents),
p AS (SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS line FROM w),
q AS (SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM p)
SELECT doc_id, pos, line FROM q WHERE pos = 0 OR line IS DISTINCT FROM before""",
    "best_run_row": f"WITH {RUNS_CTE} SELECT run_id, mae_today FROM runs ORDER BY mae_today, run_id LIMIT 1",
    "order_by_scraped_at": SCRAPED.format(orders="orders") + " ORDER BY coalesce(scraped_at, ''), post_id",
    "order_runs": f"WITH {RUNS_CTE} SELECT run_id, train_rows FROM runs ORDER BY run_id",
    "order_importance": f"WITH {IMPORTANCE_CTE} SELECT * FROM imp ORDER BY importance DESC, feature",
    "order_models": "SELECT l_returnflag AS model_name, round(avg(l_discount), 6) AS weighted_f1 FROM lineitem GROUP BY 1",
    "top_usable_features": """SELECT * FROM (SELECT 'l_quantity' AS feature, round(avg(l_quantity), 6) AS importance_mean FROM lineitem
UNION ALL SELECT 'l_discount', round(avg(l_discount), 6) FROM lineitem UNION ALL SELECT 'l_tax', round(avg(l_tax), 6) FROM lineitem
UNION ALL SELECT 'l_linenumber', round(avg(l_linenumber), 6) FROM lineitem) ORDER BY 2 DESC LIMIT 3""",
    "cap_files": f"WITH {L} SELECT path, listing_id FROM l ORDER BY path LIMIT 1000",
    "cap_items": "SELECT o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 50",
    "seeded_sample": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':42') LIMIT 6",
    "union_by_name": """SELECT NULL AS error, s_suppkey AS id, s_name AS name, s_acctbal FROM supplier
UNION ALL SELECT c_mktsegment, c_custkey, NULL, NULL FROM customer""",
    "append_results": """SELECT l_returnflag AS model_name, round(avg(abs(l_linenumber - l_quantity)), 6) AS mae,
  round(avg(l_linenumber - l_quantity), 6) AS bias FROM lineitem GROUP BY 1""",
}
