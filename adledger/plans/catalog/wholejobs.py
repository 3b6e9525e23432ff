"""Whole jobs from raw rows to their results, on inputs whose outcome SQL can state."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import models, splits
from ..jobs import extract_with_model, train_and_score
from .aggregates import tier_sql, tiered_listings
from .common import L, THOUSANDS, derive, landed, listings
from .fields import PARSED_CTE, answer_by_rules
from .landing import parsed_records
from .learning import STUMP
from .relations import LATEST_SQL

# ---- train and score --------------------------------------------------------

#: Listings of four days, some without a readable price or day. The make moves the price; nothing
#: else that varies is known, so a tree of depth one predicts the mean of a make's earlier days.
SALE = "(CAST(floor(o_totalprice / 10) AS BIGINT) + CASE o_orderstatus WHEN 'F' THEN 50000 ELSE 0 END)"
SALES = f"""
SELECT CAST(o_orderkey AS STRING) AS post_id, o_orderkey % 29 <> 5 AS priced, {SALE} AS amount, 1 + o_orderkey % 4 AS day,
  CASE WHEN o_orderkey % 31 = 7 THEN 'soon' ELSE '2024-03-0' || CAST(1 + o_orderkey % 4 AS STRING) || 'T15:00:00Z' END AS scraped_at,
  CASE WHEN o_orderkey % 29 = 5 THEN 'ask' ELSE '$' || {THOUSANDS.format(x=SALE)} END AS price,
  CASE o_orderstatus WHEN 'F' THEN 'Honda' ELSE 'Ford' END AS make FROM {{orders}}"""
SALES_CTE = f"s AS ({SALES.format(orders='orders')})"


def _train_and_score(spark, folder):
    constant = {"model": "any", "year": "2010", "mileage": "40,000", "engine_cylinders": "4", "title_status": "clean",
                **dict.fromkeys(("transmission", "drivetrain", "fuel_type", "condition", "color", "body_type"), "same")}
    rows = derive(spark, folder, SALES, "orders").drop("amount", "priced", "day").withColumns({c: F.lit(v) for c, v in constant.items()})
    path = landed(spark, folder, "sales", lambda p: rows.write.parquet(p))  # the listing table lies written
    result = train_and_score(spark.read.parquet(path), grid={k: [v] for k, v in STUMP.items()}, repeats=2)
    moved = result.importance.agg(F.max_by("feature", "importance_mean").alias("top_feature"),
                                  F.count_if(F.abs("importance_mean") < 1e-6).alias("idle_features"))
    measures = result.metrics.select("today_local", F.col("train_rows").cast("long").alias("train_rows"), F.col("holdout_rows").cast("long").alias("holdout_rows"),
                                     *[F.round(c, 4).alias(c) for c in ("mae_today", "rmse_today", "mape_today", "bias_today")])
    run = {**measures.first().asDict(), **moved.first().asDict()}
    return result.predictions.select("post_id", F.col("actual_price").cast("long").alias("actual_price"), "pred_price",
                                     *[F.lit(v).cast("long" if isinstance(v, int) else "string" if isinstance(v, str) else "double").alias(c) for c, v in run.items()])


TRAINED_SQL = f"""WITH {SALES_CTE}, dated AS (SELECT *, CASE WHEN priced THEN amount END AS actual_price FROM s WHERE scraped_at <> 'soon'),
m AS (SELECT make, avg(actual_price) AS mean FROM dated WHERE day < 4 GROUP BY 1),
h AS (SELECT post_id, actual_price, mean, mean - actual_price AS err FROM dated JOIN m USING (make) WHERE day = 4),
r AS (SELECT round(avg(abs(err)), 4) AS mae_today, round(sqrt(avg(err * err)), 4) AS rmse_today, round(avg(abs(err / actual_price)) * 100, 4) AS mape_today,
  round(avg(err), 4) AS bias_today, count(*) AS holdout_rows FROM h)
SELECT post_id, actual_price, round(mean, 2) AS pred_price, '2024-03-04' AS today_local,
  (SELECT count(actual_price) FROM dated WHERE day < 4) AS train_rows, holdout_rows, mae_today, rmse_today, mape_today, bias_today,
  'make' AS top_feature, CAST(11 AS BIGINT) AS idle_features FROM h, r"""

# ---- extract with a model ---------------------------------------------------


def load_rules():
    """What a worker loads once: here the rules that stand in for a model."""
    return answer_by_rules


def _extract_with_model(spark, folder):
    raw = listings(spark, folder).select("path", "text")
    out = extract_with_model(parsed_records(spark, folder), raw, None, "rules", "v1", setup=load_rules, wait=0.0)
    return out.select("run_id", "post_id", "source_txt", "price", "year", "model", "engine_cylinders", "llm_provider", "llm_model", "error")


MODEL_SQL = f"""WITH {L} SELECT run_id, post_id, path AS source_txt, CASE WHEN ok THEN listing_id END AS price,
  CASE WHEN ok AND listing_id % 2 = 0 THEN CAST(2001 AS BIGINT) END AS year, CASE WHEN ok THEN 'm' || (listing_id % 3) END AS model,
  CASE WHEN ok THEN CAST(4 AS BIGINT) END AS engine_cylinders, 'rules' AS llm_provider, 'v1' AS llm_model,
  CASE WHEN NOT ok THEN 'ValueError: no answer' END AS error
FROM (SELECT *, listing_id % 17 <> 0 AS ok FROM l)"""

# ---- dense network ----------------------------------------------------------


def _network_classifier(spark, folder):
    """One category gives the tier away; the network has one hidden layer."""
    path = landed(spark, folder, "network-table", lambda p: tiered_listings(spark, folder).write.parquet(p))
    tiers = spark.read.parquet(path).withColumn("told", F.concat(F.lit("is "), "price_tier"))
    split = splits.stratified_split(tiers, "price_tier", "post_id")
    model = models.structured_classifier(split.where("split = 'train'"), numeric=[], categorical=["told", "transmission"], hidden=[8], max_iter=60)
    return model.transform(split).select("post_id", "price_tier", "predicted_tier")


QUERIES = {"train_and_score": _train_and_score, "extract_with_model": _extract_with_model, "network_classifier": _network_classifier}

ORACLES = {
    "train_and_score": TRAINED_SQL, "extract_with_model": MODEL_SQL,
    "network_classifier": f"""WITH {PARSED_CTE}, {LATEST_SQL.format(src='p', path='source_txt')},
f AS (SELECT post_id, CAST(price AS DOUBLE) AS price_num FROM latest WHERE price > 500 AND price < 100000), {tier_sql('f', 'price_num')}
SELECT post_id, price_tier, price_tier AS predicted_tier FROM t""",
}
