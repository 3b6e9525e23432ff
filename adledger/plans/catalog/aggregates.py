"""Counts, metrics, trends."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.times import parse_run_hour
from ...operators import dedup, extraction, filters, metrics, sets, splits, summaries, trends
from .common import CLASSES_CTE, IMPORTANCE_CTE, L, RUNS_CTE, classes, importance, listings, runs, table
from .fields import PARSED_CTE
from .relations import LATEST_SQL
from .texts import D_CTE, dirty

FEATURES = ["click", "error", "purchase", "signup", "view"]


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def events_by_day(spark, folder):
    return table(spark, folder, "events").withColumn("date_local", F.to_date("ts"))


# ---- tiers ------------------------------------------------------------------

def _tier_summary(spark, folder):
    o = table(spark, folder, "orders").withColumn("price_num", F.col("o_totalprice") / 4)
    return summaries.tier_summary(splits.price_tier(filters.price_band_filter(o)))


def tiered_listings(spark, folder):
    """Newest text per post, parsed only then (older texts never meet a pattern), tiered."""
    latest = dedup.latest_by_key(listings(spark, folder).withColumnRenamed("path", "source_txt"))
    parsed = extraction.parse_listing(latest)
    priced = filters.price_band_filter(parsed.withColumn("price_num", F.col("price").cast("double")))
    return splits.price_tier(priced)


def _tier_summary_of_listings(spark, folder):
    return summaries.tier_summary(tiered_listings(spark, folder))


def tier_sql(src: str, price: str) -> str:
    return f"""q AS (SELECT quantile_cont({price}, 1.0/3) AS q1, quantile_cont({price}, 2.0/3) AS q2 FROM {src}),
t AS (SELECT x.*, CASE WHEN {price} <= q1 THEN 'low' WHEN {price} <= q2 THEN 'medium' ELSE 'high' END AS price_tier FROM {src} x, q)"""


BAND_CTE = "b AS (SELECT o_orderkey, o_totalprice / 4 AS price_num FROM orders WHERE o_totalprice / 4 > 500 AND o_totalprice / 4 < 100000)"
SUMMARY = "SELECT price_tier, min(price_num) AS min, max(price_num) AS max, count(*) AS count FROM t GROUP BY 1"


# ---- counts -----------------------------------------------------------------

def _value_counts(spark, folder):
    return summaries.value_counts(table(spark, folder, "documents"), "lang")


def _recent_day_counts(spark, folder):
    out = summaries.recent_day_counts(events_by_day(spark, folder))
    return out.withColumn("date_local", F.col("date_local").cast("string"))


def _fill_rates(spark, folder):
    d = dirty(spark, folder)
    url = F.when(F.col("doc_id") % 3 == 0, F.lit("\t http://x")).when(F.col("doc_id") % 3 == 1, F.lit("n/a"))
    price = F.when(F.col("doc_id") % 7 > 1, F.col("doc_id"))
    body = F.when(F.col("doc_id") % 4 > 0, F.col("raw"))
    return summaries.fill_rates(d.select(price.alias("price_num"), body.alias("combined_text"), url.alias("image_url")))


def _dropped_for_target(spark, folder):
    e = events_by_day(spark, folder).withColumn("price_num", F.when(F.col("event_type") != "error", F.col("value")))
    last = e.agg(F.max("date_local")).scalar()
    return summaries.dropped_for_target(e, "date_local", last)


def _distinct_days(spark, folder):
    return summaries.distinct_days(events_by_day(spark, folder)).select(F.col("day").cast("string").alias("day"))


def _distinct_runs(spark, folder):
    return summaries.distinct_runs(listings(spark, folder))


def _run_summary(spark, folder):
    o = table(spark, folder, "orders")
    return summaries.run_summary(o, F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "O",
                                 F.col("o_orderstatus") == "P")


def _materialize_summary(spark, folder):
    rows = listings(spark, folder).drop("text")
    return summaries.materialize_summary(rows, dedup.latest_by_key(rows, path="path"))


def _image_availability(spark, folder):
    docs = table(spark, folder, "documents")
    url = F.when(F.col("lang") == "en", F.lit("https://images.example.org/a")).when(F.col("lang") == "fr", F.lit("x"))
    loaded = table(spark, folder, "labels").where("toxic = 0")
    return summaries.image_availability(docs.select("doc_id", url.alias("image_url")), loaded, key="doc_id")


# ---- metrics ----------------------------------------------------------------

def predicted_events(spark, folder):
    """Last day of events beside a rule's prediction."""
    split = splits.day_split(events_by_day(spark, folder), price="value")
    return split.holdout.withColumnRenamed("value", "actual_price").withColumn(
        "pred_price", F.lit(10.0) + F.col("user_id") % 20)


def _regression_metrics(spark, folder):
    out = metrics.regression_metrics(predicted_events(spark, folder))
    return rounded(out, "mae", "rmse", "mape", "bias", digits=4)


REGRESSION_SQL = """WITH h AS (SELECT value AS act, 10.0::DOUBLE + user_id % 20 AS pred FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events))
SELECT round(avg(abs(pred - act)), 4) AS mae, round(sqrt(avg((pred - act) ** 2)), 4) AS rmse,
  round(avg(abs((pred - act) / nullif(act, 0))) * 100, 4) AS mape, round(avg(pred - act), 4) AS bias,
  count(*) AS n_scored, CAST(sum(CASE WHEN act = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_zero_actual FROM h"""


def _confusion_matrix(spark, folder):
    return metrics.confusion_matrix(classes(spark, folder))


def _classification_report(spark, folder):
    return rounded(metrics.classification_report(classes(spark, folder)), "precision", "recall", "f1")


def _accuracy_weighted_f1(spark, folder):
    return rounded(metrics.accuracy_weighted_f1(classes(spark, folder)), "accuracy", "weighted_f1")


def _error_directions(spark, folder):
    return metrics.error_directions(classes(spark, folder))


RULES = {
    "Rule": "predicted_tier", "Always low": "'low'",
    "By line": "CASE WHEN l_linenumber < 3 THEN 'high' ELSE predicted_tier END",
}


def results(spark, folder):
    return sets.append_results(*[
        metrics.accuracy_weighted_f1(classes(spark, folder).withColumn("predicted_tier", F.expr(rule))).select(
            F.lit(name).alias("model_name"), "accuracy", "weighted_f1")
        for name, rule in RULES.items()])


def _model_comparison(spark, folder):
    return metrics.model_comparison(results(spark, folder))


def _best_model(spark, folder):
    return metrics.best_model(results(spark, folder)).select("model_name", "weighted_f1")


def _comparison_verdict(spark, folder):
    return metrics.comparison_verdict(results(spark, folder), "Always low")


def scores_sql(predicted: str = "predicted_tier") -> str:
    """One row per class of ``c``: tp, predicted, support and the three scores."""
    return f"""SELECT label, tp, sup AS support,
  CASE WHEN pr = 0 THEN 0 ELSE tp / pr::DOUBLE END AS precision, CASE WHEN sup = 0 THEN 0 ELSE tp / sup::DOUBLE END AS recall,
  CASE WHEN pr + sup = 0 THEN 0 ELSE 2 * tp / (pr + sup)::DOUBLE END AS f1 FROM (
SELECT label, CAST(count(*) FILTER (actual_tier = label AND {predicted} = label) AS BIGINT) AS tp,
  count(*) FILTER ({predicted} = label) AS pr, count(*) FILTER (actual_tier = label) AS sup
FROM c, (SELECT unnest(['low', 'medium', 'high']) AS label) GROUP BY label)"""


SCORES_CTE = f"{CLASSES_CTE}, s AS ({scores_sql()})"
RESULTS_SQL = f"WITH {CLASSES_CTE}, r AS (" + " UNION ALL ".join(
    f"""SELECT '{name}' AS model_name, round_even(CAST(sum(tp) AS DOUBLE) / CAST(sum(support) AS DOUBLE), 4) AS accuracy,
  round_even(sum(f1 * support) / CAST(sum(support) AS DOUBLE), 4) AS weighted_f1 FROM ({scores_sql(rule)})"""
    for name, rule in RULES.items()) + "), ranked AS (SELECT *, row_number() OVER (ORDER BY weighted_f1 DESC, model_name) AS place FROM r)"


# ---- trends -----------------------------------------------------------------

def _run_span(spark, folder):
    out = trends.run_span(runs(spark, folder).withColumn("run_dt", parse_run_hour("run_id")))
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm") for c in ("first_run", "latest_run")})


def _trend_halves(spark, folder):
    return rounded(trends.trend_halves(runs(spark, folder), "run_id"), "early_mean", "recent_mean")


TREND_SQL = f"""WITH {RUNS_CTE}, p AS (SELECT *, row_number() OVER (ORDER BY run_id) <= (SELECT count(*) // 2 FROM runs) AS early FROM runs),
u AS (""" + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, '{label}' AS label, avg({m}) FILTER (early) AS a, avg({m}) FILTER (NOT early) AS b FROM p"
    for m, label in trends.ERROR_METRICS.items()) + """)
SELECT metric, label, round(a, 6) AS early_mean, round(b, 6) AS recent_mean,
  CASE WHEN metric = 'bias_today' THEN CASE WHEN abs(b) < abs(a) THEN 'Improving' ELSE 'Worsening' END
    WHEN b < a THEN 'Improving' WHEN b > a THEN 'Worsening' ELSE 'Stable' END AS direction FROM u"""


def _importance_pivot(spark, folder):
    return trends.importance_pivot(importance(spark, folder), FEATURES, "run_id")


def _top_features(spark, folder):
    return rounded(trends.top_features(importance(spark, folder), 3, "run_id"), "avg_importance")


def _rank_stability(spark, folder):
    return trends.rank_stability(importance(spark, folder))


def with_params(df):
    return df.withColumn("best_params", F.struct(
        F.col("max_depth").alias("model__max_depth"), F.col("n_estimators").alias("model__n_estimators")))


def _param_usage(spark, folder):
    return trends.param_usage(with_params(runs(spark, folder)))


def _expand_struct(spark, folder):
    plain = with_params(runs(spark, folder)).drop("max_depth", "n_estimators")
    return trends.run_params(plain, ("run_id", "train_rows", "best_cv_mae"))


def _cv_vs_holdout(spark, folder):
    return rounded(trends.cv_vs_holdout(runs(spark, folder), "run_id"), "gap")


def _training_growth(spark, folder):
    return rounded(trends.training_growth(runs(spark, folder), "run_id"), "holdout_share")


QUERIES = {
    "tier_summary_of_listings": _tier_summary_of_listings, "tier_summary": _tier_summary,
    "value_counts": _value_counts, "recent_day_counts": _recent_day_counts, "fill_rates": _fill_rates,
    "dropped_for_target": _dropped_for_target, "distinct_days": _distinct_days, "distinct_runs": _distinct_runs,
    "run_summary": _run_summary, "materialize_summary": _materialize_summary,
    "image_availability": _image_availability, "regression_metrics": _regression_metrics,
    "confusion_matrix": _confusion_matrix, "classification_report": _classification_report,
    "accuracy_weighted_f1": _accuracy_weighted_f1, "error_directions": _error_directions,
    "model_comparison": _model_comparison, "best_model": _best_model, "comparison_verdict": _comparison_verdict,
    "run_span": _run_span, "trend_halves": _trend_halves, "importance_pivot": _importance_pivot,
    "top_features": _top_features, "rank_stability": _rank_stability, "param_usage": _param_usage,
    "expand_struct": _expand_struct, "cv_vs_holdout": _cv_vs_holdout, "training_growth": _training_growth,
}

ORACLES = {
    "tier_summary_of_listings": f"""WITH {PARSED_CTE}, {LATEST_SQL.format(src='p', path='source_txt')},
f AS (SELECT CAST(price AS DOUBLE) AS price_num FROM latest WHERE price > 500 AND price < 100000), {tier_sql('f', 'price_num')} {SUMMARY}""",
    "tier_summary": f"WITH {BAND_CTE}, {tier_sql('b', 'price_num')} {SUMMARY}",
    "value_counts": "SELECT lang, count(*) AS count FROM documents GROUP BY 1",
    "recent_day_counts": "SELECT strftime(ts, '%Y-%m-%d') AS date_local, count(*) AS count FROM events GROUP BY 1 ORDER BY 1 DESC LIMIT 8",
    "fill_rates": f"""WITH {D_CTE} SELECT count(*) AS rows_total, count(*) FILTER (doc_id % 7 > 1) AS valid_price_rows,
  count(*) FILTER (doc_id % 4 > 0) AS rows_with_text,
  count(*) FILTER (doc_id % 4 > 0 AND regexp_matches(raw, 'scrapes/|gs://|\\.txt')) AS path_like_rows,
  count(*) FILTER (doc_id % 3 = 0) AS rows_with_image, count(*) FILTER (doc_id % 3 <> 0) AS rows_without_image FROM d""",
    "dropped_for_target": """SELECT count(*) AS rows_before, count(*) FILTER (event_type = 'error' OR value IS NULL) AS dropped_for_target
  FROM events WHERE CAST(ts AS DATE) < (SELECT max(CAST(ts AS DATE)) FROM events)""",
    "distinct_days": "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day FROM events",
    "distinct_runs": f"WITH {L} SELECT count(DISTINCT run_id) AS n_runs, count(*) AS n_rows FROM l",
    "run_summary": """SELECT count(*) AS processed, count(*) FILTER (o_orderstatus = 'F') AS written,
  count(*) FILTER (o_orderstatus = 'O') AS skipped, count(*) FILTER (o_orderstatus = 'P') AS errors FROM orders""",
    "materialize_summary": f"WITH {L} SELECT count(DISTINCT run_id) AS runs_scanned, count(DISTINCT post_id) AS unique_listings, count(DISTINCT post_id) AS rows_written FROM l",
    "image_availability": """SELECT count(*) AS total_listings, count(*) FILTER (lang = 'en') AS listings_with_image_urls,
  count(*) FILTER (lang = 'en' AND doc_id IN (SELECT doc_id FROM labels WHERE toxic = 0)) AS images_successfully_loaded FROM documents""",
    "regression_metrics": REGRESSION_SQL,
    "confusion_matrix": f"""WITH {CLASSES_CTE} SELECT CAST(position AS BIGINT) AS position, label AS actual,
  count(*) FILTER (actual_tier = label AND predicted_tier = 'low') AS pred_low,
  count(*) FILTER (actual_tier = label AND predicted_tier = 'medium') AS pred_medium,
  count(*) FILTER (actual_tier = label AND predicted_tier = 'high') AS pred_high
FROM c, (SELECT unnest([0, 1, 2]) AS position, unnest(['low', 'medium', 'high']) AS label) GROUP BY 1, 2""",
    "classification_report": f"""WITH {SCORES_CTE},
a AS (SELECT CAST(sum(tp) AS DOUBLE) / CAST(sum(support) AS DOUBLE) AS acc, CAST(sum(support) AS BIGINT) AS n FROM s)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM s
UNION ALL SELECT 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), n FROM a
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM s
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support)::DOUBLE, 6),
  round(sum(recall * support) / sum(support)::DOUBLE, 6), round(sum(f1 * support) / sum(support)::DOUBLE, 6), CAST(sum(support) AS BIGINT) FROM s""",
    "accuracy_weighted_f1": f"""WITH {SCORES_CTE} SELECT round(CAST(sum(tp) AS DOUBLE) / CAST(sum(support) AS DOUBLE), 6) AS accuracy,
  round(sum(f1 * support) / CAST(sum(support) AS DOUBLE), 6) AS weighted_f1 FROM s""",
    "error_directions": f"WITH {CLASSES_CTE} SELECT actual_tier, predicted_tier, count(*) AS count FROM c WHERE actual_tier <> predicted_tier GROUP BY 1, 2",
    "model_comparison": f"{RESULTS_SQL} SELECT * FROM ranked",
    "best_model": f"{RESULTS_SQL} SELECT model_name, weighted_f1 FROM ranked WHERE place = 1",
    "comparison_verdict": f"""{RESULTS_SQL}, b AS (SELECT model_name AS best_model, weighted_f1 AS best_f1,
  (SELECT weighted_f1 FROM ranked WHERE model_name = 'Always low') AS baseline_f1 FROM ranked WHERE place = 1)
SELECT *, CASE WHEN best_model = 'Always low' THEN 'baseline is best' WHEN best_f1 > baseline_f1 THEN 'added inputs improve on the baseline'
  ELSE 'added inputs do not improve on the baseline' END AS verdict FROM b""",
    "run_span": f"""WITH {RUNS_CTE}, d AS (SELECT strptime(run_id, '%Y%m%d%H') AS t FROM runs)
SELECT strftime(min(t), '%Y-%m-%d %H:%M') AS first_run, strftime(max(t), '%Y-%m-%d %H:%M') AS latest_run,
  count(*) AS n_runs, date_diff('day', min(t), max(t)) AS days_spanned FROM d""",
    "trend_halves": TREND_SQL,
    "importance_pivot": f"WITH {IMPORTANCE_CTE} SELECT run_id, " + ", ".join(
        f"coalesce(max(importance) FILTER (feature = '{f}'), 0) AS {f}" for f in FEATURES) + " FROM imp GROUP BY 1",
    "top_features": f"""WITH {IMPORTANCE_CTE} SELECT feature, round(sum(importance) / (SELECT count(DISTINCT run_id) FROM imp), 6) AS avg_importance
  FROM imp GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""",
    "rank_stability": f"""WITH {IMPORTANCE_CTE}, r AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY importance DESC, feature) AS rank FROM imp),
g AS (SELECT feature, round_even(avg(rank), 1) AS avg_rank, round_even(stddev_samp(rank), 2) AS rank_std FROM r GROUP BY 1)
SELECT *, CASE WHEN rank_std < 1 THEN 'Stable' WHEN rank_std < 2 THEN 'Moderate' ELSE 'Volatile' END AS stability FROM g""",
    "param_usage": f"""WITH {RUNS_CTE} SELECT param, value, count(*) AS count FROM (
  SELECT 'max_depth' AS param, CAST(max_depth AS VARCHAR) AS value FROM runs UNION ALL SELECT 'n_estimators', CAST(n_estimators AS VARCHAR) FROM runs)
GROUP BY 1, 2""",
    "expand_struct": f"WITH {RUNS_CTE} SELECT run_id, train_rows, best_cv_mae, max_depth, n_estimators FROM runs",
    "cv_vs_holdout": f"WITH {RUNS_CTE} SELECT run_id, best_cv_mae, mae_today, round(mae_today - best_cv_mae, 6) AS gap FROM runs",
    "training_growth": f"""WITH {RUNS_CTE} SELECT run_id, train_rows, holdout_rows, train_rows + holdout_rows AS total_rows,
  round(holdout_rows / (train_rows + holdout_rows)::DOUBLE, 6) AS holdout_share FROM runs""",
}
