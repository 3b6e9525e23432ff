"""Splits, feature preparation, models.

Models are run on data whose answer SQL can state; everything else is fitted exactly.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ...operators import explain, features, models, quantiles, splits
from .aggregates import BAND_CTE, events_by_day, tier_sql, tiered_listings
from .common import derive, landed, table
from .fields import PARSED_CTE
from .relations import LATEST_SQL

# ---- tiers and splits -------------------------------------------------------


def _price_tier(spark, folder):
    o = table(spark, folder, "orders").withColumn("price_num", F.col("o_totalprice") / 4)
    banded = o.where("price_num > 500 and price_num < 100000")
    return splits.price_tier(banded).select("o_orderkey", "price_tier", "tier_warning")


def _exact_quantiles(spark, folder):
    probs = [0.0, 0.05, 1 / 3, 0.5, 2 / 3, 0.95, 1.0]
    # Few cells send even the small tables through many passes.
    values = quantiles.exact_quantiles(table(spark, folder, "lineitem"), "l_extendedprice", probs, cells=64)
    return spark.createDataFrame(list(enumerate(values)), "n bigint, value double").withColumn(
        "value", F.round("value", 4))


def _day_split(spark, folder):
    split = splits.day_split(events_by_day(spark, folder).withColumn(
        "price_num", F.when(F.col("event_type") != "error", F.col("value"))))
    train = split.train.select("event_id", F.lit("train").alias("part"))
    return train.unionByName(split.holdout.select("event_id", F.lit("holdout").alias("part")))


def _stratified_split(spark, folder):
    return splits.stratified_split(table(spark, folder, "documents"), "lang", "doc_id").select("doc_id", "lang", "split")


def _contiguous_folds(spark, folder):
    return splits.contiguous_folds(table(spark, folder, "orders"), ["o_orderdate", "o_orderkey"]).select(
        "o_orderkey", "fold")


# ---- imputation, scaling, encoding ------------------------------------------

GAPS = """SELECT p_partkey, CASE WHEN p_type <> 'ECONOMY' THEN CAST(p_size AS DOUBLE) END AS size,
  CASE WHEN p_size > 25 THEN p_retailprice END AS price, CASE WHEN p_size % 3 > 0 THEN p_brand END AS brand, p_type, p_name FROM {part}"""
G_CTE = f"g AS ({GAPS.format(part='part')})"


def gaps(spark, folder):
    return derive(spark, folder, GAPS, "part")


def _impute_median(spark, folder):
    g = gaps(spark, folder)
    return features.impute_median(g, g, ["size", "price"]).select("p_partkey", "size", "price")


def _impute_mode(spark, folder):
    g = gaps(spark, folder)
    return features.impute_mode(g.where("p_type = 'SMALL'"), g, ["brand"]).select("p_partkey", "brand")


def _standard_scale(spark, folder):
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    out = features.standard_scale(items, items, ["l_quantity", "l_tax"])
    return out.withColumns({c: F.round(c, 6) for c in ("l_quantity", "l_tax")})


def _label_encode(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    return features.label_encode(docs, docs, "lang")


def _one_hot(spark, folder):
    p = table(spark, folder, "part").select("p_partkey", "p_brand", "p_type")
    out = features.one_hot(p.where("p_type <> 'SMALL' and p_brand <> 'Brand#7'"), p, ["p_brand", "p_type"])
    return out.select("p_partkey", *[
        F.array_position(vector_to_array(f"{c}_vec"), F.lit(1.0)).alias(f"hot_{c}") for c in ("p_brand", "p_type")])


def _column_transform(spark, folder):
    g = gaps(spark, folder)
    out = features.column_transform(g, g, ["size", "price"], ["p_type"], scale=True)
    vector = vector_to_array("features")
    return out.select("p_partkey", F.round(vector[0], 6).alias("size"), F.round(vector[1], 6).alias("price"),
                      F.array_position(F.slice(vector, 3, 100), F.lit(1.0)).alias("hot"))


# ---- regression -------------------------------------------------------------

# A single tree of depth one on a two-valued feature predicts the mean of either group, which
# SQL can state. Larger fits are tested for what must hold.
STUMP = {"n_estimators": 1, "max_depth": 1, "min_samples_leaf": 1}
SIZED = """SELECT p_partkey, p_name, p_brand, p_retailprice, CASE WHEN p_size > 25 THEN 'big' ELSE 'small' END AS kind,
  CASE WHEN p_size > 25 THEN 1.0e0 ELSE 0.0e0 END AS big FROM {part}"""
S_CTE = f"s AS ({SIZED.format(part='part')})"


def sized_parts(spark, folder):
    return derive(spark, folder, SIZED, "part")


def stump(df, numeric, categorical, label="p_retailprice") -> PipelineModel:
    return models.price_pipeline(numeric, categorical, label, **STUMP).fit(df)


def _gbt_regressor(spark, folder):
    items = table(spark, folder, "lineitem")
    model = stump(items, [], ["l_linestatus"], "l_extendedprice")
    return model.transform(items).select("l_orderkey", "l_linenumber", F.round("prediction", 2).alias("prediction"))


def _predict(spark, folder):
    parts = sized_parts(spark, folder)
    return models.predict(stump(parts, ["big"], []), parts, "p_retailprice", ["p_partkey", "p_name", "color"]).drop("prediction")


def _grid_search(spark, folder):
    grid = {"n_estimators": [1], "max_depth": [1], "min_samples_leaf": [1, 2]}
    search = models.grid_search(sized_parts(spark, folder), ["p_partkey"], ["big"], [], "p_retailprice", grid)
    points = [(str({p.name: v for p, v in m.items()}), float(s))
              for m, s in zip(search.getEstimatorParamMaps(), search.avgMetrics)]
    return spark.createDataFrame(points, "params string, cv_mae double").withColumn("cv_mae", F.round("cv_mae", 6))


def _permutation_importance(spark, folder):
    """The kind adds far more to the price than anything else, so the tree uses nothing else."""
    parts = sized_parts(spark, folder).withColumn("price", F.col("p_retailprice") + F.col("big") * 1e6)
    model = stump(parts, [], ["kind", "p_brand"], "price")
    out = explain.permutation_importance(model, parts, ["kind", "p_brand"], "p_partkey", "price", repeats=3)
    return out.select("feature", (F.col("importance_mean") > 1000).alias("rises"), (F.abs("importance_mean") < 1e-6).alias("stays"))


def _shuffle_columns(spark, folder):
    """Permuting rows keeps the values of every column: sums per feature and repeat."""
    parts = table(spark, folder, "part")
    out = explain.shuffle_columns(parts, ["p_size", "p_brand"], "p_partkey", ["p_retailprice"], 2, 7)
    return out.groupBy("feature", "repeat").agg(
        F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("size"), F.countDistinct("p_partkey").alias("keys"),
        F.sum(F.length("p_brand")).cast("bigint").alias("brand"))


def _partial_dependence(spark, folder):
    parts = sized_parts(spark, folder)
    curves = [explain.partial_dependence(stump(parts, ["big"], []), parts, "big"),
              explain.partial_dependence(stump(parts, [], ["kind"]), parts, "kind")]
    return curves[0].unionByName(curves[1]).withColumn("avg_prediction", F.round("avg_prediction", 2))


# ---- classification ---------------------------------------------------------

def told_documents(spark, folder):
    """Whole texts with one word, said often, and one category that give the language away: every
    prediction is known. Models learn from the training part and predict all rows."""
    docs = table(spark, folder, "documents").withColumns({
        "text": F.concat("text", F.repeat(F.concat(F.lit(" tongue"), "lang"), 50)), "origin": F.concat(F.lit("from "), "lang")})
    return splits.stratified_split(docs, "lang", "doc_id")


def _text_classifier(spark, folder):
    docs = told_documents(spark, folder)
    model = models.text_classifier(docs.where("split = 'train'"), "lang", "text", max_iter=20)
    return model.transform(docs).select("doc_id", "lang", "predicted_tier")


def _structured_classifier(spark, folder):
    # The modeling table is a written table, as in a deployment; models read it many times.
    path = landed(spark, folder, "modeling-table", lambda p: tiered_listings(spark, folder).write.parquet(p))
    tiers = spark.read.parquet(path).withColumns({
        "year_num": F.col("year").cast("double"), "mileage_num": F.col("mileage").cast("double"),
        "told": F.concat(F.lit("is "), "price_tier")})
    split = splits.stratified_split(tiers, "price_tier", "post_id")
    model = models.structured_classifier(
        split.where("split = 'train'"), numeric=["year_num", "mileage_num"],
        categorical=["make", "model", "transmission", "drivetrain", "fuel_type", "told"], max_iter=10)
    return model.transform(split).select("post_id", "price_tier", "predicted_tier")


def _fused_classifier(spark, folder):
    docs = told_documents(spark, folder)
    model = models.fused_classifier(docs.where("split = 'train'"), "lang", "text", ["n_chars"], ["source", "origin"], max_iter=20)
    return model.transform(docs).select("doc_id", "lang", "predicted_tier")


QUERIES = {
    "price_tier": _price_tier, "exact_quantiles": _exact_quantiles, "day_split": _day_split,
    "stratified_split": _stratified_split, "contiguous_folds": _contiguous_folds,
    "impute_median": _impute_median, "impute_mode": _impute_mode, "standard_scale": _standard_scale,
    "label_encode": _label_encode, "one_hot": _one_hot, "column_transform": _column_transform,
    "gbt_regressor": _gbt_regressor, "predict": _predict, "grid_search": _grid_search,
    "permutation_importance": _permutation_importance, "shuffle_columns": _shuffle_columns,
    "partial_dependence": _partial_dependence, "text_classifier": _text_classifier,
    "structured_classifier": _structured_classifier, "fused_classifier": _fused_classifier,
}

ORACLES = {
    "gbt_regressor": "SELECT l_orderkey, l_linenumber, round(avg(l_extendedprice) OVER (PARTITION BY l_linestatus), 2) AS prediction FROM lineitem",
    "predict": f"""WITH {S_CTE} SELECT p_partkey, p_name, p_retailprice AS actual_price,
  round(avg(p_retailprice) OVER (PARTITION BY kind), 2) AS pred_price FROM s""",
    "grid_search": f"""WITH {S_CTE}, p AS (SELECT *, row_number() OVER (ORDER BY p_partkey) - 1 AS i, count(*) OVER () AS n FROM s),
f AS (SELECT *, CASE WHEN i < (n % 3) * (n // 3 + 1) THEN i // (n // 3 + 1) ELSE n % 3 + (i - (n % 3) * (n // 3 + 1)) // (n // 3) END AS fold FROM p),
m AS (SELECT h.fold, h.kind, avg(t.p_retailprice) AS mean FROM (SELECT DISTINCT fold, kind FROM f) h JOIN f t ON t.kind = h.kind AND t.fold <> h.fold GROUP BY 1, 2),
e AS (SELECT fold, avg(abs(p_retailprice - mean)) AS mae FROM f JOIN m USING (fold, kind) GROUP BY 1),
g AS (SELECT unnest([1, 2]) AS leaf)
SELECT '{{''maxIter'': 1, ''maxDepth'': 1, ''minInstancesPerNode'': ' || leaf || '}}' AS params, round(avg(mae), 6) AS cv_mae FROM g, e GROUP BY leaf""",
    "permutation_importance": "SELECT * FROM (VALUES ('kind', true, false), ('p_brand', false, true)) v(feature, rises, stays)",
    "partial_dependence": f"""WITH {S_CTE} SELECT 'kind' AS feature, kind AS value, round(avg(p_retailprice), 2) AS avg_prediction FROM s GROUP BY 2
UNION ALL SELECT 'big', CASE WHEN big = 1 THEN '1.0' ELSE '0.0' END, round(avg(p_retailprice), 2) FROM s GROUP BY big""",
    "text_classifier": "SELECT doc_id, lang, lang AS predicted_tier FROM documents",
    "fused_classifier": "SELECT doc_id, lang, lang AS predicted_tier FROM documents",
    "structured_classifier": f"""WITH {PARSED_CTE}, {LATEST_SQL.format(src='p', path='source_txt')},
f AS (SELECT post_id, CAST(price AS DOUBLE) AS price_num FROM latest WHERE price > 500 AND price < 100000), {tier_sql('f', 'price_num')}
SELECT post_id, price_tier, price_tier AS predicted_tier FROM t""",
    "price_tier": f"WITH {BAND_CTE}, {tier_sql('b', 'price_num')} SELECT o_orderkey, price_tier, false AS tier_warning FROM t",
    "exact_quantiles": """WITH p AS (SELECT unnest([0, 1, 2, 3, 4, 5, 6]) AS n), q AS (
  SELECT quantile_cont(l_extendedprice, [0.0, 0.05, 1.0/3, 0.5, 2.0/3, 0.95, 1.0]) AS v FROM lineitem)
SELECT CAST(n AS BIGINT) AS n, round(v[n + 1], 4) AS value FROM p, q""",
    "day_split": """WITH m AS (SELECT max(CAST(ts AS DATE)) AS m FROM events)
SELECT event_id, CASE WHEN CAST(ts AS DATE) = m THEN 'holdout' ELSE 'train' END AS part FROM events, m
WHERE CAST(ts AS DATE) = m OR (event_type <> 'error' AND value IS NOT NULL)""",
    "stratified_split": """WITH s AS (SELECT lang, count(*) AS size, ceil(0.2::DOUBLE * (SELECT count(*) FROM documents))::BIGINT AS n_test,
  (SELECT count(*) FROM documents) AS total FROM documents GROUP BY 1),
b AS (SELECT *, (n_test * size) // total AS base, (n_test * size) % total AS rest FROM s),
k AS (SELECT lang, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, lang) <= n_test - sum(base) OVER () THEN 1 ELSE 0 END AS take FROM b),
r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR) || ':42')) AS rn FROM documents)
SELECT doc_id, lang, CASE WHEN rn <= take THEN 'test' ELSE 'train' END AS split FROM r JOIN k USING (lang)""",
    "contiguous_folds": """WITH p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CAST(CASE WHEN i < (n % 3) * (n // 3 + 1) THEN i // (n // 3 + 1)
  ELSE n % 3 + (i - (n % 3) * (n // 3 + 1)) // (n // 3) END AS INTEGER) AS fold FROM p""",
    "impute_median": f"""WITH {G_CTE} SELECT p_partkey, coalesce(size, (SELECT quantile_cont(size, 0.5) FROM g)) AS size,
  coalesce(price, (SELECT quantile_cont(price, 0.5) FROM g)) AS price FROM g""",
    "impute_mode": f"""WITH {G_CTE} SELECT p_partkey, coalesce(brand, (SELECT brand FROM g WHERE p_type = 'SMALL' AND brand IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, brand LIMIT 1)) AS brand FROM g""",
    "standard_scale": """WITH m AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_tax) AS mt, stddev_pop(l_tax) AS st FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_quantity - mq) / sq, 6) AS l_quantity, round((l_tax - mt) / st, 6) AS l_tax FROM lineitem, m""",
    "label_encode": "SELECT doc_id, lang, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS DOUBLE) AS label FROM documents",
    "one_hot": """WITH t AS (SELECT * FROM part WHERE p_type <> 'SMALL' AND p_brand <> 'Brand#7'),
b AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) AS i FROM (SELECT DISTINCT p_brand FROM t)),
y AS (SELECT p_type, row_number() OVER (ORDER BY p_type) AS j FROM (SELECT DISTINCT p_type FROM t))
SELECT p_partkey, coalesce(i, 0) AS hot_p_brand, coalesce(j, 0) AS hot_p_type FROM part LEFT JOIN b USING (p_brand) LEFT JOIN y USING (p_type)""",
    "column_transform": f"""WITH {G_CTE}, f AS (SELECT p_partkey, p_type, coalesce(size, (SELECT quantile_cont(size, 0.5) FROM g)) AS size,
  coalesce(price, (SELECT quantile_cont(price, 0.5) FROM g)) AS price FROM g)
SELECT p_partkey, round((size - avg(size) OVER ()) / stddev_pop(size) OVER (), 6) AS size,
  round((price - avg(price) OVER ()) / stddev_pop(price) OVER (), 6) AS price, dense_rank() OVER (ORDER BY p_type) AS hot FROM f""",
    "shuffle_columns": """WITH a AS (SELECT count(*) AS n, CAST(sum(p_size) AS BIGINT) AS size, count(*) AS keys, CAST(sum(length(p_brand)) AS BIGINT) AS brand FROM part)
SELECT feature, CAST(repeat AS INTEGER) AS repeat, n, size, keys, brand FROM a, (VALUES ('', 0), ('p_size', 1), ('p_size', 2), ('p_brand', 1), ('p_brand', 2)) v(feature, repeat)""",
}
