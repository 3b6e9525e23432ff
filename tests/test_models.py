"""Models on a table whose answer is known."""

import pytest
from pyspark.sql import functions as F

from adledger.operators import explain, features, models, splits
from adledger.plans.jobs import explain_top, modeling_table, tier_study, train_and_score, training_rows

SMALL_GRID = {"n_estimators": [5], "max_depth": [3], "learning_rate": [0.3], "min_samples_leaf": [1]}


@pytest.fixture(scope="module")
def cars(spark):
    """Price follows the year and the make; color never matters; nobody knows the title."""
    k = F.col("id")
    return spark.range(400).select(
        k.cast("string").alias("post_id"),
        F.format_string("2026-04-%02dT15:00:00Z", (k % 4 + 1).cast("int")).alias("scraped_at"),
        F.format_string("$%d", (2000 + (k % 20) * 500 + F.when(k % 2 == 0, 3000).otherwise(0)).cast("int")).alias("price"),
        (F.lit(2000) + k % 20).cast("string").alias("year"), F.when(k % 2 == 0, "Bmw").otherwise("Ford").alias("make"),
        F.when(k % 7 > 0, F.concat(F.lit("m"), (k % 3).cast("string"))).alias("model"), (k * 10).cast("string").alias("mileage"),
        F.lit("4").alias("engine_cylinders"), F.lit("red").alias("color"), F.lit(None).cast("string").alias("title_status"),
        *[F.lit("x").alias(c) for c in ("transmission", "drivetrain", "fuel_type", "condition", "body_type")],
        F.concat(F.lit("nice "), F.when(k % 20 < 7, "old").when(k % 20 < 14, "fair").otherwise("fresh")).alias("combined_text"))


def test_train_and_score(spark, cars, tmp_path):
    result = train_and_score(cars, grid=SMALL_GRID, repeats=3, path=str(tmp_path), run_hour="2026040408")
    assert result.status == "ok" and result.summary["train_rows"] == 300 and result.summary["holdout_rows"] == 100
    row = result.metrics.first()
    assert row.today_local == "2026-04-04" and row.mae_today < 1500 and row.best_params["model__max_depth"] == 3
    importance = {r.feature: r.importance_mean for r in result.importance.collect()}
    assert len(importance) == 12 and importance["color"] == pytest.approx(0, abs=1e-9)
    assert importance["title_status"] == pytest.approx(0, abs=1e-9)
    assert max(importance, key=importance.get) in ("year_num", "make")
    preds = result.predictions
    assert preds.count() == 100 and "image_url" not in preds.columns
    assert preds.where("pred_price <> round(pred_price, 2)").count() == 0
    split = splits.day_split(training_rows(cars))
    curves = explain_top(result, split.train, split.holdout)
    assert curves.select("feature").distinct().count() == 3


def test_no_op(cars):
    one_day = cars.where("scraped_at like '2026-04-01%'")
    assert train_and_score(one_day, grid=SMALL_GRID).status == "noop"
    with pytest.raises(ValueError, match="engine_cylinders"):
        train_and_score(cars.drop("engine_cylinders"))


@pytest.fixture(scope="module")
def fitted(cars):
    rows = training_rows(cars)
    return models.price_pipeline(["year_num", "mileage_num"], ["make", "model"], **{
        "n_estimators": 5, "max_depth": 3, "learning_rate": 0.3, "min_samples_leaf": 1}).fit(rows), rows


def test_partial_dependence(fitted):
    model, rows = fitted
    make = {r.value: r.avg_prediction for r in explain.partial_dependence(model, rows, "make").collect()}
    assert set(make) == {"Bmw", "Ford"} and make["Bmw"] > make["Ford"]
    year = explain.partial_dependence(model, rows, "year_num")
    assert year.count() == 20
    assert explain.partial_dependence(model, rows, "mileage_num").count() == 100
    # A value the model never saw, and a missing one, count like any unseen value.
    odd = rows.withColumn("model", F.when(F.col("model") == "m0", "other").otherwise(F.col("model")))
    curve = {r.value: r.avg_prediction for r in explain.partial_dependence(model, odd, "model").collect()}
    assert set(curve) == {"other", "m1", "m2", "unknown"} and curve["other"] == curve["unknown"]


def test_partial_dependence_equals_brute_force(fitted):
    model, rows = fitted
    got = {r.value: r.avg_prediction for r in explain.partial_dependence(model, rows, "make").collect()}
    want = model.transform(rows.withColumn("make", F.lit("Ford"))).agg(F.avg("prediction")).first()[0]
    assert got["Ford"] == pytest.approx(want)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000, 4099])
def test_keyed_permutation(spark, n):
    """Every position is taken once under every key, and keys differ."""
    df = spark.range(n).select("id", F.explode(F.array(*map(F.lit, range(4)))).alias("k"))
    got = df.select("id", "k", explain.permuted(F.col("id"), n, F.col("k"), F.lit(9)).alias("to")).collect()
    moved = [[r["to"] for r in sorted((r for r in got if r["k"] == k), key=lambda r: r["id"])] for k in range(4)]
    assert all(sorted(m) == list(range(n)) for m in moved)
    if n > 60:
        assert len({tuple(m) for m in moved}) == 4
        assert all(sum(abs(a - b) > n / 4 for a, b in enumerate(m)) > n / 4 for m in moved)  # far moves


def test_shuffle_is_a_permutation(cars):
    rows = cars.select("post_id", "make", F.col("mileage").cast("int").alias("mileage"))
    out = explain.shuffle_columns(rows, ["make", "mileage"], "post_id", [], 2, 1).persist()
    assert out.count() == 400 * 5
    same = out.join(rows.withColumnRenamed("mileage", "own").drop("make"), "post_id")
    kept = {(r.feature, r.repeat): (r.n, r.total, r.same) for r in same.groupBy("feature", "repeat").agg(
        F.count("*").alias("n"), F.sum("mileage").alias("total"), F.count_if(F.col("own") == F.col("mileage")).alias("same")).collect()}
    total = 10 * sum(range(400))
    assert all(v[:2] == (400, total) for v in kept.values())
    assert kept[("", 0)][2] == 400 and kept[("make", 1)][2] == 400
    assert kept[("mileage", 1)][2] < 80
    out.unpersist()


def test_permutation_importance_equals_brute_force(spark, fitted):
    """The rise of the error computed row by row from the permutation itself."""
    model, rows = fitted
    rows = rows.where("price_num IS NOT NULL")
    got = {r.feature: r.importance_mean for r in explain.permutation_importance(model, rows, ["make", "year_num"], repeats=2, seed=5).collect()}
    table = rows.select("post_id", "make", "year_num", "model", "mileage_num", "price_num").toPandas().sort_values("post_id").reset_index(drop=True)
    n = len(table)
    places = spark.range(n).select("id", *[explain.permuted(F.col("id"), n, F.lit(r), F.lit(5)).alias(f"to{r}") for r in (1, 2)]).toPandas().sort_values("id")
    mae = lambda t: model.transform(spark.createDataFrame(t)).agg(F.avg(F.abs(F.col("prediction") - F.col("price_num")))).first()[0]
    base = mae(table)
    for feature in ("make", "year_num"):
        rises = []
        for r in (1, 2):
            shuffled = table.copy()
            shuffled.loc[places[f"to{r}"].to_numpy(), feature] = table[feature].to_numpy()
            rises.append(mae(shuffled) - base)
        assert got[feature] == pytest.approx(sum(rises) / 2)


def test_tier_study(spark, cars):
    table = modeling_table(cars.withColumn("price", F.regexp_replace("price", r"\$", "")))
    assert {"vehicle_age", "miles_per_year", "engine_cylinders_num"} <= set(table.columns)
    study = tier_study(table, max_iter=20)
    scores = {r.model_name: r.weighted_f1 for r in study["comparison"].collect()}
    assert set(scores) == {"Structured", "Text", "Structured + Text"} and scores["Structured + Text"] > 0.6
    assert study["predictions"].count() == 80
    assert "text_excerpt" in study["errors"].columns and study["verdict"].count() == 1


def test_dense_network(cars):
    table = modeling_table(cars.withColumn("price", F.regexp_replace("price", r"\$", "")))
    model = models.structured_classifier(table, numeric=["year_num"], categorical=["make"], hidden=[8], max_iter=100)
    out = model.transform(table)
    assert out.where("predicted_tier = price_tier").count() > 300


def test_saved_models_predict_alike(spark, cars, fitted, tmp_path):
    model, rows = fitted
    models.save_stages(model, str(tmp_path / "price"))
    again, _ = models.load_stages(spark, str(tmp_path / "price"))
    both = [sorted((r.post_id, r.prediction) for r in m.transform(rows).select("post_id", "prediction").collect()) for m in (model, again)]
    assert both[0] == both[1]
    tiers = modeling_table(cars.withColumn("price", F.regexp_replace("price", r"\$", "")))
    classifier = models.fused_classifier(tiers, numeric=["year_num"], categorical=["make"], max_iter=5)
    classifier.save(str(tmp_path / "tier"))
    loaded = models.TierClassifier.load(spark, str(tmp_path / "tier"))
    found = [sorted((r.post_id, r.predicted_tier) for r in m.transform(tiers).select("post_id", "predicted_tier").collect()) for m in (classifier, loaded)]
    assert found[0] == found[1]


def test_tree_counts_share_one_run(cars, monkeypatch):
    """Half as many fits as points and folds; every score is that of a model of its own size."""
    rows = training_rows(cars)
    fits, real = [], models.boost
    monkeypatch.setattr(models, "boost", lambda gbt, df, point: fits.append(point) or real(gbt, df, point))
    grid = {"n_estimators": [2, 5], "max_depth": [2], "min_samples_leaf": [1, 30], "learning_rate": [0.3]}
    search = models.grid_search(rows, ["post_id"], ["year_num"], ["make"], grid=grid, folds=2)
    assert len(fits) == 2 * 2 and all(max(p.values()) >= 5 for p in fits)
    folded = splits.contiguous_folds(rows, ["post_id"], 2, "k")
    for point, score in zip(search.getEstimatorParamMaps(), search.avgMetrics):
        alone = []
        for k in range(2):
            own = {grid_name: v for p, v in point.items() for grid_name, name in models.GBT_PARAMS.items() if name == p.name}
            fitted = models.price_pipeline(["year_num"], ["make"], **own).fit(folded.where(F.col("k") != k))
            alone.append(fitted.transform(folded.where(F.col("k") == k)).agg(F.avg(F.abs(F.col("prediction") - F.col("price_num")))).first()[0])
        assert score == pytest.approx(sum(alone) / 2)
    assert len({round(s, 6) for s in search.avgMetrics}) > 2


def test_short_vectors_equal_long_ones(cars, monkeypatch):
    """Short vectors are made by array functions alone, long ones from JSON; unseen and missing
    categories are zeros, or the mode, in both."""
    rows = training_rows(cars)
    prepared = features.ColumnTransform(["year_num", "mileage_num"], ["make", "model"]).fit(rows)
    odd = rows.withColumn("make", F.when(F.col("post_id").cast("long") % 3 == 0, "unseen").when(F.col("post_id").cast("long") % 3 == 1, F.col("make")))
    found = []
    for limit, by_json in ((features.SHORT, False), (0, True)):
        monkeypatch.setattr(features, "SHORT", limit)
        out = prepared.transform(odd)
        assert ("json" in out._jdf.queryExecution().optimizedPlan().toString().lower()) == by_json
        found.append({r.post_id: r.features.toArray().tolist() for r in out.select("post_id", "features").collect()})
    assert found[0] == found[1] and len(found[0]) == rows.count()
    assert {len(v) for v in found[0].values()} == {prepared.width} and {sum(v[2:]) for v in found[0].values()} == {1.0, 2.0}


def test_passes_read_parsed_rows(cars):
    """Days and numbers are read from text once, vectors of the refit are made once."""
    result = train_and_score(cars, grid={"n_estimators": [2], "max_depth": [2]}, repeats=1)
    plan = result.predictions._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan.lower() and "price_num" in plan
    assert result.metrics.first().holdout_rows == result.predictions.count()
