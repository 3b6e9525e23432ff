"""Filters, dedup, joins, splits, quantiles, metrics, trends."""

import math
import random
import statistics
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from adledger.operators import dedup, dictionary, features, filters, joins, metrics, ordering, quantiles, sets, splits, summaries, trends
from adledger.schemas import LISTING_COLUMNS, table_schema

A, B, C = "20251026170002", "20251026T180002Z", "20251027000000"


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# ---- filters ----------------------------------------------------------------

def test_price_band(frame):
    df = frame("price_num double", [(500.0,), (500.01,), (99999.99,), (100000.0,), (None,), (float("nan"),)])
    assert values(filters.price_band_filter(df), "price_num") == [(500.01,), (99999.99,)]


def test_derived_columns(frame):
    df = frame("year_num double, mileage_num double", [(2026.0, 10.0), (2016.0, 50.0), (None, 5.0)])
    assert values(filters.derived_columns(df), "vehicle_age", "miles_per_year") == [(0.0, None), (10.0, 5.0), (None, None)]
    assert filters.derived_columns(df.drop("year_num")).columns == ["mileage_num"]


def test_columns(frame):
    df = frame("post_id string, Image_URL string, v int", [("1", None, 1)])
    assert filters.missing_columns(df, ["v", "b", "a"]) == ["a", "b"]
    assert filters.columns_like(df) == ["Image_URL"]
    assert values(filters.columns_like_counts(df), "column_name", "non_null") == [("Image_URL", 0)]
    assert filters.columns_like_counts(df.select("v")).count() == 0
    conformed = filters.conform(df.withColumn("price", F.lit("x")), table_schema(LISTING_COLUMNS))
    assert conformed.columns == LISTING_COLUMNS and conformed.first().price is None


def test_newest_and_recent_runs(frame):
    df = frame("run_id string", [(A,), (B,), (C,), (A,)])
    assert values(filters.newest_run(df), "run_id") == [(C,)]
    mixed = frame("run_id string", [("20251026170002",), ("20251026T080000Z",)])
    assert values(filters.newest_run(mixed), "run_id") == [("20251026T080000Z",)]  # order of text, not of time
    assert sorted(values(filters.recent_runs(df, 2), "run_id")) == sorted([(C,), (B,)])


# ---- dedup ------------------------------------------------------------------

def test_latest_by_key(frame):
    rows = [("1", A, "a"), ("1", C, "b"), ("1", B, "c"), ("2", C, "z"), ("2", C, "y"), (None, A, "n"), ("", A, "e"),
            ("3", "zz", "q"), ("3", C, "r")]
    df = frame("post_id string, run_id string, source_txt string", rows)
    assert sorted(values(dedup.latest_by_key(df), "post_id", "source_txt")) == [("1", "b"), ("2", "y"), ("3", "q")]
    oldest = dedup.latest_by_key(df, invalid_run="oldest")
    assert ("3", "r") in values(oldest, "post_id", "source_txt")


def test_hot_key_shrinks_before_the_shuffle(spark):
    df = spark.range(100000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("post_id"),
        F.lit(A).alias("run_id"), F.col("id").cast("string").alias("source_txt"))
    out = dedup.latest_by_key(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert out.count() == 66666 + 1


def test_first_by_key_capped(frame):
    df = frame("post_id string, url string, pos int", [("a", "u1", 1), ("a", "u2", 2), ("b", "u3", 3), ("c", "u4", 4), ("", "x", 0)])
    assert values(dedup.first_by_key_capped(df, "post_id", ["pos"], 2), "post_id", "url") == [("a", "u1"), ("b", "u3")]
    assert dedup.first_by_key_capped(df, "post_id", ["pos"], None).count() == 3


@pytest.mark.parametrize("block_rows", [1, 3, 4096])
@pytest.mark.parametrize("start", [0, 1])
def test_adjacent_dedup_over_blocks(spark, block_rows, start):
    rng = random.Random(block_rows)
    rows = [(g, i + start, rng.choice(["a", "b", None])) for g in range(3) for i in range(50)]
    df = spark.createDataFrame(rows, "g int, p int, v string")
    got = sorted(values(dedup.adjacent_dedup(df, "g", "p", "v", block_rows), "g", "p"))
    want = sorted((g, p) for k, (g, p, v) in enumerate(rows) if p == start or rows[k - 1][2] != v)
    assert got == want


# ---- joins ------------------------------------------------------------------

def test_backfill(frame):
    raw = frame("path string, text string", [("a/1.txt", "Price: 5\nNICE car"), ("gs://other/2.txt", "Two")])
    df = frame("post_id string, combined_text string, source_txt string", [
        ("1", None, "/a/1.txt"), ("2", "", "gs://other/2.txt"), ("3", "kept", "a/1.txt"), ("4", None, "gone"), ("5", "", None)])
    got = {r.post_id: (r.combined_text, r.combined_text_len, r.has_combined_text)
           for r in joins.backfill_text(df, raw, "main").collect()}
    assert got == {"1": ("nice car", 8, True), "2": ("two", 3, True), "3": ("kept", 4, True), "4": ("", 0, False),
                   "5": ("", 0, False)}


def test_record_to_source(frame):
    raw = frame("path string, text string", [("p1", "one")])
    df = frame("post_id string, source_txt string", [("1", "p1"), ("", "p1"), ("2", None), ("3", "p9")])
    assert sorted((r.post_id, r.raw_text, r.error) for r in joins.record_to_source(df, raw).collect()) == sorted([
        ("1", "one", None), ("", None, "missing post_id"), ("2", None, "missing source_txt"), ("3", None, "source text not found")],
    )


# ---- quantiles and splits ---------------------------------------------------

@pytest.mark.parametrize("shape", ["uniform", "hot", "three", "two", "negative"])
def test_exact_quantiles_by_selection(spark, shape):
    rng = np.random.default_rng(3)
    data = {
        "uniform": rng.uniform(0, 1e6, 20000), "hot": np.where(rng.random(20000) < 0.4, 7.0, rng.normal(7, 3, 20000)),
        "three": rng.choice([1.0, 2.0, 3.0], 20000), "two": np.array([1.0, 2.0] * 10000), "negative": -rng.exponential(5, 20000),
    }[shape]
    df = spark.createDataFrame([(float(x),) for x in data] + [(None,), (float("nan"),)], "v double").repartition(8)
    probs = [0, 0.05, 1 / 3, 0.5, 2 / 3, 0.95, 1]
    got = quantiles.exact_quantiles(df, "v", probs, cells=16)
    assert got == pytest.approx(list(np.quantile(data, probs)), rel=1e-12)
    assert quantiles.exact_quantiles(df, "v", probs) == pytest.approx(got, rel=1e-12)


def test_quantiles_settle_every_bit(spark, monkeypatch):
    """Values of all exponents, neighbours, both zeros and infinities; never more passes than the bits need."""
    r, edges = random.Random(1), [2.0**k for k in range(-1074, 1024, 7)]
    data = [0.0, -0.0, math.inf, -math.inf, 5e-324, -5e-324, 1.7976931348623157e308, *edges, *(-x for x in edges), *(math.nextafter(x, 0) for x in edges),
            *(math.nextafter(x, math.inf) for x in edges), *(x for x in (struct.unpack("<d", r.randbytes(8))[0] for _ in range(3000)) if x == x)]
    df = spark.createDataFrame([(x,) for x in data], "v double").repartition(4)
    passes, real = [], quantiles._counted
    monkeypatch.setattr(quantiles, "_counted", lambda *a: passes.append(1) or real(*a))
    probs = [i / 50 for i in range(51)]
    got = quantiles.exact_quantiles(df, "v", [round(p * (len(data) - 1)) / (len(data) - 1) for p in probs])
    want = [sorted(data)[round(p * (len(data) - 1))] for p in probs]
    assert [g == w or abs(g - w) <= 1e-12 * abs(w) for g, w in zip(got, want)] == [True] * 51 and len(passes) <= 7
    ends = quantiles._select(df.where("abs(v) < double('infinity')"), {"v": quantiles._Range("v", min(x for x in data if x > -math.inf), max(x for x in data if x < math.inf), 0)},
                             [("v", k) for k in range(0, 3000, 211)], 8)
    inner = sorted(x for x in data if abs(x) < math.inf)
    assert all(ends["v", k] == inner[k] for k in range(0, 3000, 211))


def test_one_value_a_third_of_all_rows(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") / 7.0).alias("a"), (F.col("id") % 2).alias("b"))
    got = quantiles.quantiles_of(df, ["a", "b"], [0.25, 0.5])
    rows = df.toPandas()
    assert got == {c: pytest.approx(list(np.quantile(rows[c], [0.25, 0.5]))) for c in ("a", "b")}


def test_quantiles_of_nothing(frame):
    assert quantiles.exact_quantiles(frame("v double", [(None,)]), "v", [0.5]) == [None]


def test_price_tier(frame):
    df = frame("price_num double", [(1.0,), (2.0,), (5.0,), (9.0,), (20.0,), (None,)])
    assert [r.price_tier for r in splits.price_tier(df).collect()] == ["low", "low", "medium", "high", "high", None]
    same = splits.price_tier(frame("price_num double", [(1.0,)] * 4)).collect()
    assert {(r.price_tier, r.tier_warning) for r in same} == {("low", True)}


def test_day_split(frame):
    rows = [("2026-04-03", 1.0)] * 40 + [("2026-04-02", None)] * 3 + [("2026-04-04", None), ("2026-04-04", 5.0)]
    split = splits.day_split(frame("date_local string, price_num double", rows))
    assert split.status == "ok" and split.last_day == "2026-04-04"
    assert split.train.count() == 40 and split.holdout.count() == 2
    assert split.stats["dropped_for_target"] == 3 and split.stats["valid_price_rows"] == 41
    few = splits.day_split(frame("date_local string, price_num double", rows[1:]))
    assert (few.status, few.reason, few.stats["train_rows"]) == ("noop", "too few training rows", 39)
    assert splits.day_split(frame("date_local string, price_num double", rows[:5])).reason == "need at least two distinct dates"


def test_stratified_split(spark):
    df = spark.range(30).select("id", (F.col("id") % 3).cast("string").alias("tier"))
    out = splits.stratified_split(df, "tier", "id")
    first = sorted(values(out, "id", "split"))
    assert sorted(values(out.groupBy("tier", "split").count(), "tier", "split", "count")) == sorted(
        (t, s, n) for t in "012" for s, n in (("test", 2), ("train", 8)))
    assert sorted(values(splits.stratified_split(df.repartition(5), "tier", "id"), "id", "split")) == first


def test_stratified_split_keeps_equal_keys_together_and_every_row(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id"), F.lit("x").alias("tier"))
    out = splits.stratified_split(df, "tier", "id")
    assert out.count() == 9000
    assert out.groupBy("id").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 10, 11, 100])
def test_contiguous_folds(spark, n):
    df = spark.range(n).select(F.reverse(F.col("id").cast("string")).alias("k"), "id")
    got = [r.fold for r in splits.contiguous_folds(df, ["k", "id"]).orderBy("k", "id").collect()]
    sizes = [n // 3 + (i < n % 3) for i in range(3)]
    assert got == [i for i, size in enumerate(sizes) for _ in range(size)]


def test_seeded_sample(frame):
    df = frame("post_id string", [(str(i),) for i in range(20)])
    picked = values(ordering.seeded_sample(df), "post_id")
    assert len(picked) == 6 and picked == values(ordering.seeded_sample(df.repartition(3)), "post_id")
    assert ordering.seeded_sample(df.limit(2)).count() == 2


# ---- features ---------------------------------------------------------------

def test_imputation_and_scaling(frame):
    df = frame("x double, c string", [(1.0, "b"), (2.0, "a"), (3.0, "b"), (10.0, "a"), (None, None)])
    assert [r.x for r in features.impute_median(df, df, ["x"]).collect()][-1] == 2.5
    assert [r.c for r in features.impute_mode(df, df, ["c"]).collect()][-1] == "a"
    scaled = [r.x for r in features.standard_scale(df.na.drop(), df, ["x"]).collect()]
    mean, std = 4.0, statistics.pstdev([1, 2, 3, 10])
    assert scaled[0] == pytest.approx((1 - mean) / std) and scaled[-1] is None
    constant = frame("x double", [(5.0,), (5.0,)])
    assert [r.x for r in features.standard_scale(constant, constant, ["x"]).collect()] == [0.0, 0.0]


def test_encoding(frame):
    df = frame("tier string", [("low",), ("medium",), ("high",)])
    assert values(features.label_encode(df, df, "tier"), "tier", "label") == [("low", 1.0), ("medium", 2.0), ("high", 0.0)]
    train, test = frame("c string", [("a",), ("b",)]), frame("c string", [("b",), ("new",)])
    assert [list(r.c_vec.toArray()) for r in features.one_hot(train, test, ["c"]).collect()] == [[0.0, 1.0], [0.0, 0.0]]


def test_dictionary_of_many_categories(spark):
    """Numbered alphabetically over many partitions; the list never reaches the driver."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(120000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.sha2(F.col("id").cast("string"), 256)).alias("a"), (F.col("id") % 7).alias("b"))
        known = dictionary.fit_dictionary(df, ["a", "b", "c"][:2])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert known.sizes == {"a": 80001, "b": 7}
    for column in ("a", "b"):
        rows = [(r["value"], r["ordinal"]) for r in known.of(column).collect()]
        assert [v for v, _ in sorted(rows, key=lambda r: r[1])] == sorted(v for v, _ in rows) and sorted(o for _, o in rows) == list(range(len(rows)))
    assert known.values("b", [0, 6]) == ["0", "6"] and known.values("a", []) == []
    out = features.one_hot(df, df.limit(10).unionByName(spark.createDataFrame([("new", None)], "a string, b long")), ["a", "b"])
    assert {(r["a_vec"].size, len(r["a_vec"].indices)) for r in out.collect()} == {(80001, 1), (80001, 0)}


def test_odd_categories(frame):
    train = frame("c string, n int", [("é", 1), ('q"\\', 2), ("", 3), (None, None), ("é", 1)])
    out = {r["c"]: (list(r["c_vec"].toArray()), list(r["n_vec"].toArray())) for r in features.one_hot(train, train, ["c", "n"]).collect()}
    assert out == {"": ([1, 0, 0], [0, 0, 1]), 'q"\\': ([0, 1, 0], [0, 1, 0]), "é": ([0, 0, 1], [1, 0, 0]), None: ([0, 0, 0], [0, 0, 0])}
    nothing = frame("c string", [(None,)])
    assert [r["c_vec"].size for r in features.one_hot(nothing, nothing, ["c"]).collect()] == [0]


def test_column_transform_drops_empty_columns(frame):
    df = frame("x double, y double, c string, d string", [(1.0, None, "a", None), (3.0, None, "b", None)])
    model = features.ColumnTransform(["x", "y"], ["c", "d"]).fit(df)
    out = model.transform(df.withColumn("x", F.lit(None).cast("double")))
    assert [list(r.features.toArray()) for r in out.collect()] == [[2.0, 1.0, 0.0], [2.0, 0.0, 1.0]]
    assert out.columns == ["x", "y", "c", "d", "features"] and out.first().x is None


# ---- metrics and trends -----------------------------------------------------

def test_regression_metrics(frame):
    df = frame("actual_price double, pred_price double", [(10.0, 12.0), (0.0, 4.0), (None, 5.0)])
    row = metrics.regression_metrics(df).first()
    assert (row.mae, row.bias, row.mape, row.n_scored, row.n_zero_actual) == (3.0, 3.0, 20.0, 2, 1)
    assert row.rmse == pytest.approx(10 ** 0.5)
    none = metrics.regression_metrics(df.where("actual_price is null")).first()
    assert (none.mae, none.rmse, none.mape, none.bias) == (None, None, None, None)


def test_classification(frame):
    rows = [("low", "low")] * 3 + [("low", "medium")] + [("medium", "medium")] * 2 + [("high", "low")]
    df = frame("actual_tier string, predicted_tier string", rows)
    assert values(metrics.confusion_matrix(df), "actual", "pred_low", "pred_medium", "pred_high") == [
        ("low", 3, 1, 0), ("medium", 0, 2, 0), ("high", 1, 0, 0)]
    report = {r.label: r for r in metrics.classification_report(df).collect()}
    assert (report["high"].precision, report["high"].recall, report["high"].f1, report["high"].support) == (0.0, 0.0, 0.0, 1)
    assert report["accuracy"].f1 == pytest.approx(5 / 7) and report["low"].recall == 0.75
    assert report["macro avg"].recall == pytest.approx((0.75 + 1 + 0) / 3)
    score = metrics.accuracy_weighted_f1(df).first()
    assert score.weighted_f1 == pytest.approx((0.75 * 4 + 0.8 * 2 + 0) / 7)
    assert values(metrics.error_directions(df), "actual_tier", "predicted_tier", "count") == [("high", "low", 1), ("low", "medium", 1)]


def test_model_comparison(frame):
    df = frame("model_name string, accuracy double, weighted_f1 double", [("base", 0.71, 0.70005), ("more", 0.8, 0.75)])
    assert values(metrics.model_comparison(df), "model_name", "place") == [("more", 1), ("base", 2)]
    assert metrics.comparison_verdict(df, "base").first().verdict == "added inputs improve on the baseline"
    assert metrics.comparison_verdict(df, "more").first().verdict == "baseline is best"


def test_trends(frame):
    df = frame("run_dt long, mae_today double, rmse_today double, mape_today double, bias_today double",
               [(i, float(i), 1.0, 5.0 - i, 5.0 if i < 2 else -5.0) for i in range(5)])
    got = {r.metric: (r.early_mean, r.recent_mean, r.direction) for r in trends.trend_halves(df).collect()}
    assert got["mae_today"] == (0.5, 3.0, "Worsening") and got["rmse_today"][2] == "Stable"
    assert got["mape_today"][2] == "Improving" and got["bias_today"] == (5.0, -5.0, "Worsening")
    assert trends.trend_halves(df.limit(1)).count() == 0


def test_rank_stability(frame):
    # Ranks of "a": 1 x 126, 3 x 1 ... a deviation that rounds to 1.0 is Moderate.
    rows = [(str(r), f, v) for r in range(4) for f, v in (("a", 9.0 if r % 2 else 1.0), ("b", 5.0), ("c", 0.0))]
    got = {r.feature: (r.avg_rank, r.rank_std, r.stability)
           for r in trends.rank_stability(frame("run_id string, feature string, importance double", rows)).collect()}
    assert got["a"] == (1.5, 0.58, "Stable") and got["c"] == (3.0, 0.0, "Stable")
    one = frame("run_id string, feature string, importance double", rows[:3])
    assert {r.stability for r in trends.rank_stability(one).collect()} == {"Volatile"}


def test_top_features_counts_gaps_as_zero(frame):
    df = frame("run_dt int, feature string, importance double", [(1, "a", 10.0), (1, "b", 1.0), (2, "b", 2.0)])
    assert values(trends.top_features(df), "feature", "avg_importance") == [("a", 5.0), ("b", 1.5)]
    assert values(trends.importance_pivot(df, ["a", "b"]).orderBy("run_dt"), "a", "b") == [(10.0, 1.0), (0.0, 2.0)]


def test_summaries_and_sets(frame):
    a, b = frame("post_id string, url string", [("1", "u")]), frame("post_id string, error string", [("2", "e")])
    assert sets.union_by_name(a, b).columns == ["error", "post_id", "url"]
    row = summaries.image_availability(
        frame("post_id long, image_url string", [(1, " http://a"), (2, "x"), (3, None), (4, "http://b")]),
        frame("post_id string", [("1",), ("1",), ("2",)])).first()
    assert tuple(row) == (4, 2, 1)
    days = frame("date_local string", [("a",), ("a",), ("b",), (None,)])
    assert values(summaries.recent_day_counts(days, n=1), "date_local", "count") == [("b", 1)]


def test_one_client_per_worker(spark, tmp_path):
    """A worker loads its client once, however many tasks and queries of the call it serves; one that
    fails to load is tried again with the next text."""
    import os

    from adledger.operators.extraction import llm_extract

    marks = str(tmp_path)

    def load():
        import os
        import uuid

        with open(f"{marks}/{os.getpid()}-{uuid.uuid4().hex}", "w"):
            pass
        return lambda body: {"price": len(body)}

    df = spark.range(400).select("id", F.concat(F.lit("x"), F.col("id").cast("string")).alias("raw_text")).repartition(40)
    out = llm_extract(df, None, setup=load)
    for _ in range(2):
        assert sorted((r.id, r.price) for r in out.select("id", "price").collect()) == [(i, 1 + len(str(i))) for i in range(400)]
    loads = [f.split("-")[0] for f in os.listdir(marks)]
    assert 0 < len(loads) == len(set(loads)) < 40

    def broken():
        raise RuntimeError("no model")

    failed = llm_extract(df, None, setup=broken).select("price", "error").distinct().collect()
    assert [(r.price, r.error) for r in failed] == [(None, "RuntimeError: no model")]
    with pytest.raises(ValueError, match="either"):
        llm_extract(df, None)
