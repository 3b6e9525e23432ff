"""What the plans must and must not do, and the ways taken when a checked size is exceeded."""

import os

import pytest
from pyspark.sql import functions as F

from adledger.functions.html import first_image_url, visible_text
from adledger.operators import dedup, explain, features, filters, joins, splits
from adledger.operators.extraction import parse_listing, with_model_text
from adledger.operators.sets import union_links

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_tables
def test_filters_and_columns_reach_the_scan(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    text = plan(filters.price_band_filter(orders, "o_totalprice").select("o_orderkey"))
    assert "GreaterThan(o_totalprice,500.0)" in text and "LessThan(o_totalprice,100000.0)" in text
    assert "o_custkey" not in text


@needs_tables
def test_narrow_jobs_do_not_shuffle(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    vocab = features.text_vocab(docs, "text")
    for df in (parse_listing(docs), with_model_text(docs, "text"), features.text_sequence(docs, vocab, "text"),
               docs.select(visible_text("text"))):
        text = plan(df)
        assert "Exchange" not in text and "Join" not in text and "BatchEvalPython" not in text


@needs_tables
def test_split_leaves_rows_where_they_are(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for df in (splits.stratified_split(docs, "lang", "doc_id"), splits.contiguous_folds(docs, ["doc_id"]),
               splits.price_tier(docs, "n_chars")):
        assert "Exchange hashpartitioning" not in plan(df) and "Exchange rangepartitioning" not in plan(df)


@needs_tables
def test_no_cross_joins(spark):
    import __spark_entry__ as entry_module

    slow = {"grid_search", "text_classifier", "structured_classifier", "fused_classifier", "gbt_regressor"}
    for name, query in entry_module.queries().items():
        if name not in slow:
            text = plan(query(spark, FOLDER))
            assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name


@needs_tables
def test_one_parse_per_answer(spark):
    from adledger.functions.records import parse_llm_json

    answers = spark.read.parquet(f"{FOLDER}/documents.parquet").select(parse_llm_json("text").alias("p"))
    assert plan(answers.select("p.*")).count("from_json(StructField(price") <= 1 or plan(answers).count("price,LongType") == 0


@needs_tables
def test_pages_never_leave_the_jvm(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    for df in (pages.select(visible_text("html")), pages.select(first_image_url("html")), union_links(pages, "https://b.org")):
        assert "Python" not in plan(df) and "Exchange" not in plan(df)


def test_many_strata(spark):
    """One row of a stratum each: the same path as for few."""
    df = spark.range(300).select("id", F.col("id").cast("string").alias("s"))
    assert splits.stratified_split(df, "s", "id").filter("split = 'test'").count() == 60


def test_a_hundred_thousand_strata(spark):
    """Largest remainder over very many strata, in exact numbers."""
    sizes = spark.range(100_000).select("id", (F.col("id") % 3 + 1).alias("n"))
    df = sizes.select("id", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("i")).select(
        F.concat_ws("-", "id", "i").alias("key"), F.col("id").alias("s"))
    out = splits.stratified_split(df, "s", "key")
    got = {(r["n"], r["t"]): r["k"] for r in out.groupBy("s").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("t"))
           .groupBy("n", "t").agg(F.count("*").alias("k")).collect()}
    # 199,999 rows, 40,000 for the test: strata of three (0.6 of a row) come first, then of two (0.4)
    total = sum(i % 3 + 1 for i in range(100_000))
    test = -(-total // 5)
    threes, twos = sum(i % 3 == 2 for i in range(100_000)), sum(i % 3 == 1 for i in range(100_000))
    assert got == {k: v for k, v in {(3, 1): min(threes, test), (2, 1): test - threes, (2, 0): twos - (test - threes), (1, 0): 100_000 - threes - twos}.items() if v}


def test_sources_landed_twice(frame):
    raw = frame("path string, text string", [(f"p{i}", f"Text {i}") for i in range(20)])
    twice = raw.unionByName(frame("path string, text string", [(f"p{i}", f"Text {i} later") for i in range(0, 20, 3)])).unionByName(raw)
    twice = twice.unionByName(frame("path string, text string", [("s/../p1", "x"), ("z", None), ("z", None)]))
    records = frame("post_id string, combined_text string, source_txt string",
                    [(str(i), None if i % 2 else "x", f"p{i % 25}") for i in range(50)])
    once = [sorted(map(str, df.collect())) for df in (
        joins.backfill_text(records, raw, "b"), joins.record_to_source(records, raw))]
    again = [sorted(map(str, df.collect())) for df in (
        joins.backfill_text(records, twice, "b"), joins.record_to_source(records, twice))]
    assert once == again
    spelled = frame("path string, text string", [("/a/1.txt", "Slash"), ("gs://main/a/1.txt", "Bucket")])
    one = frame("post_id string, combined_text string, source_txt string", [("1", None, "a/1.txt")])
    assert [r["combined_text"] for r in joins.backfill_text(one, spelled, "main").collect()] == ["slash"]


@needs_tables
def test_latest_is_read_once(spark):
    """The listing table asks its records for one pass."""
    from adledger.plans import jobs

    asked = []
    records = frame_of(spark)
    real = jobs.materialize
    jobs.materialize, before = (lambda *a, **k: asked.append(1) or real(*a, **k)), real
    try:
        jobs.materialize_listings(records, spark.createDataFrame([("p", "t")], "path string, text string"), "b").count()
    finally:
        jobs.materialize = before
    assert asked == [1]


def frame_of(spark):
    return spark.createDataFrame([("1", "20260101000000", "p", None)], "post_id string, run_id string, source_txt string, combined_text string")


def test_shuffle_needs_a_key(frame):
    with pytest.raises(ValueError, match="does not identify"):
        explain.shuffle_columns(frame("k int, v int", [(1, 1), (1, 2)]), ["v"], "k", [], 1, 1)


def test_latest_survives_a_recomputed_input(spark, tmp_path):
    """The result does not depend on how rows are spread or ordered."""
    rows = [(str(i % 50), "20260101000000" if i % 3 else "20260102000000", f"s{i:04d}") for i in range(500)]
    df = spark.createDataFrame(rows, "post_id string, run_id string, source_txt string")
    first = sorted(map(tuple, dedup.latest_by_key(df).collect()))
    assert all(first == sorted(map(tuple, dedup.latest_by_key(df.repartition(n, "source_txt")).collect())) for n in (1, 5, 13))
