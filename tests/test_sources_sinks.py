"""Readers and writers on small landed files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from adledger.plans.jobs import (
    crawl_index, extract_run, extract_with_model, land_listings, materialize, materialize_listings, trend_report,
)
from adledger.schemas import LISTING_COLUMNS, MASTER_COLUMNS, RECORD_COLUMNS
from adledger.sinks import write_files, write_if_absent, write_index, write_jsonl, write_run_outputs, write_table_csv
from adledger.sources import (
    artifact_inventory, list_runs, pack_files, read_importance, read_jsonl, read_packed_jsonl, read_packed_texts,
    read_pages, read_run_metrics, read_run_texts, read_table_csv,
)
from adledger.sources.texts import landed_files


def put(root, path, content):
    full = os.path.join(str(root), path)
    os.makedirs(os.path.dirname(full), exist_ok=True)
    with open(full, "w", newline="") as f:
        f.write(content)


A, B, C, D = "20251026170002", "20251026T080000Z", "20251027000000", "20251028T000000Z"


def test_layouts(spark, tmp_path):
    root = tmp_path / "scrapes"
    put(root, f"run_id={A}/txt/1.txt", "one\ntwo")
    put(root, f"run_id={A}/2.txt", "ignored: a better layout exists")
    put(root, f"{A}/3.txt", "ignored too")
    put(root, f"run_id={B}/4.txt", "four")
    put(root, f"{C}/txt/5.txt", "five")
    put(root, f"{C}/6.txt", "ignored")
    put(root, f"{D}/7.txt", "seven")
    put(root, f"{D}/8.csv", "not a text")
    put(root, "junk/9.txt", "no run")
    got = {(r.run_id, r.post_id): r.text for r in read_run_texts(spark, str(root)).collect()}
    assert got == {(A, "1"): "one\ntwo", (B, "4"): "four", (C, "5"): "five", (D, "7"): "seven"}
    assert [r.run_id for r in list_runs(spark, str(root)).collect()] == sorted([A, B, C, D])
    assert [r.run_id for r in list_runs(spark, str(root), tagged_only=True).collect()] == sorted([A, B])
    row = read_run_texts(spark, str(root), D).first()
    assert (row.post_id, row.path) == ("7", f"scrapes/{D}/7.txt")
    assert read_run_texts(spark, str(root), A).first().path == f"scrapes/run_id={A}/txt/1.txt"


def test_jsonl(spark, tmp_path):
    root = tmp_path / "structured"
    one = f"run_id={A}/jsonl"
    put(root, f"{one}/1.jsonl", json.dumps({"post_id": "1", "price": 5}) + "\n")
    put(root, f"{one}/2.jsonl", "  \n")
    put(root, f"{one}/3.jsonl", '{"post_id": "3", "pri')
    put(root, f"{one}/4.jsonl", '{"post_id": "4"}\n{"post_id": "4b"}')
    put(root, f"{one}/5.jsonl", json.dumps({"post_id": "5", "run_id": C, "make": 'odd } { "quote'}))
    put(root, f"{one}/6.jsonl", json.dumps({"post_id": "6", "price": "x", "extra": {"a": [1]}}, indent=2))
    put(root, f"{one}/7.jsonl", "[1]")
    put(root, f"{one}/8.txt", json.dumps({"post_id": "8"}))
    put(root, f"run_id={A}/jsonl_llm/9.jsonl", json.dumps({"post_id": "9", "zip_code": "06511", "has_combined_text": True}))
    put(root, "run_id=zz/jsonl/10.jsonl", json.dumps({"post_id": "10"}))
    put(root, f"{one}/11.jsonl", json.dumps({"post_id": "11", "run_id": None}))
    got = {r.post_id: r for r in read_jsonl(spark, str(root)).collect()}
    assert set(got) == {"1", "5", "6", "11"}
    assert (got["1"].run_id, got["1"].price) == (A, 5)
    assert (got["5"].run_id, got["5"].folder_run) == (C, A)
    assert got["6"].price is None and got["11"].run_id == A
    dense = read_jsonl(spark, str(root), "jsonl_llm").first()
    assert (dense.zip_code, dense.has_combined_text) == ("06511", True)


def test_jsonl_round_trip(spark, frame, tmp_path):
    df = frame("post_id string, run_id string, price long, make string", [("1", A, 5, None), ("2", B, None, "x\ny")])
    for sparse in (True, False):
        path = str(tmp_path / f"out-{sparse}")
        write_jsonl(df, path, sparse)
        back = read_jsonl(spark, path, None, ".txt", ["post_id", "run_id", "price", "make"], one_per_file=False)
        assert sorted(tuple(r) for r in back.select(*df.columns).collect()) == sorted(tuple(r) for r in df.collect())
        lines = [r.value for r in spark.read.text(path).collect()]
        assert any('"price":null' in x for x in lines) is not sparse


def test_csv(spark, frame, tmp_path):
    df = frame("post_id string, zip_code string, combined_text string, has_combined_text boolean, price long, more int",
               [("007", "06511", 'a "q",\nb', True, 5, 1), ("8", None, None, None, None, 2)])
    path = str(tmp_path / "t")
    write_table_csv(df, path, LISTING_COLUMNS)
    back = read_table_csv(spark, path, ["post_id"])
    assert back.columns == LISTING_COLUMNS
    row = back.where("post_id = '007'").first()
    assert (row.zip_code, row.combined_text, row.has_combined_text, row.price) == ("06511", 'a "q",\nb', True, 5)
    with pytest.raises(ValueError, match=r"\['nope', 'zero'\]"):
        read_table_csv(spark, path, ["zero", "post_id", "nope"])
    with pytest.raises(Exception):
        read_table_csv(spark, str(tmp_path / "missing"))
    put(tmp_path, "py.csv", "post_id,has_combined_text,price\n1,True,x\n2,False,7\n")
    assert [tuple(r) for r in read_table_csv(spark, str(tmp_path / "py.csv")).collect()] == [("1", True, None), ("2", False, 7)]


def test_pages_from_files(spark, tmp_path):
    put(tmp_path, "p/1.html", "<p>a</p>\n<p>b</p>")
    assert read_pages(spark, str(tmp_path / "p"), "html").first().html == "<p>a</p>\n<p>b</p>"


def metrics(mae, bias, depth):
    return json.dumps({"run_ts": "2026-04-04T08:20:18+00:00", "today_local": "2026-04-04", "train_rows": 299, "holdout_rows": 158,
                       "mae_today": mae, "rmse_today": mae * 2, "mape_today": 97.5, "bias_today": bias, "best_cv_mae": mae - 1,
                       "best_params": {"model__learning_rate": 0.1, "model__max_depth": depth, "model__min_samples_leaf": 5,
                                       "model__n_estimators": 300}}, indent=2)


def test_artifacts(spark, tmp_path):
    root = str(tmp_path)
    for i, (mae, bias) in enumerate([(10.0, 5.0), (20.0, 5.0), (30.0, -5.0), (5.0, -5.0), (5.0, -5.0)]):
        put(tmp_path, f"202604040{i}-metrics.json", metrics(mae, bias, 5 + 2 * (i % 2)))
    for i in (0, 3):
        rows = [{"feature": "year", "importance_mean": 9.5 - i}, {"feature": "make", "importance_mean": 0.0},
                {"feature": "body", "importance_mean": 0.0}]
        put(tmp_path, f"202604040{i}-permutation_importance.json", json.dumps(rows[: 3 - (i > 0)], indent=2))
    put(tmp_path, "2026040400-pdp_top3.png", "x")
    runs, importance = read_run_metrics(spark, root), read_importance(spark, root)
    assert runs.count() == 5 and importance.count() == 5
    kinds = {r.kind: (r.files, r.first_run, r.last_run) for r in artifact_inventory(spark, root).collect()}
    assert kinds["metrics"] == (5, "2026040400", "2026040404") and kinds["pdp_top3"][0] == 1
    report = {k: [tuple(r) for r in v.collect()] for k, v in trend_report(runs, importance).items()}
    halves = {r[0]: r[2:] for r in report["halves"]}
    assert halves["mae_today"][:2] == (15.0, 40 / 3) and halves["mae_today"][2] == "Improving"
    assert halves["mape_today"][2] == "Stable" and halves["bias_today"] == (5.0, -5.0, "Worsening")
    assert ("max_depth", "5", 3) in report["params"] and ("max_depth", "7", 2) in report["params"]
    assert dict((r[0], r[1]) for r in report["top_features"]) == {"year": 8.0, "make": 0.0, "body": 0.0}
    stability = {r[0]: r[1:] for r in report["stability"]}
    assert stability["make"] == (2.0, 0.0, "Stable") and stability["body"] == (3.0, None, "Volatile")


def test_run_outputs(spark, frame, tmp_path):
    root = str(tmp_path)
    preds = frame("post_id string, pred_price double", [("1", 2.5)])
    row = frame("mae_today double, rmse_today double", [(1.0, None)])
    imp = frame("feature string, importance_mean double", [("a", 1.0), ("b", 3.0), ("c", 3.0)])
    assert write_run_outputs(root, "2026040408", preds, row, imp, dry_run=True) == f"{root}/2026040408"
    assert not os.path.exists(f"{root}/2026040408")
    for _ in range(2):  # the same hour overwrites
        write_run_outputs(root, "2026040408", preds, row, imp)
    assert [(r.run_id, r.mae_today) for r in read_run_metrics(spark, root).collect()] == [("2026040408", 1.0)]
    assert [(r.feature, r.position) for r in read_importance(spark, root).orderBy("position").collect()] == [("b", 0), ("c", 1), ("a", 2)] \
        or [r.feature for r in read_importance(spark, root).orderBy("position").collect()][2] == "a"


def test_write_if_absent(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    schema = "run_id string, post_id string, v int"
    assert write_if_absent(frame(schema, [(A, "1", 1), (A, "2", 1), (B, "1", 1)]), path).count() == 3
    assert write_if_absent(frame(schema, [(A, "1", 2), (A, "3", 2)]), path, dry_run=True).count() == 1
    write_if_absent(frame(schema, [(A, "1", 2), (A, "3", 2)]), path)
    table = lambda: sorted(tuple(r) for r in spark.read.parquet(path).select(
        F.col("run_id").cast("string"), "post_id", "v").collect())
    assert table() == sorted([(A, "1", 1), (A, "2", 1), (A, "3", 2), (B, "1", 1)])
    write_if_absent(frame(schema, [(A, "1", 9), (C, "1", 9)]), path, overwrite=True)
    assert table() == sorted([(A, "1", 9), (A, "2", 1), (A, "3", 2), (B, "1", 1), (C, "1", 9)])


def test_index(spark, frame, tmp_path):
    write_index(frame("url string, post_id string, error string", [("u", "1", None)]), str(tmp_path / "i"))
    assert spark.read.csv(str(tmp_path / "i"), header=True).columns == ["error", "post_id", "url"]


def test_land_listings(spark, frame, tmp_path):
    search = frame("page_id long, html string", [
        (1, '<a href="/cars/9.html">a</a><a href="/cars/9b/9.html">same post</a><a href="/cars/5.html">b</a>'),
        (2, '<a href="/cars/5.html">again</a><a href="/cars/7.html">c</a>')])
    pages = frame("url string, html string", [
        ("https://s/cars/9.html", '<h1>Nine</h1><img src="https://images.example.org/9.jpg">'), ("https://s/cars/5.html", "<p>five</p>")])
    got = {r.post_id: r for r in land_listings(search, pages, "https://s", A, 3).collect()}
    assert got["9"].text == "Nine\n\nimage_url: https://images.example.org/9.jpg\n" and got["9"].object == f"scrapes/{A}/9.txt"
    assert got["5"].text == "five\n" and got["5"].error is None and got["5"].image_url == ""
    assert (got["7"].error, got["7"].object, got["7"].text) == ("page not landed", "", None)
    assert set(land_listings(search, pages, "https://s", A, 2).toPandas().post_id) == {"9", "5"}
    assert crawl_index(land_listings(search, pages, "https://s", A)).columns == ["error", "image_url", "object", "post_id", "url"]


def test_texts_to_table(spark, tmp_path):
    root = tmp_path / "scrapes"
    put(root, f"{A}/1.txt", "Honda Civic $5,000 2010")
    put(root, f"{C}/1.txt", "Honda Civic $4,500 2010")
    put(root, f"{A}/2.txt", "ford thing")
    texts = read_run_texts(spark, str(root))
    records = extract_run(texts)
    assert records.count() == 3 and extract_run(texts, max_files=2).count() == 2
    master = materialize(records)
    assert master.columns == MASTER_COLUMNS
    assert sorted((r.post_id, r.run_id, r.price) for r in master.collect()) == [("1", C, 4500), ("2", A, None)]
    listing = materialize_listings(records, texts.select("path", "text"), "main").collect()
    assert [(r.post_id, r.combined_text) for r in listing] == [("2", "ford thing"), ("1", "honda civic 2010")]
    fields = extract_with_model(records, texts.select("path", "text"), lambda b: {"price": 7}, "rules", "v1")
    assert set(RECORD_COLUMNS) <= set(fields.columns)
    assert {(r.price, r.llm_provider, r.error) for r in fields.collect()} == {(7, "rules", None)}


@pytest.mark.parametrize("overwrite", [False, True])
def test_write_if_absent_prunes_and_reads_the_batch_once(spark, tmp_path, overwrite):
    path, log = str(tmp_path / "t"), str(tmp_path / "log")
    make = lambda n, text: spark.range(n).select((F.col("id") % 40).cast("string").alias("run_id"), F.col("id").cast("string").alias("post_id"), F.lit(text).alias("v"))
    write_if_absent(make(400, "old"), path)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def watched(x):
        seen.add(1)
        return x

    batch = make(800, "new").where("run_id IN ('3', '7')").withColumn("v", watched("v"))
    new = write_if_absent(batch, path, overwrite=overwrite)
    assert seen.value == 40  # each row of the batch computed once
    rows = {r["post_id"]: (r["run_id"], r["v"]) for r in spark.read.parquet(path).collect()}
    assert len(rows) == 420 and {k for k, (_, v) in rows.items() if v == "new"} == {str(i) for i in range(800) if i % 40 in (3, 7) and (overwrite or i >= 400)}
    from adledger.sinks import writers

    old = spark.read.parquet(path).withColumn("run_id", F.col("run_id").cast("string"))
    runs = writers.stored(spark.createDataFrame([("3",), ("7",)], "run_id string"), "runs")
    pruned = writers.touched_partitions(old, runs, "run_id")
    assert pruned.count() == 40 and "dynamicpruning" in pruned._jdf.queryExecution().executedPlan().toString()
    assert new.count() in (20, 40)


def test_packing_takes_each_file_once(spark, tmp_path):
    """Packed texts equal the landing zone's, over layouts and after late files; a second run with
    nothing new writes nothing."""
    root, out, state = tmp_path / "scrapes", str(tmp_path / "packed"), str(tmp_path / "state")
    same = lambda: sorted(read_packed_texts(spark, out).collect()) == sorted(read_run_texts(spark, str(root)).collect())
    assert read_packed_texts(spark, out).count() == 0
    put(root, f"run_id={A}/2.txt", "a poorer layout")
    put(root, f"{B}/4.txt", "four\n")
    put(root, f"{C}/5.txt", "")
    put(root, "junk/9.txt", "no run")
    pack_files(spark, str(root), out, state).awaitTermination()
    assert same() and {r.post_id for r in read_packed_texts(spark, out).collect()} == {"2", "4"}
    put(root, f"run_id={A}/txt/1.txt", "one\ntwo")  # a better layout arrives late
    put(root, f"{B}/4 b.txt", "a name with a blank")
    pack_files(spark, str(root), out, state).awaitTermination()
    assert same() and {r.post_id for r in read_packed_texts(spark, out).collect()} == {"1", "4", "4 b"}
    assert [r.post_id for r in read_packed_texts(spark, out, A).collect()] == ["1"]
    plan = read_packed_texts(spark, out, A)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan
    batches = sorted(os.listdir(out))
    pack_files(spark, str(root), out, state).awaitTermination()
    assert sorted(os.listdir(out)) == batches and same()


def test_packed_records(spark, tmp_path):
    root, out, state = tmp_path / "structured", str(tmp_path / "packed"), str(tmp_path / "state")
    put(root, f"run_id={A}/jsonl/1.jsonl", json.dumps({"post_id": "1", "price": 5}, indent=1))
    put(root, f"run_id={A}/jsonl/2.jsonl", "{")
    put(root, f"run_id={B}/jsonl_llm/3.jsonl", json.dumps({"post_id": "3"}))
    put(root, f"{C}/jsonl/4.jsonl", json.dumps({"post_id": "4"}))
    pack_files(spark, str(root), out, state, "*.jsonl").awaitTermination()
    for subdir, ids in (("jsonl", {"1"}), ("jsonl_llm", {"3"}), (None, {"1", "3"})):
        got = read_packed_jsonl(spark, out, subdir).drop("file").collect()
        assert {r.post_id for r in got} == ids and sorted(got, key=str) == sorted(read_jsonl(spark, str(root), subdir).drop("file").collect(), key=str)


def test_write_files(spark, frame, tmp_path):
    """Texts as they are, nulls as empty files, a repeated run the same files; odd names fail."""
    rows = [("x/1.txt", "one\r\nä"), ("x/2.txt", None), ("2 b.txt", "")]
    for _ in range(2):
        assert write_files(frame("name string, text string", rows), str(tmp_path / "f"), "name", "text") == 3
    read = lambda n: (tmp_path / "f" / n).read_bytes()
    assert read("x/1.txt") == "one\r\nä".encode() and read("x/2.txt") == read("2 b.txt") == b""
    assert write_files(frame("name string, text string", []), f"file:{tmp_path}/g", "name", "text") == 0
    write_files(frame("name string, text string", rows[:1]), f"file:{tmp_path}/g", "name", "text")
    assert (tmp_path / "g" / "x" / "1.txt").exists()
    for bad in ("../out.txt", "/abs.txt", None, ""):
        with pytest.raises(Exception, match="not a file name"):
            write_files(frame("name string, text string", [(bad, "t")]), str(tmp_path / "h"), "name", "text")


def test_packing_streams_lists_not_files(spark, tmp_path):
    """The stream knows of one list per batch, however many files landed; names that Spark's readers
    pass over are, and odd ones are read."""
    root, out, state = tmp_path / "scrapes", str(tmp_path / "packed"), str(tmp_path / "state")
    for i in range(40):
        put(root, f"run_id={A}/txt/{i}.txt", f"text {i}")
    for name in ("5% off #1.txt", "é ü.txt", "a+b&c.md"):
        put(root, f"{B}/{name}", name)
    for name in ("_hidden.txt", ".hidden.txt", "no.csv", "_dir/1.txt"):
        put(root, f"{B}/{name}", "passed over")
    pack_files(spark, str(root), out, state, "*.{txt,md}").awaitTermination()
    taken = [line for log in (tmp_path / "state").glob("**/sources/0/[0-9]*") for line in log.read_text().splitlines()[1:]]
    assert len(taken) == 1
    rows = spark.read.parquet(out).collect()
    assert sorted(r.text for r in rows) == sorted([f"text {i}" for i in range(40)] + ["5% off #1.txt", "é ü.txt", "a+b&c.md"])
    direct = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(root)).select("path").collect()
    assert {r.file for r in rows} == {r.path for r in direct} - {f"file:{root}/{B}/no.csv"}
    put(root, f"{B}/late.txt", "x" * 50)
    put(root, f"{B}/later.txt", "y" * 50)
    pack_files(spark, f"{root}/", out, state, batch_bytes=60).awaitTermination()
    assert len(os.listdir(out)) >= 2 and spark.read.parquet(out).count() == 45


def test_packing_goes_on_from_a_stream_over_the_zone(spark, tmp_path):
    root, out, state = tmp_path / "scrapes", str(tmp_path / "packed"), str(tmp_path / "state")
    put(root, f"{A}/1.txt", "one")
    old = landed_files(spark.readStream, str(root), "*.txt").select(
        F.lit(A).alias("run_id"), F.col("path").alias("file"), F.lit("p").alias("path"), F.lit(4).alias("layout"), F.lit("old").alias("text"))
    old.writeStream.foreachBatch(lambda df, i: df.write.partitionBy("run_id").parquet(f"{out}/batch_id={i}")).option(
        "checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    put(root, f"{A}/2.txt", "two")
    for _ in range(2):
        pack_files(spark, str(root), out, state).awaitTermination()
    assert sorted(r.text for r in spark.read.parquet(out).collect()) == ["old", "two"]
