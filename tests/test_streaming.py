"""Streams against their batch twins."""

import os

from pyspark.sql import functions as F

from adledger.operators.dedup import latest_by_key
from adledger.streaming.jobs import expire_latest, compact_latest, current_latest, run_to_end, stream_extract, stream_latest

A, B, C = "20251026170002", "20251026T180002Z", "20251027000000"
SCHEMA = "post_id string, run_id string, source_txt string, price long"


def rows(df):
    return sorted(tuple(r) for r in df.select("post_id", "run_id", "source_txt", "price").collect())


def test_latest_with_late_and_repeated_input(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    batches = [
        [("1", B, "b", 2), ("2", A, "a", 1), ("1", A, "a", 1)],
        [("1", A, "late", 9), ("3", C, "c", 3), ("2", "zz", "odd", 4)],
        [("3", C, "a-first-seen", 5), ("2", C, "c", 6)],
    ]
    seen = []
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        seen += batch
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        run_to_end(stream_latest(stream, out, state))
        assert rows(current_latest(spark, out)) == rows(latest_by_key(spark.createDataFrame(seen, SCHEMA)))
        if i == 1:
            compact_latest(spark, out)
            assert rows(current_latest(spark, out)) == rows(latest_by_key(spark.createDataFrame(seen, SCHEMA)))
    compact_latest(spark, out)
    compact_latest(spark, out)  # nothing new: same version again
    assert rows(current_latest(spark, out)) == rows(latest_by_key(spark.createDataFrame(seen, SCHEMA)))


def test_extract_takes_each_file_once(spark, tmp_path):
    landing, out, state = (str(tmp_path / n) for n in ("scrapes", "out", "state"))
    os.makedirs(f"{landing}/{A}")
    for i in range(3):
        with open(f"{landing}/{A}/{i}.txt", "w") as f:
            f.write(f"Honda Civic\n$1,00{i}")
        run_to_end(stream_extract(spark, landing, out, state))
        got = sorted((r.post_id, r.price, r.scraped_at) for r in spark.read.parquet(out).collect())
        assert got == [(str(k), 1000 + k, "2025-10-26T17:00:02Z") for k in range(i + 1)]


def test_empty_and_expired_tables(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    assert current_latest(spark, out).count() == 0
    expire_latest(spark, out)
    seen = []
    for i, run in enumerate((A, B, C)):
        batch = [("1", run, f"s{i}", i), (str(i + 2), run, "x", i)]
        seen += batch
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        run_to_end(stream_latest(spark.readStream.schema(SCHEMA).parquet(source), out, state))
        compact_latest(spark, out)
    before = rows(current_latest(spark, out))
    expire_latest(spark, out, keep_versions=1)
    assert rows(current_latest(spark, out)) == before == rows(latest_by_key(spark.createDataFrame(seen, SCHEMA)))
    assert len(os.listdir(f"{out}/base")) <= 3 and [d for d in os.listdir(f"{out}/deltas") if d.startswith("batch_id=")] == []


def test_a_late_batch_touches_its_own_buckets(spark, tmp_path):
    """Ten late keys: a read ranks at most ten buckets, a compaction rewrites at most ten."""
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    first = [(str(i), A, "a", i) for i in range(2000)]
    late = [(str(i), B, "b", -i) for i in range(10)]

    def arrive(batch):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        run_to_end(stream_latest(spark.readStream.schema(SCHEMA).parquet(source), out, state, buckets=100))

    arrive(first)
    compact_latest(spark, out)
    settled = current_latest(spark, out)
    assert "Window" not in settled._jdf.queryExecution().executedPlan().toString()
    arrive(late)
    hashed = spark.createDataFrame(late, SCHEMA).select(F.pmod(F.xxhash64("post_id"), F.lit(100)).alias("b"))
    touched = {r.b for r in hashed.collect()}
    expected = rows(latest_by_key(spark.createDataFrame(first + late, SCHEMA)))
    current = current_latest(spark, out)
    assert rows(current) == expected
    read = current._jdf.queryExecution().executedPlan().toString()
    assert read.count("WindowGroupLimit") >= 1 and "Exchange" in read
    before = {f: os.path.getmtime(f"{out}/base/version=0/{f}") for f in os.listdir(f"{out}/base/version=0") if "=" in f}
    compact_latest(spark, out)
    rewritten = {int(f.split("=")[1]) for f in os.listdir(f"{out}/base/version=1") if "=" in f}
    assert rewritten == touched and len(rewritten) <= 10
    assert before == {f: os.path.getmtime(f"{out}/base/version=0/{f}") for f in before}
    assert rows(current_latest(spark, out)) == expected
    expire_latest(spark, out, keep_versions=1)
    left = {int(f.split("=")[1]) for f in os.listdir(f"{out}/base/version=0") if "=" in f}
    assert not left & touched and rows(current_latest(spark, out)) == expected


def test_an_unfinished_compaction_is_not_read(spark, tmp_path):
    """Base folders without a manifest, as a lost driver leaves them, change nothing."""
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for i, batch in enumerate(([("1", A, "a", 1), ("2", A, "a", 2)], [("1", B, "b", 3)])):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        run_to_end(stream_latest(spark.readStream.schema(SCHEMA).parquet(source), out, state))
        if i == 0:
            compact_latest(spark, out)
    junk = spark.createDataFrame([("1", C, "junk", 9)], SCHEMA)
    junk.write.parquet(f"{out}/base/version=1/bucket=0")
    expected = [("1", B, "b", 3), ("2", A, "a", 2)]
    assert rows(current_latest(spark, out)) == expected
    compact_latest(spark, out)  # repeated from the same files
    assert rows(current_latest(spark, out)) == expected
    assert os.listdir(f"{out}/manifest") and sorted(os.listdir(f"{out}/base")) == ["version=0", "version=1"]


def test_null_keys_and_new_columns(spark, tmp_path):
    """Rows without a key are left out; a column that a later batch brings is kept, null before."""
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for batch, schema in (
        ([("1", A, "a", 1), (None, A, "a", 2)], SCHEMA), ([("2", B, "b", 3, "blue")], SCHEMA + ", colour string"),
    ):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(source)
        run_to_end(stream_latest(spark.readStream.schema(schema).parquet(source), out, state, buckets=4))
    for _ in range(2):
        got = current_latest(spark, out)
        assert rows(got) == [("1", A, "a", 1), ("2", B, "b", 3)]
        assert {r.post_id: r.colour for r in got.collect()} == {"1": None, "2": "blue"}
        compact_latest(spark, out)
