import random
import struct
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from adledger.llm import shards


def sized(df):
    return df.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8)


def check_law(rows, n, tolerance=0.005):
    total = sum(r["size"] for r in rows)
    size, slots = Counter(), defaultdict(list)
    for r in rows:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(n))
    room = 2 * max(tolerance * total / n, max(r["size"] for r in rows) / 2) + 1e-6
    assert all(abs(size[k] - total / n) <= room for k in range(n))


def test_sizes_are_near_equal_and_copies_stay_together(docs_of):
    r = random.Random(2)
    texts = ["x" * r.randint(0, 400) + str(i % 1500) for i in range(2000)]
    rows = shards.shard(sized(docs_of(dict(enumerate(texts)))), 24).collect()
    assert len(rows) == 2000
    check_law(rows, 24)
    homes = defaultdict(set)
    for x in rows:
        homes[x["text"]].add(x["shard"])
    assert sum(len(h) > 1 for h in homes.values()) <= 23  # only where a boundary needs it


@pytest.mark.parametrize("rows_per_run", [500_000, 7])
def test_a_large_group_of_copies_is_split(docs_of, rows_per_run):
    texts = {i: "the one text" if i % 3 else f"text {i}" for i in range(1200)}
    rows = shards.shard(sized(docs_of(texts)), 24, rows_per_run=rows_per_run).collect()
    check_law(rows, 24)


def test_one_row_larger_than_a_shard(docs_of):
    rows = shards.shard(sized(docs_of({1: "x" * 100_000, **{i: "y" * i for i in range(2, 60)}})), 4).collect()
    check_law(rows, 4)


def test_odd_documents(odd_docs, no_docs, spark):
    rows = shards.shard(sized(odd_docs), 3)
    assert set(rows.columns) == set(odd_docs.columns) | {"size", "shard", "slot"} and rows.count() == odd_docs.count()
    check_law(rows.collect(), 3)
    assert shards.shard(sized(no_docs), 24).count() == 0
    same = spark.createDataFrame([(1, "a")] * 50, "doc_id long, text string")
    assert sorted(r["slot"] for r in shards.shard(sized(same), 1).collect()) == list(range(50))


def test_written_shards(docs_of, tmp_path, spark):
    out = shards.shard(sized(docs_of({i: f"text {i}" for i in range(100)})), 4)
    shards.write_shards(out, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).groupBy("shard").count().count() == 4


def spark_hash(*values):
    """xxhash64 of texts, longs and booleans, as Spark chains it, unsigned."""
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else struct.pack("<i", v) if isinstance(v, bool) else struct.pack("<q", v)
        seed = xxhash.xxh64(data, seed=seed).intdigest()
    return seed


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_splitters_equal_a_recount(docs_of, seed):
    """Shards are runs of the key order; every splitter is within the tolerance of its target, or,
    where no boundary between texts is, the nearest boundary between rows; slots follow."""
    r = random.Random(seed)
    n, tolerance = 6, 0.01
    texts = {i: r.choice(["hot " * 30, None, "", f"text {r.randint(0, 60)}", "w" * r.randint(0, 900)]) for i in range(400)}
    rows = shards.shard(sized(docs_of(texts)), n, tolerance=tolerance).collect()
    keys = {x["doc_id"]: (spark_hash(x["text"] or "", x["text"] is None), spark_hash(x["doc_id"])) for x in rows}
    rows.sort(key=lambda x: keys[x["doc_id"]])
    assert [x["shard"] for x in rows] == sorted(x["shard"] for x in rows)
    below, total = [0], sum(x["size"] for x in rows)
    for x in rows:
        below.append(below[-1] + x["size"])
    between = [i for i in range(len(rows) + 1) if i in (0, len(rows)) or keys[rows[i - 1]["doc_id"]][0] != keys[rows[i]["doc_id"]][0]]
    for k in range(1, n):
        target, allowed = total * k / n, tolerance * total / n
        cut = sum(x["shard"] < k for x in rows)
        off = abs(below[cut] - target)
        if cut in between:
            assert off <= allowed or off == min(abs(b - target) for b in below)
        else:
            assert min(abs(below[i] - target) for i in between) > allowed
            assert off <= allowed or off == min(abs(b - target) for b in below)
    for k in range(n):
        assert [x["slot"] for x in rows if x["shard"] == k] == list(range(sum(x["shard"] == k for x in rows)))
