import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from adledger.llm import queries
from adledger.llm.common import stored

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def folder(spark, tmp_path):
    """Tables with planted cases: copies, near copies, a shared line, a benchmark passage, junk."""
    r = random.Random(5)
    letters = {"en": ["the", "ing", "and", "er"], "de": ["sch", "ung", "der", "ein"]}
    body = lambda lang: " ".join("".join(r.choices(letters[lang], k=3)) + r.choice("abcdefg") for _ in range(60))
    rows = []
    for i in range(60):
        lang = "en" if i % 2 else "de"
        rows.append([i, f"{body(lang)}.\n{body(lang)}.", lang, "s", 0])
    rows[50][1] = rows[3][1].replace(".", ",", 1).replace("\n", " ")  # a near copy by words, not by lines
    rows[51][1] = rows[5][1]  # an exact copy
    rows[52][1] = body("en") + "\n" + rows[7][1].split("\n")[1]  # shares a line
    passage = "where benchmark items hide they must be found and taken out of all training data"
    rows[53][1] += "\n" + passage
    rows += [[60, None, "en", "s", 0], [61, "123 !!", "en", "s", 0], [62, "", None, None, None]]
    spark.createDataFrame([tuple(x) for x in rows], DOCS).withColumn("n_chars", F.length("text").cast("long")).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, folder), name)
        seen[name] = {r["doc_id"]: r.asDict() for r in docs.collect()}
    ids = {k: set(v) for k, v in seen.items()}
    everything = set(range(60))
    assert ids["language_id"] == everything
    assert ids["line_dedup"] == everything - {51}
    line = seen["line_dedup"][52]
    assert "\n" not in line["text"] and line["n_chars"] == len(line["text"])
    assert ids["simhash_near_dedup"] == everything - {50, 51}
    assert ids["benchmark_decontamination"] == everything - {50, 51, 53}
    assert ids["bpe_encoding"] == everything - {50, 51, 53}


def test_run(spark, folder):
    out = pipeline.run(spark, folder)
    assert out.count() == 57 and {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(out.columns)


@pytest.mark.parametrize("name,stage", pipeline.STAGES, ids=[n for n, _ in pipeline.STAGES])
def test_odd_documents(spark, tmp_path, odd_docs, no_docs, name, stage):
    spark.createDataFrame([(1, "no such passage anywhere")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = stage(spark, odd_docs, str(tmp_path))
    if name != "bpe_encoding":
        assert out.columns == odd_docs.columns
    assert {"language_id": 7, "line_dedup": 10, "simhash_near_dedup": 6, "benchmark_decontamination": 12, "bpe_encoding": 12}[name] == out.count()
    assert stage(spark, no_docs, str(tmp_path)).count() == 0


def test_unlabelled_documents_stay(spark, odd_docs):
    kept = pipeline.language_id(spark, odd_docs.withColumn("lang", F.lit(None).cast("string")), "")
    assert kept.count() == 7 and kept.columns == odd_docs.columns


def test_registered_names():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 11))
