import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns with names the operators might use themselves.
EXTRA = ("fp", "first", "k1", "h", "lines", "root", "d0", "shard", "n_lines", "component_id", "ids", "text_hash", "__k1x", "score")


def long_text(n=3000):
    return " ".join(f"word{i * 7919 % 1000} and{i % 13}" for i in range(n))


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, repeated ids, blanks only."""
    text = "the quick brown fox jumps over the lazy dog and runs away from the farm at night"
    rows = [
        (1, text, "en", "a", 80), (1, text, "en", "a", 80), (2, text, "en", None, None), (3, None, "en", "b", 0), (4, "", None, "b", 0),
        (None, text, "en", "c", 80), (None, None, None, None, None), (5, " \n\t\n ", "en", "c", 5), (6, long_text(), "en", "d", None),
        (6, "another text for the same id", "de", "d", 3), (7, "12 34 !!", "en", "e", 8), (8, "é" * 60 + "\n" + "é" * 60, "fr", "e", 121),
    ]
    df = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("extra") for c in EXTRA})


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def docs_of(spark):
    """docs_of({id: text}): a table of documents."""
    return lambda texts, lang="en": spark.createDataFrame(
        [(i, t, lang if isinstance(lang, str) else lang.get(i), "s", None if t is None else len(t)) for i, t in texts.items()], DOCS)
