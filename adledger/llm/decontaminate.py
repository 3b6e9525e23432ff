"""Benchmark decontamination over SimHash windows, with DataFrame operations only.

Texts become arrays of shingle hashes (five words; an item of fewer words is one shingle).
A window of a document has the size of a benchmark item. Only windows that begin at a
shingle of the benchmark are looked at: sliding any other window on to its next such
shingle loses nothing, so the best window is always among them. Window and item
fingerprints meet through Hamming blocks: within ``radius`` differing bits, one of
radius + 1 blocks is equal. What meets is verified by the exact similarity of the two
bags of shingles, the sum of smaller counts over the sum of larger ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

SHINGLE = 5
#: Benchmark rows up to which a lookup is sent to every executor (16 to 40 bytes a row).
SENT_ROWS = 1_000_000


def words_of(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def let(value: Column, use) -> Column:
    """use(value) with the value computed once: a plain column would be put in everywhere it
    is used, even inside the function that runs for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shingles_of(text: Column, width: int) -> Column:
    """Hashes of every ``width`` neighbouring words of a text; null when it has fewer."""
    run = lambda h: lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)])
    hashed = F.transform(words_of(text), lambda w: F.xxhash64(w))
    return let(hashed, lambda h: F.when(F.size(h) >= width, F.transform(F.sequence(F.lit(0), F.size(h) - width), run(h))))


def simhash(shingles: Column) -> Column:
    """64-bit SimHash of an array of hashes: the majority of every bit."""
    bit = lambda h, b: F.call_function("shiftright", h, b).bitwiseAND(F.lit(1)).cast("int")
    ones = lambda s: F.aggregate(s, F.array_repeat(F.lit(0), 64), lambda acc, h: F.transform(acc, lambda n, b: n + bit(h, b)))
    raised = lambda n, b, size: F.when(n * 2 > size, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))
    bits = F.transform(ones(shingles), lambda n, b: raised(n, b, F.size(shingles)))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda acc, x: acc.bitwiseOR(x))


def blocks(fingerprint: str, radius: int) -> list[Column]:
    """radius + 1 neighbouring blocks of the bits."""
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    return [F.shiftrightunsigned(fingerprint, low).bitwiseAND(F.lit((1 << (high - low)) - 1)) for low, high in zip(cuts, cuts[1:])]


def weighted_similarity(a: Column, b: Column) -> Column:
    """Sum of smaller over sum of larger counts of two bags of hashes."""
    count = lambda bag, x: F.size(F.filter(bag, lambda y: y == x))
    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    bags = F.aggregate(F.array_distinct(b), F.lit(0), lambda acc, x: acc + F.least(count(a, x), count(b, x)))
    both = F.when(plain, F.size(F.array_intersect(a, b))).otherwise(bags)
    return both / (F.size(a) + F.size(b) - both)


def sent(df: DataFrame) -> DataFrame:
    """A lookup made from the benchmark: sent to every executor if its counted size allows,
    else joined by a shuffle."""
    return F.broadcast(df) if df.count() <= SENT_ROWS else df


def matches(docs: DataFrame, items: DataFrame, text: str = "text", order: str = "doc_id", item_id: str = "item_id", item_text: str = "text",
            similarity: float = 0.8, radius: int = 16) -> DataFrame:
    """(doc_id, text_hash, item_id, similarity, distance): every document and item with a
    window of at least that similarity whose fingerprints differ in at most ``radius`` bits.

    Of several windows the most similar counts. Texts and items that are null or without
    words match nothing; repeated items match each for itself; documents equal in id and
    text give one row; a null id stays null. At a similarity of 0.8 fingerprints differ in
    about ten bits, at most 16 in 99 of 100 cases; equal passages always meet.
    """
    benchmark = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    benchmark = benchmark.withColumn("width", F.least(F.size(words_of(F.col("text"))), F.lit(SHINGLE))).filter("width > 0")
    found = None
    for width in sorted(r["width"] for r in benchmark.select("width").distinct().collect()):  # at most five
        known = stored(benchmark.filter(F.col("width") == width).select("item_id", shingles_of(F.col("text"), width).alias("shingles")), "items")
        known = stored(known.withColumns({"m": F.size("shingles"), "print": simhash(F.col("shingles"))}), "items")
        one = _matches(docs.select(F.col(order).alias("doc_id"), F.col(text).alias("text")), known, width, similarity, radius)
        found = one if found is None else found.unionByName(one)
    if found is None:
        return docs.sparkSession.createDataFrame([], docs.select(F.col(order).alias("doc_id")).schema).selectExpr(
            "doc_id", "0L AS text_hash", "0L AS item_id", "0D AS similarity", "0 AS distance")
    best = found.groupBy("doc_id", "text_hash", "item_id").agg(F.max(F.struct("similarity", (-F.col("distance")).alias("near"))).alias("best"))
    return best.select("doc_id", "text_hash", "item_id", "best.similarity", (-F.col("best.near")).alias("distance"))


def _matches(docs: DataFrame, known: DataFrame, width: int, similarity: float, radius: int) -> DataFrame:
    anchors = known.select(F.explode("shingles").alias("hash"), "m").distinct().groupBy("hash").agg(F.collect_set("m").alias("sizes"))
    cut = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), shingles_of(F.col("text"), width).alias("shingles"))
    # The outer form keeps the optimizer from computing the shingles once more for a filter.
    spread = cut.select("doc_id", "text_hash", "shingles", F.posexplode_outer("shingles").alias("at", "hash"))
    hits = spread.join(sent(stored(anchors, "anchors")), "hash").select("doc_id", "text_hash", "shingles", "at", F.explode("sizes").alias("m"))
    start = F.greatest(F.lit(0), F.least(F.col("at"), F.size("shingles") - F.col("m")))
    windows = hits.select("doc_id", "text_hash", "m", F.slice("shingles", start + 1, F.col("m")).alias("window"))
    windows = stored(windows.withColumn("print", simhash(F.col("window"))), "windows")
    keyed = lambda df: df.withColumn("keys", F.array(*blocks("print", radius)))
    left = keyed(windows).select("*", F.posexplode("keys").alias("block", "key"))
    right = keyed(known.select("item_id", "m", F.col("print").alias("print"), F.col("shingles").alias("item"))).select(
        "item_id", "m", "item", F.col("print").alias("item_print"), F.col("keys").alias("item_keys"), F.posexplode("keys").alias("block", "key"))
    met = left.join(sent(right), ["m", "block", "key"])
    # The first block that is equal speaks for the pair.
    first = ~F.exists(F.arrays_zip("keys", "item_keys", F.sequence(F.lit(0), F.lit(radius)).alias("b")),
                      lambda z: (z["keys"] == z["item_keys"]) & (z["b"] < F.col("block")))
    near = met.filter(first).withColumn("distance", F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))).filter(F.col("distance") <= radius)
    return near.withColumn("similarity", weighted_similarity(F.col("window"), F.col("item"))).filter(
        F.col("similarity") >= similarity).select("doc_id", "text_hash", "item_id", "similarity", "distance")


def clean(docs: DataFrame, items: DataFrame, text: str = "text", order: str = "doc_id", **options) -> DataFrame:
    """The documents without any match; columns stay as they are."""
    found = stored(matches(docs, items, text, order, **options).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct(), "leaks")
    return docs.join(found, F.col(order).eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__hash")), "left_anti")
