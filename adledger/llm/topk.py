"""Exact top-k inner-product search with norm-bucketed retrieval.

Components become integers floor(1024 x). Vectors of one dimension and about one length
form a bucket; buckets are cut into blocks of some thousand vectors, queries into smaller
blocks. A first pass probes the blocks with the longest vectors and gives every query a
score that its k-th best cannot fall below. From it follows, per query and block, a local
cosine threshold: above 1 the block is left out; a high one selects candidates by the
range their coordinates on the query's strongest axes must lie in; a low one keeps those
that are long enough. What remains is verified with exact integer products.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SCALE = 1024
#: Vectors in one bucket differ in length by at most this factor.
BAND = 1.1
#: Number of strongest axes coordinate pruning looks at, and the threshold it starts from.
AXES, HIGH = 3, 0.6
#: Relative room for rounding; pruning may only keep too much.
SLACK = 1e-9
SPREAD = 32
#: Length bands up to which their sizes are sent to every executor.
SENT_BANDS = 100_000


def scaled(vector: Column) -> Column:
    """floor(1024 x) of every component as doubles, exact: from 2^53 on a double is whole anyway."""
    y = lambda x: x.cast("double") * SCALE
    return F.transform(vector, lambda x: F.when(F.abs(y(x)) < 2.0**53, F.floor(y(x)).cast("double")).otherwise(y(x)))


def usable(vector: Column) -> Column:
    """Not null, no null component, every component finite. Only doubles of 2^500 and more, whose
    squares no double holds, are left out; a float never comes near."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & (F.coalesce(F.abs(x.cast("double")) < 2.0**500, F.lit(False)) & ~F.isnan(x)))


def pack(number: str):
    """Rows of one block -> one row of packed ids, vectors and floors, longest vector first."""

    def run(group: pa.Table) -> pa.Table:
        ids, floors = (group.column(n).to_numpy() for n in ("id", "floor"))
        vectors = group.column("vec").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        lengths = np.sqrt((vectors**2).sum(axis=1))
        rank = np.lexsort((ids, -lengths))
        packed = [x[rank].tobytes() for x in (ids, vectors, floors)]
        return pa.table({"dim": group.column("dim")[:1], number: group.column(number)[:1], "longest": [float(lengths.max())],
                         "least": [float(floors.min())], **{n: [x] for n, x in zip(("ids", "vecs", "floors"), packed)}})

    return run


def blocked(rows: DataFrame, per_block: int, number: str) -> DataFrame:
    """rows(id, dim, vec, len2, floor) packed into blocks of about per_block vectors of one
    dimension and one length band."""
    band = F.floor(F.log(F.greatest("len2", F.lit(1.0))) / F.log(F.lit(BAND**2))).cast("int")
    rows = rows.withColumn("band", band)
    sizes = stored(rows.groupBy("dim", "band").agg(F.count("*").alias("n")), "bands")
    if sizes.count() <= SENT_BANDS:  # else there are too many bands for one to be large
        sizes = F.broadcast(sizes)
    cut = F.pmod(F.xxhash64("id", F.lit(11)), F.ceil(F.col("n") / per_block)).cast("int")
    return (rows.join(sizes, ["dim", "band"]).withColumn(number, F.struct("band", cut.alias("part")))
            .select("dim", number, "id", "vec", "floor").groupBy("dim", number).applyInArrow(
                pack(number), f"dim int, {number} struct<band:int,part:int>, longest double, least double, "
                              "ids binary, vecs binary, floors binary"))


def dot(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles while every partial sum stays below 2^53."""
    if np.abs(queries).max(initial=0) * np.abs(candidates).max(initial=0) * max(1, queries.shape[-1]) < 2.0**53:
        return (queries @ candidates.T).astype(np.int64)
    whole = lambda x: np.array([int(v) for v in x.ravel()], object).reshape(x.shape)
    wide = whole(queries) @ whole(candidates).T
    return np.clip(wide, -(2**63), 2**63 - 1).astype(np.int64)


def best_of_block(qids, queries, floors, ids, vectors, k):
    """(query id, vec id, score) of each query's k best in one block, given its lower bound.

    ``floors`` may be -inf. Candidates that score below a query's floor may be left out.
    """
    lengths = np.sqrt((vectors**2).sum(axis=1))
    own = np.sqrt((queries**2).sum(axis=1))
    longest = lengths.max(initial=0)
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(own * longest > 0, floors / (own * longest), np.where(floors > 0, np.inf, -np.inf))
    unit = vectors / np.where(lengths > 0, lengths, 1)[:, None]
    out = []

    def keep(i, which, scores):
        other = ids[which] != qids[i]
        which, scores = which[other], scores[other]
        which, scores = (x[scores >= floors[i]] for x in (which, scores))
        if len(which) > k:
            part = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            which, scores = which[part], scores[part]
        first = np.lexsort((ids[which], -scores))[:k]
        out.append((np.full(len(first), qids[i]), ids[which][first], scores[first]))

    by_length = np.flatnonzero((local <= 1 + SLACK) & (local < HIGH))
    if len(by_length):
        needed = np.where(own[by_length] > 0, floors[by_length] / np.where(own[by_length] > 0, own[by_length], 1), -np.inf).min()
        reach = int((lengths >= needed - abs(needed) * SLACK).sum()) if np.isfinite(needed) else len(ids)
        scores = dot(queries[by_length], vectors[:reach])
        for row, i in enumerate(by_length):
            keep(i, np.arange(reach), scores[row])
    for i in np.flatnonzero((local >= HIGH) & (local <= 1 + SLACK)):
        q, t = queries[i] / own[i], min(1.0, local[i]) - SLACK
        inside = np.ones(len(ids), bool)
        for axis in np.argsort(-np.abs(q))[:AXES]:
            room = np.sqrt(max(0.0, (1 - t * t) * (1 - q[axis] ** 2))) + SLACK
            inside &= (unit[:, axis] <= q[axis] * t + room if q[axis] < t else True) & (unit[:, axis] >= q[axis] * t - room if q[axis] > -t else True)
        which = np.flatnonzero(inside)
        keep(i, which, dot(queries[i:i + 1], vectors[which])[0])
    return out


def verify(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                at = {n: batch.column(n)[r].as_py() for n in batch.schema.names}
                qids, ids = (np.frombuffer(at[n], "<i8") for n in ("q_ids", "ids"))
                queries, vectors = (np.frombuffer(at[n], "<f8").reshape(len(i), at["dim"]) for n, i in (("q_vecs", qids), ("vecs", ids)))
                found = best_of_block(qids, queries, np.frombuffer(at["floors"], "<f8"), ids, vectors, k)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], schema=schema)

    return run


def kth_scores(found: DataFrame, k: int) -> DataFrame:
    """The k best of every query, ranked."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def top_k(df: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding",
          per_block: int = 8192, queries_per_block: int = 512) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest integer products.

    Ties go to the smaller vec_id; a row is no candidate for a query of its own id. Rows
    with a null id or vector, or a null or non-finite component, take no part (nor do
    components beyond 2^42); products beyond a long are cut to its ends. Only vectors of
    equal dimension are compared. Rows that repeat an id count once, with the smallest
    vector. Block pairs, not rows, are joined: one row per pair of packed blocks.
    """
    rows = stored(
        df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("raw"), is_query.alias("asks"))
        .filter(F.col("id").isNotNull() & usable(F.col("raw"))).withColumn("vec", scaled(F.col("raw")))
        .groupBy("id").agg(F.min("vec").alias("vec"), F.max("asks").alias("asks"))
        .select("id", "asks", "vec", F.size("vec").alias("dim"), F.lit(float("-inf")).alias("floor"),
                F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x).alias("len2")), "vectors")
    blocks = stored(blocked(rows, per_block, "block").drop("least", "floors"), "blocks")
    directory = blocks.select("dim", "block", "longest").withColumn("nth", F.row_number().over(
        Window.partitionBy("dim").orderBy(F.desc("longest"), "block")))  # one row per block

    def probe(queries: DataFrame, pairs: DataFrame) -> DataFrame:
        """pairs(dim, qblock, block): the packed rows meet, each pair in a row of its own."""
        return (pairs.join(queries.select("dim", "qblock", F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs"), "floors"), ["dim", "qblock"])
                .join(blocks.drop("longest"), ["dim", "block"]).select("dim", "q_ids", "q_vecs", "floors", "ids", "vecs")
                .mapInArrow(verify(k), "query_id long, vec_id long, score long"))

    asked = rows.filter("asks")
    queries = blocked(asked, queries_per_block, "qblock")
    opening = stored(probe(queries, queries.select("dim", "qblock").join(directory.filter("nth = 1"), "dim").select("dim", "qblock", "block")), "opening")
    known = kth_scores(opening, k).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("known"))
    floored = stored(blocked(asked.join(known, "id", "left").withColumn(
        "floor", F.coalesce("known", "floor")).drop("known"), queries_per_block, "qblock"), "queries")
    # Pairs of blocks are drawn from the two directories, spread over a fixed number of parts.
    others = directory.filter("nth > 1").withColumn("spread", F.pmod("nth", F.lit(SPREAD)))
    pairs = (floored.select("dim", "qblock", F.col("longest").alias("q_longest"), "least")
             .withColumn("spread", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))).join(others, ["dim", "spread"])
             .filter(F.col("least") <= F.col("q_longest") * F.col("longest") * (1 + SLACK)).select("dim", "qblock", "block"))
    return kth_scores(opening.unionByName(probe(floored, pairs)), k).select("query_id", "rank", "vec_id", "score")
