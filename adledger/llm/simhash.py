"""SimHash near-duplicates through a hierarchical index in Gray order.

Distinct fingerprints (copies are folded first) are dealt by two of five bit blocks: with
at most three differing bits, two blocks at least are equal, so every link meets under
some key. Inside a key the fingerprints are sorted by Gray rank and covered by a tree:
a node keeps the bits that all its fingerprints share and that its parent does not have
already. A search adds up the differing bits on its way down and leaves a whole group
as soon as the sum passes the radius; a group that must lie inside the radius is joined
without being visited. Keys with very many fingerprints are dealt again by blocks of
their remaining bits, until none is large. What leaves a key is a spanning forest, not
its pairs; components are then found on Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, text_bytes
from .components import connected

SEED = 42
FAN = 8
#: Pairs of a query and a node that a search holds at once, about.
PAIRS = 1 << 17
ALL = np.uint64(2**64 - 1)


# --- fingerprints ---------------------------------------------------------------------

def shingle_hashes(text: bytes, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of every shingle of the words of a text, in bounded arrays."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = text.lower().split()
    if not words:
        return
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    width = min(shingle, len(words))
    last = ends[width - 1:]
    for at in range(0, len(last), 65_536):
        yield np.array([digest(joined[s:e - 1], SEED) for s, e in zip(starts[at:at + 65_536], last[at:at + 65_536])],
                       np.uint64)


def fingerprint_of(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash as a signed long; 0 for a text without words."""
    ones, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, shingle):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    packed = np.packbits(2 * ones > n, bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprint(df: DataFrame, text: str = "text", into: str = "fingerprint", shingle: int = 3) -> DataFrame:
    """Add the fingerprint of every text as a long (null text: 0). Words are runs of bytes
    that are no ASCII blanks, with A-Z lower-cased; fewer words than a shingle form one."""

    @F.arrow_udf("long")
    def prints(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(t, shingle) for t in text_bytes(texts)], pa.int64())

    return df.withColumn(into, prints(F.col(text)))


# --- index ----------------------------------------------------------------------------

def gray_rank(values: np.ndarray) -> np.ndarray:
    """Rank of each value in the reflected Gray sequence."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Levels of nodes over fingerprints in Gray order, leaves first.

    At each level: ``shared`` masks the bits all fingerprints below agree on, ``pattern``
    holds those bits, ``own`` the part of the mask the parent does not have.
    """

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        shared, pattern = np.full(len(prints), ALL), prints
        self.levels = [[shared, pattern, shared]]
        while len(pattern) > 1:
            first = np.arange(0, len(pattern), FAN)
            agree = np.bitwise_and.reduceat(shared, first) & ~np.bitwise_or.reduceat(
                pattern ^ np.repeat(pattern[first], np.diff(np.append(first, len(pattern)))), first)
            self.levels[-1][2] = shared & ~np.repeat(agree, np.diff(np.append(first, len(pattern))))
            shared, pattern = agree, pattern[first] & agree
            self.levels.append([shared, pattern, shared])

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(level, query numbers, nodes): every fingerprint below such a node is within the
        radius of its query, and all that are appear once."""
        rows = np.arange(len(queries))
        waiting = [(len(self.levels) - 1, rows, np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64))]
        while waiting:
            depth, rows, nodes, apart = waiting.pop()
            shared, pattern, own = self.levels[depth]
            apart = apart + np.bitwise_count((queries[rows] ^ pattern[nodes]) & own[nodes])
            near = apart <= radius
            rows, nodes, apart = rows[near], nodes[near], apart[near]
            whole = apart + np.bitwise_count(~shared[nodes]) <= radius
            if whole.any():
                yield depth, rows[whole], nodes[whole]
                rows, nodes, apart = rows[~whole], nodes[~whole], apart[~whole]
            below = len(self.levels[depth - 1][1]) if depth else 0
            for start in range(0, len(rows) if depth else 0, PAIRS // FAN):  # a wide frontier goes on in parts
                part = slice(start, start + PAIRS // FAN)
                children = nodes[part, None] * FAN + np.arange(FAN)
                there = children < below
                now, far = (np.broadcast_to(x[part, None], children.shape)[there] for x in (rows, apart))
                waiting.append((depth - 1, now, children[there], far))


def forest(prints: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint (in Gray order) the number of the first one of its local component."""
    label = np.arange(len(prints))
    if len(prints) < 2:
        return label
    index = GrayIndex(prints)
    merged = [np.zeros(len(level[1]), bool) for level in index.levels]
    for start in range(0, len(prints), 512):
        left, right, found = [], [], 0
        for depth, rows, nodes in index.search(prints[start:start + 512], radius):
            span = FAN**depth
            left.append(rows + start)
            right.append(nodes * span)
            if depth:
                for node in np.unique(nodes[~merged[depth][nodes]]):  # its members all lie around one query
                    members = np.arange(node * span + 1, min((node + 1) * span, len(prints)))
                    left.append(np.full(len(members), node * span))
                    right.append(members)
                    merged[depth][node] = True
                    found += len(members)
            found += len(rows)
            if found > PAIRS:
                join(label, np.concatenate(left), np.concatenate(right))
                left, right, found = [], [], 0
        if found:
            join(label, np.concatenate(left), np.concatenate(right))
    return label


def join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the labels of linked members in place; labels stay flat and smallest."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(up := label[label], label):
            label[:] = up


# --- on Spark -------------------------------------------------------------------------

def block_masks(mask: int, blocks: int) -> list[int]:
    """The bits of a mask cut into so many neighbouring blocks."""
    bits = [i for i in range(64) if mask >> i & 1]
    cuts = [len(bits) * j // blocks for j in range(blocks + 1)]
    return [sum(1 << i for i in bits[x:y]) for x, y in zip(cuts, cuts[1:])]


def signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def refined(mask: int, radius: int) -> list[int]:
    """The mask with one more of radius + 1 blocks; none when fewer bits are left than that,
    for then all fingerprints that agree on the mask lie within the radius."""
    rest = ~mask % 2**64
    return [signed(mask | b) for b in block_masks(rest, radius + 1)] if rest.bit_count() > radius else []


def deal(prints: DataFrame, radius: int, most: int) -> DataFrame:
    """(fp) -> (mask, bits, fp): any two within the radius share some (mask, bits); no key
    holds more than ``most`` rows unless it has no bits left to split by."""
    blocks = block_masks(2**64 - 1, radius + 2)
    masks = [a | b for a, b in combinations(blocks, 2)]
    keyed = prints.select("fp", F.explode(F.array(*[F.lit(signed(m)) for m in masks])).alias("mask"))
    settled = None
    while True:
        keyed = keyed.withColumn("bits", F.col("fp").bitwiseAND(F.col("mask")))
        large = stored(keyed.groupBy("mask", "bits").agg(F.count("*").alias("n")).filter(F.col("n") > most)
                       .select("mask", "bits"), "large-keys")
        found = {r["mask"] for r in large.select("mask").distinct().collect()}
        finer = {m: refined(m % 2**64, radius) for m in found}
        if not any(finer.values()):
            return keyed if settled is None else settled.unionByName(keyed)
        rest = keyed.join(large, ["mask", "bits"], "left_anti")
        settled = rest if settled is None else settled.unionByName(rest)
        again = F.create_map(*[x for m, s in finer.items() for x in (F.lit(m), F.array(*map(F.lit, s or [m])))])
        keyed = keyed.join(large, ["mask", "bits"], "left_semi").select("fp", F.explode(again[F.col("mask")]).alias("mask"))


def link_keys(radius: int):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches):
        held = None
        for batch in batches:
            now = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("mask", "bits", "fp")]
            held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            new = np.flatnonzero((held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1])) + 1
            if len(new):  # the last key may go on in the next batch
                yield from links(held[2][:new[-1]], np.concatenate([[0], new]))
                held = [x[new[-1]:] for x in held]
        if held is not None and len(held[2]):
            yield from links(held[2], np.array([0, len(held[2])]))

    def links(prints, bounds):
        left, right = [], []
        sizes = np.diff(bounds)
        for i in np.flatnonzero(sizes > 1):
            own = prints[bounds[i]:bounds[i + 1]].view(np.uint64)
            own = own[np.argsort(gray_rank(own))]
            label = forest(own, radius)
            other = np.flatnonzero(label != np.arange(len(label)))
            left.append(own[other].view(np.int64))
            right.append(own[label[other]].view(np.int64))
        if left:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], schema=schema)

    return run


def near_duplicates(df: DataFrame, print_column: str = "fingerprint", order: str = "doc_id", into: str = "component_id",
                    group: str | None = None, radius: int = 3, most: int = 20_000) -> DataFrame:
    """Add the smallest ``order`` value reachable over links of at most ``radius`` bits, and
    into ``group``, if named, the smallest fingerprint of the component.

    Equal fingerprints are linked. Rows of a null id take part but never name a
    component (its name is null when all its ids are). Repeated rows each keep their row.
    Give it a narrow, stored table: it is read more than once.
    """
    firsts = stored(df.groupBy(F.col(print_column).alias("fp")).agg(F.min(order).alias("first")), "prints")
    edges = (deal(firsts.select("fp"), radius, most).repartition("mask", "bits").sortWithinPartitions("mask", "bits")
             .mapInArrow(link_keys(radius), "u long, v long"))
    linked = firsts.join(connected(edges), F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    named = linked.join(linked.groupBy("root").agg(F.min("first").alias("name")), "root").select(
        F.col("fp").alias("__fp"), F.col("name").alias("__name"), F.col("root").alias("__root"))
    out = df.drop(into, group or into).join(named, F.col(print_column) == F.col("__fp")).drop("__fp")
    out = out.withColumnRenamed("__name", into)
    return out.withColumnRenamed("__root", group) if group else out.drop("__root")


def keep_one(df: DataFrame, text: str = "text", order: str = "doc_id", shingle: int = 3, radius: int = 3) -> DataFrame:
    """Keep one document of each group, the one with the smallest id (a null id comes last;
    of rows with one id, the one whose text hashes lowest; of equal rows, any one).
    Columns and texts stay as they are; texts are moved once."""
    keys = {"__k1": F.xxhash64(order, text), "__k2": F.xxhash64(F.lit(1), order, text)}
    narrow = stored(fingerprint(df.select(F.col(order).alias("id"), F.col(text).alias("text"), *[
        c.alias(k) for k, c in keys.items()]), "text", "fp", shingle).select("id", "fp", *keys), "narrow")
    grouped = near_duplicates(narrow, "fp", "id", "name", "root", radius)
    kept = grouped.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", *keys)).alias("one")).select("one.__k1", "one.__k2")
    return df.withColumns(keys).join(kept, [*keys], "left_semi").dropDuplicates([*keys]).drop(*keys)
