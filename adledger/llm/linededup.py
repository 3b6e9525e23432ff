"""Line deduplication by a segment-partition edit join, with DataFrame operations only.

Equal lines are found by hash. For near ones every distinct line is cut into threshold + 1
segments: if two lines are within the threshold, one segment of the shorter stands in the
longer, shifted by little. Lines publish their segments under (length, segment number,
hash); for each length they may match they look up the substrings that multi-match-aware
selection leaves. Lines that meet are verified by banded bit-parallel edit distance.

A segment that very many lines share is not joined: the lines that share it are equal
there, so what is left of them must lie within the threshold too, and is cut into
segments again under the longer key, until no key is large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

THRESHOLD = 2
#: Shorter lines have no near ones: an edit or two makes another line of them.
LEAST = 24
#: A key whose lines would make more pairs than this is cut again.
MOST_PAIRS = 200_000
#: Rows up to which a counted lookup is sent to every executor.
SENT_ROWS = 500_000


# --- edit distance --------------------------------------------------------------------

def let(value: Column, use) -> Column:
    """use(value) with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def characters(text: Column) -> Column:
    return F.split(text, "")


def banded_distance(a: Column, b: Column, k: int = THRESHOLD) -> Column:
    """Edit distance of two texts whose lengths differ by at most k; right if it is at most k,
    else some number above k. 2 k + 1 bits hold a column of the band as steps up and down."""
    wide = 2 * k + 1
    mask, top = (1 << wide) - 1, 1 << 2 * k
    either = lambda *xs: _fold(lambda x, y: x.bitwiseOR(y), xs)
    keep = lambda x: x.bitwiseAND(F.lit(mask))

    def steps(p: Column, t: Column) -> Column:
        def step(state: Column, j: Column) -> Column:
            here = F.get(t, j)
            same = either(*[F.when(F.get(p, j - k + bit) == here, F.lit(1 << bit)).otherwise(F.lit(0)) for bit in range(wide)])
            up, down = state["up"], state["down"]
            return let(same, lambda pm: let(
                keep(either((pm.bitwiseAND(up) + up).bitwiseXOR(up), pm, down)), lambda d0: let(
                    keep(either(down, F.bitwise_not(either(d0, up)))), lambda right: F.struct(
                        keep(either(d0.bitwiseAND(up), F.bitwise_not(either(F.shiftright(d0, 1), right)))).alias("up"),
                        F.shiftright(d0, 1).bitwiseAND(right).alias("down"),
                        (state["d"] + F.when(d0.bitwiseAND(F.lit(top)) == 0, 1).otherwise(0)).alias("d")))))

        start = F.struct(F.lit(mask - (1 << k) + 1).alias("up"), F.lit(0).alias("down"), F.lit(k).alias("d"))
        below = F.lit(top - 1).bitwiseAND(F.call_function("shiftleft", F.lit(mask), F.size(p) - F.size(t) + k))
        return F.aggregate(F.sequence(F.lit(0), F.size(t) - 1), start, step, lambda s: s["d"] - F.bit_count(
            s["up"].bitwiseAND(below)) + F.bit_count(s["down"].bitwiseAND(below)))

    return let(characters(a), lambda p: let(characters(b), lambda t: steps(p, t)))


def letters(text: Column) -> Column:
    """(single, pairs): 64 parities of the characters and of the pairs of neighbours. An edit
    changes at most two characters and four pairs, so texts within k edits differ in at
    most 2 k and 4 k of these bits."""
    bit = lambda *xs: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(*xs), F.lit(64)).cast("int"))
    none = F.lit(0).cast("long")
    return let(characters(text), lambda c: F.aggregate(
        F.sequence(F.lit(0), F.size(c) - 1), F.struct(none.alias("single"), none.alias("pairs")), lambda acc, i: F.struct(
            acc["single"].bitwiseXOR(bit(F.get(c, i))).alias("single"),
            acc["pairs"].bitwiseXOR(bit(F.get(c, i), F.get(c, i + 1))).alias("pairs"))))


def broken_pieces(a: Column, b: Column, k: int, most: int = 32) -> Column:
    """How many of up to ``most`` short pieces of a stand nowhere within k characters of their
    place in b. An edit breaks one piece at most."""
    def count(n: Column) -> Column:
        pieces = F.greatest(F.lit(1), F.least(F.lit(most), F.call_function("div", n, F.lit(5)).cast("int")))
        edge = lambda i: F.call_function("div", n.cast("long") * i, pieces).cast("int")
        broken = lambda i: let(F.substring(a, edge(i) + 1, edge(i + 1) - edge(i)), lambda piece: ~_fold(lambda x, y: x | y, [
            (edge(i) + 1 + d > 0) & (F.substring(b, edge(i) + 1 + d, edge(i + 1) - edge(i)) == piece) for d in sorted(range(-k, k + 1), key=abs)]))
        return F.size(F.filter(F.sequence(F.lit(0), pieces - 1), broken))

    return let(F.length(a), count)


def _fold(join, columns) -> Column:
    out = columns[0]
    for c in columns[1:]:
        out = join(out, c)
    return out


# --- segments -------------------------------------------------------------------------

def segment(length: Column, i: int, parts: int) -> tuple[Column, Column]:
    """Start (from 1) and size of the i-th of ``parts`` nearly equal segments, longer ones last."""
    spare = length % parts
    base = F.call_function("div", length - spare, F.lit(parts)).cast("int")
    return F.lit(1) + base * i + F.greatest(F.lit(0), F.lit(i - parts) + spare), base + (spare >= parts - i).cast("int")


def shifts(i: int, longer: int, k: int) -> range:
    """Where segment i of a text may stand in one that is ``longer`` characters longer."""
    return range(max(-i, longer - (k - i)), min(i, longer + (k - i)) + 1)


def entries(path: Column, rest: Column, target: Column, role: int, longer: int, k: int, places: bool = True) -> list[Column]:
    """Keys of a text: as one of length ``target`` that others look up (role 0, with the shifted
    places of its own length), or as one that looks up those of length ``target`` (role 1).
    ``places`` adds where the segment stands."""
    out = []
    for i in range(k + 1):
        start, size = segment(target, i, k + 1)
        for shift in shifts(i, longer, k):
            part = F.substring(rest, start + shift, size)
            fields = [F.xxhash64(path, target, F.lit(i), part).alias("key"), F.lit(0 if role == 0 and shift == 0 else 1).alias("role")]
            if places:
                fields += [F.lit(longer).alias("longer"), (start + shift).alias("start"), size.alias("size")]
            out.append(F.struct(*fields))
    return out


def line_entries(line: str, length: str, k: int, places: bool = True) -> Column:
    """All entries of a whole line, as itself and against lines up to k characters shorter."""
    path, line, length = F.lit(0), F.col(line), F.col(length)
    return F.array(*entries(path, line, length, 0, 0, k, places),
                   *[e for d in range(1, k + 1) for e in entries(path, line, length - d, 1, d, k, places)])


def meeting(keyed: DataFrame) -> DataFrame:
    """Rows (key, id, role, ...) of keys that hold two lines, one of which can be looked up."""
    key = Window.partitionBy("key")
    marks = {"__low": F.min("id").over(key), "__high": F.max("id").over(key), "__role": F.min("role").over(key)}
    return keyed.withColumns(marks).filter("__low <> __high AND __role = 0").drop(*marks)


def rest_entries(k: int) -> Column:
    """Entries of what is left of a line (columns path, rest, role, longer)."""
    path, rest, length = F.col("path"), F.col("rest"), F.length("rest")
    out = F.when(F.col("role") == 0, F.array(*entries(path, rest, length, 0, 0, k)))
    for d in range(k + 1):
        out = out.when(F.col("longer") == d, F.array(*entries(path, rest, length - d, 1, d, k)))
    return out


def candidate_pairs(texts: DataFrame, live: DataFrame, k: int = THRESHOLD, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """(a, b), a < b: ids of lines that meet under some key and whose sizes and letters allow
    for k edits. texts(id, line, size, letters); live(key, id, role)."""
    marks = texts.select("id", "size", "letters.*")
    found, level = [], None
    while True:
        sizes = live.groupBy("key").agg(F.count("*").alias("n"), F.sum(1 - F.col("role")).alias("n0"))
        large = stored(sizes.filter(F.col("n") * F.col("n0") > most_pairs).select("key"), "large-segments")
        if large.isEmpty():
            found.append(_pairs(live, marks, k))
            break
        found.append(_pairs(live.join(large, "key", "left_anti"), marks, k))
        if level is None:  # the first keys were made without keeping the texts
            level = texts.select("id", F.col("line").alias("rest"), F.explode_outer(line_entries("line", "size", k)).alias("e")).select("id", "rest", "e.*")
        left = F.concat(F.expr("substring(rest, 1, start - 1)"), F.expr("substring(rest, start + size)"))
        shared = stored(level.join(large, "key", "left_semi").select(
            "id", "role", "longer", F.col("key").alias("path"), left.alias("rest")), "shared-segments")
        short = F.length("rest") - F.col("longer") < 2 * (k + 1)  # nothing left to cut: those lines differ in a few letters
        found.append(_pairs(shared.filter(short).select(F.col("path").alias("key"), "id", "role"), marks, k))
        level = stored(meeting(shared.filter(~short).select("id", "rest", F.explode_outer(rest_entries(k)).alias("e")).select(
            "id", "rest", "e.*")), "cut-again")
        live = level.select("key", "id", "role")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.distinct()


def _pairs(live: DataFrame, marks: DataFrame, k: int) -> DataFrame:
    """Pairs of a key are judged inside the join, so only what may be near leaves it."""
    marked = live.join(marks, "id")
    a = marked.filter("role = 0").select("key", *[F.col(c).alias(f"{c}_a") for c in ("id", *marks.columns[1:])])
    b = marked.select(F.col("key").alias("key_b"), "role", *[F.col(c).alias(f"{c}_b") for c in ("id", *marks.columns[1:])])
    apart = lambda c: F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b")))
    near = (F.abs(F.col("size_a") - F.col("size_b")) <= k) & (apart("single") <= 2 * k) & (apart("pairs") <= 4 * k)
    once = (F.col("id_a") < F.col("id_b")) | ((F.col("role") == 1) & (F.col("id_a") != F.col("id_b")))
    met = a.join(b, (F.col("key") == F.col("key_b")) & once & near)
    return met.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"))


# --- lines of documents ---------------------------------------------------------------

PLACE = ("d0", "d1", "d2", "line_no")


def _identity(text: str, order: str) -> dict[str, Column]:
    return {"d0": F.col(order).isNull(), "d1": F.coalesce(F.col(order).cast("long"), F.lit(0)), "d2": F.xxhash64(F.coalesce(text, F.lit("")))}


def identified(docs: DataFrame, text: str, order: str) -> DataFrame:
    """(d0, d1, d2, text): whether the id is null, the id, and a hash of the text. In this order
    documents come first or later; rows equal in both are one document."""
    return docs.select(*[c.alias(n) for n, c in _identity(text, order).items()], F.col(text).alias("text"))


def lines_of(docs: DataFrame, least: int) -> DataFrame:
    """(d0, d1, d2, line_no, line, size, h, h2) of the lines of identified documents that are long enough."""
    split = docs.select("d0", "d1", "d2", F.posexplode_outer(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("line_no", "line"))
    return split.withColumn("size", F.length("line")).filter(F.col("size") >= least).withColumns({"h": F.xxhash64("line"), "h2": F.xxhash64(F.lit(1), "line")})


def sent(df: DataFrame) -> DataFrame:
    """A stored lookup: sent to every executor if its counted size allows, else shuffled."""
    return F.broadcast(df) if df.count() <= SENT_ROWS else df


def line_links(docs: DataFrame, text: str = "text", order: str = "doc_id", k: int = THRESHOLD, least: int = LEAST,
               most_pairs: int = MOST_PAIRS, shortest: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Repeated lines (h, h2, first) with the place of their first copy, and links between
    different lines (h, h2, first of the later one; early_h, early_h2, early of the earlier one). Lines that
    are not blank repeat from ``shortest`` characters on, and are linked from ``least`` on."""
    lines = lines_of(identified(docs, text, order), least if shortest is None else min(shortest, least)).filter(
        (F.col("size") >= least) | F.col("line").rlike(r"(?U)\S"))
    repeated = stored(lines.groupBy("h", "h2").agg(F.min(F.struct(*PLACE)).alias("first"), F.count("*").alias("n"))
                      .filter("n > 1").drop("n"), "repeated-lines")
    first = lines.filter(F.col("size") >= least).join(sent(repeated), ["h", "h2"], "left").withColumn("place", F.struct(*PLACE)).filter(
        "first IS NULL OR first = place").withColumn("id", F.col("h"))
    keyed = first.select("id", F.explode_outer(line_entries("line", "size", k, places=False)).alias("e")).select("e.key", "id", "e.role")
    live = stored(meeting(keyed), "live-segments")
    met = stored(live.select("id").distinct(), "live-lines")
    texts = first.join(sent(met), "id", "left_semi").select("id", "h", "h2", "place", "line", "size").dropDuplicates(["h", "h2"])
    texts = stored(texts.withColumn("letters", letters(F.col("line"))), "live-texts")
    likely = stored(candidate_pairs(texts, live, k, most_pairs), "likely-pairs")
    side = lambda n: texts.drop("letters", "size").withColumnsRenamed({c: n if c == "id" else f"{c}_{n}" for c in texts.columns})
    close = likely.join(side("a"), "a").join(side("b"), "b").filter(
        F.when(broken_pieces(F.col("line_a"), F.col("line_b"), k) <= k, banded_distance(F.col("line_a"), F.col("line_b"), k) <= k).otherwise(False))
    late = F.col("place_a") > F.col("place_b")
    pick = lambda c, other=False: F.when(late != other, F.col(f"{c}_a")).otherwise(F.col(f"{c}_b"))
    links = close.select(pick("h").alias("h"), pick("h2").alias("h2"), pick("place").alias("first"), pick("place", True).alias("early"),
                         pick("h", True).alias("early_h"), pick("h2", True).alias("early_h2"))
    return repeated, stored(links, "line-links")


def dedup_lines(docs: DataFrame, text: str = "text", order: str = "doc_id", k: int = THRESHOLD, least: int = LEAST,
                most_pairs: int = MOST_PAIRS, shortest: int | None = None, every_copy: bool = False) -> DataFrame:
    """The documents without lines that repeat earlier ones. Columns n_lines, n_removed and
    n_links (links between a line of the document, as its first holder, and another line) are
    added or replaced. With ``every_copy``, n_links adds up the links of each different line of
    the document, whoever holds it first, and line_classes has the class ids (one for all
    equal lines) of its lines that are repeated or linked.

    A line of at least ``least`` characters goes if an equal one, or one within ``k`` edits,
    stands earlier: in a document with a smaller id (null last, equal ids by a hash of the
    text), or higher up in its own. With ``shortest``, lines from so many characters on that are
    not blank go if an equal one stands earlier. A line is judged against the lines of the input, whether those
    stay or not. Other lines keep their order. Null and empty texts have no line and stay;
    rows equal in id and text are one document and all stay alike.
    """
    repeated, links = line_links(docs, text, order, k, least, most_pairs, shortest)
    if every_copy:
        ends = F.explode(F.array(F.struct("h", "h2", F.lit(True).alias("late")), F.struct(F.col("early_h").alias("h"), F.col("early_h2").alias("h2"), F.lit(False).alias("late"))))
        near = stored(links.select(ends.alias("e")).groupBy("e.h", "e.h2").agg(F.max("e.late").alias("near"), F.count("*").alias("n")), "near-lines")
    else:
        near = stored(links.select("h", "h2").distinct().withColumn("near", F.lit(True)), "near-lines")
    again = F.col("first").isNotNull() & (F.col("first") != F.struct(*PLACE))
    met = [F.when(F.col("first").isNotNull() | F.col("near").isNotNull(), F.struct("h", "h2", F.coalesce("n", F.lit(0)).alias("n"))).alias("met")] if every_copy else []
    marked = lines_of(identified(docs, text, order), 0).drop("line").join(sent(repeated), ["h", "h2"], "left").join(sent(near), ["h", "h2"], "left").select(
        "d0", "d1", "d2", F.struct("line_no", (again | F.coalesce("near", F.lit(False))).alias("goes")).alias("line"), *met)
    flags = marked.groupBy("d0", "d1", "d2").agg(F.collect_set("line").alias("lines"), F.max("line.goes").alias("any"), *[F.collect_set(m).alias("met") for m in ["met"][:len(met)]])
    if every_copy:
        flags = flags.filter(F.col("any") | (F.size("met") > 0)).withColumn("lines", F.when(F.col("any"), F.col("lines")))
    else:
        flags = flags.filter("any")
    flags = flags.drop("any")
    linked = links.select(F.explode(F.array_distinct(F.array(*[F.struct(f"{c}.d0", f"{c}.d1", f"{c}.d2") for c in ("first", "early")]))).alias("d")).groupBy(
        "d.d0", "d.d1", "d.d2").agg(F.count("*").alias("n_links"))
    own = {f"__{d}": F.col(d) for d in ("d0", "d1", "d2")}
    if every_copy:
        found = flags.withColumn("n_links", F.aggregate("met", F.lit(0).cast("long"), lambda total, m: total + m["n"]))
    else:
        found = flags.join(linked, ["d0", "d1", "d2"], "full")
    classes = [F.array_sort(F.transform("met", lambda m: m["h"])).alias("__classes")] if every_copy else []
    found = found.select(*[c.alias(n) for n, c in own.items()], F.col("lines").alias("__lines"), F.col("n_links").alias("__links"), *classes)
    keys = dict(zip(own, _identity(text, order).values()))
    split = F.split(F.col(text), "\n", -1)
    stay = let(F.array_sort("__lines"), lambda f: F.filter(split, lambda x, i: ~F.get(f, i)["goes"]))
    gone = F.coalesce(F.size(F.filter("__lines", lambda x: x["goes"])), F.lit(0))
    counts = {"n_lines": F.when(F.length(text) > 0, F.size(split)).otherwise(0).cast("long"), "n_removed": F.when(
        F.col("__lines").isNull(), 0).otherwise(gone).cast("long"), "n_links": F.coalesce("__links", F.lit(0)).cast("long")}
    if every_copy:
        counts["line_classes"] = F.coalesce("__classes", F.array().cast("array<long>"))
    kept = F.when(F.col("__lines").isNull(), F.col(text)).otherwise(F.array_join(stay, "\n"))
    return docs.drop(*counts).withColumns(keys).join(found, [*keys], "left").withColumns({**counts, "__kept": kept}).withColumn(
        text, F.col("__kept")).drop(*keys, "__lines", "__links", "__kept", "__classes")
