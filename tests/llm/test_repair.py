import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from adledger.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
RIGHT = re.compile(r"(s?(ua)+)?")
BLANKS = " \t\n\x0b\x0c\r"


def hurt(rows):
    out = []
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
    return out


def faults(rows):
    """Rows of one conversation in order -> their first fault."""
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.rstrip(BLANKS)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def ordered(rows):
    digest = lambda t: hashlib.sha256(t.encode()).digest()[:16]
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], digest(r[3])))


def every_way(rows):
    """(cost, letters, repaired lines) of every sequence of edits, up to two inserts in a gap."""
    gaps = [[(3 * n, "I" * n, list(x)) for n in range(3) for x in itertools.product(["user:", "assistant:"], repeat=n)]]
    for (_, _, role, text), fault in zip(rows, faults(rows)):
        choices = [(4, "D", [])]
        if fault not in ("blank", "duplicate"):
            more = 3 if fault == "truncated" else 0
            choices += [(more, "K", [f"{role}:{text}"])] + [(3 + more, "R", [f"{r}:{text}"]) for r in ("user", "assistant")]
        gaps += [choices, gaps[0]]
    for way in itertools.product(*gaps):
        yield sum(c for c, _, _ in way), "".join(a for _, a, _ in way), [x for _, _, lines in way for x in lines]


def brute(rows):
    rows = ordered(rows)
    cost, audit, lines = min((c, a, lines) for c, a, lines in every_way(rows) if RIGHT.fullmatch("".join(x[:1] for x in lines)))
    found, turns = faults(rows), {r[1] for r in rows if r[1] is not None}
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def chained(rows):
    """The same by a plain shortest way over (row, state) with whole strings, for long conversations."""
    rows = ordered(rows)
    found = faults(rows)
    rest = {"z": (0, ""), "s": (6, "II"), "u": (3, "I"), "a": (0, "")}
    put = lambda letter, cost, way: (way[0] + cost, letter + way[1])
    for (_, _, role, _), fault in zip(reversed(rows), reversed(found)):
        new = {}
        for q, follows in (("z", "u"), ("s", "u"), ("u", "a"), ("a", "u")):
            ways = [put("D", 4, rest[q])]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault else 0
                ini = role[:1]
                if ini == follows or (ini == "s" and q == "z"):
                    ways.append(put("K", more, rest[ini]))
                ways.append(put("R", 3 + more, rest[follows]))
            new[q] = min(ways)
        once = {q: put("I", 3, new[f]) for q, f in (("z", "u"), ("s", "u"), ("u", "a"), ("a", "u"))}
        twice = put("I", 3, put("I", 3, new["a"]))
        rest = {q: min(new[q], once[q], *([twice] if q in "zs" else [])) for q in new}
    return rest["z"]


def made(r, n, conv=1, ties=False):
    roles = ["user", "assistant", "system", "tool", "User", "", None]
    rows = [(conv, None if r.random() < 0.05 else (r.randrange(4) if ties else t), r.choices(roles, [8, 8, 2, 1, 1, 1, 1])[0],
             r.choice(["yes.", "no", "what?", " ", "", "so so. ", "fine!\n", None, "a b c"])) for t in range(n)]
    return rows


def run(spark, rows, partitions=4, **names):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("extra") for c in ("conv", "digest", "copies", "phase", "items", "head")})
    return {r[0]: tuple(r)[1:] for r in repair.repair(df.repartition(partitions), **names).collect()}


def spaced(rows):
    return [(c, t, " " if role is None else role, " " if text is None else text) for c, t, role, text in rows]


def test_equals_every_way(spark):
    r = random.Random(2)
    rows = [x for conv in range(40) for x in made(r, r.randrange(1, 4), conv, ties=conv % 3 == 0)]
    rows += [(100, t, "user", "same.") for t in range(3)] + [(101, 0, "system", "hm.")] + [(102, 5, "assistant", "x")]
    got = run(spark, rows)
    for conv in {x[0] for x in rows}:
        assert got[conv] == brute(spaced([x for x in rows if x[0] == conv])), conv


def test_damage(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"text {t}. more!") for c in range(60) for t in range(2)] + [(None, None, None, None), (7, None, "user", "x.")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("copies", F.lit("clash"))
    bad = repair.damage(df)
    assert sorted(map(str, (tuple(r)[:4] for r in bad.collect() for _ in range(r["copies"])))) == sorted(map(str, hurt(rows)))
    got = {r[0]: tuple(r)[1:] for r in repair.repair(bad, copies="copies").collect()}
    assert set(got) == {x[0] for x in rows}
    for conv in got:
        left = [x for x in hurt(rows) if x[0] == conv]
        assert got[conv] == (brute(left) if left else (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()))


@pytest.mark.parametrize("seed", range(2))
def test_long_conversation_spans_tasks(spark, monkeypatch, seed):
    """One conversation holds most rows: blocks of six, batches of 40, several tasks."""
    monkeypatch.setattr(repair, "BLOCK", 6)
    r = random.Random(seed)
    words = ["yes.", "no", " ", "fine."]
    rows = [(5, t if r.random() > 0.02 else None, r.choice(["user", "assistant", "system"]), f"{r.choice(words)}{'' if r.random() < 0.2 else str(t) + '.'}") for t in range(700)]
    rows += [x for conv in range(20) for x in made(r, 2, conv + 10)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = run(spark, rows)
        lines = repair.repaired(spark.createDataFrame(rows, SCHEMA)).filter("conv_id = 5").orderBy("position").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    own = [x for x in rows if x[0] == 5]
    assert got[5][5:7] == chained(spaced(own))
    found = faults(ordered(spaced(own)))
    assert got[5][1:4] == tuple(found.count(f) for f in ("blank", "duplicate", "truncated"))
    turns = {x[1] for x in own if x[1] is not None}
    assert got[5][0] == max(turns) - min(turns) + 1 - len(turns)
    text = "\n".join(f"{x['role']}:{x['text']}" for x in lines)
    assert hashlib.sha256(text.encode()).hexdigest() == got[5][7] and RIGHT.fullmatch("".join(x["role"][0] for x in lines))
    assert [x["position"] for x in lines] == list(range(len(lines)))
    for conv in range(10, 30):
        assert got[conv] == brute(spaced([x for x in rows if x[0] == conv]))


def test_chain_of_blocks_is_the_whole():
    """Cutting anywhere gives the same cost and letters."""
    r = random.Random(8)
    for _ in range(200):
        items = [repair.Item(r.randrange(4), r.choice([1, 1, 1, 3]), r.random() < 0.2, r.random() < 0.3) for _ in range(r.randrange(1, 12))]
        cuts = sorted({0, len(items), *(r.randrange(len(items) + 1) for _ in range(3))})
        parts = [items[a:b] for a, b in zip(cuts, cuts[1:])]
        cost, states = repair.route([repair.weigh(p) for p in parts], repair.START, [3 * repair.TAIL[q] for q in range(4)])
        letters = "".join(repair.letters_between(p, a, b) for p, a, b in zip(parts, [0, *states], states)) + "I" * repair.TAIL[states[-1]]
        assert (cost, letters) == repair.solve(items)
        whole = repair.weigh(parts[0])
        for p in parts[1:]:
            whole = repair.chain(whole, repair.weigh(p))
        assert whole == repair.weigh(items)


def test_many_equal_rows(spark):
    rows = [(1, 3, "user", "again.")] * 5000 + [(1, 1, "system", "be kind."), (1, 4, "assistant", "well.")]
    got = run(spark, rows)[1]
    assert got[:6] == (1, 0, 4999, 0, 4999, 4 * 4999) and got[6] == "KK" + "D" * 4999 + "K"


def test_odd_tables(spark):
    assert run(spark, []) == {}
    long = "word " * 60_000
    rows = [(1, 0, "user", long + "."), (1, 1, "assistant", long), (None, None, None, None), (None, 1, "user", "a."), (2, None, "user", "x.")]
    got = run(spark, rows)
    for conv in (1, None, 2):
        assert got[conv] == brute(spaced([x for x in rows if x[0] == conv]))
    named = spark.createDataFrame([("a", 0, "u", "x.")], "c string, t int, r string, x string")
    assert [tuple(r)[:2] + tuple(r)[6:8] for r in repair.repair(named, "c", "t", "r", "x").collect()] == [("a", 0, 3, "KI")]
