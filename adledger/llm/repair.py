"""Repair of conversation structure by cheapest edits, decided on scalar integer weights.

A conversation is right when its role initials read ``(s?(ua)+)?``. Its rows, in order, are a
path through a small graph: Keep (0), Rerole (3), Delete (4; the only choice for a blank or
repeated row), Insert an empty turn anywhere (3), and 3 more for a truncated row that stays.
The weight of a rest of the way is one big integer: the high digits are its cost, the low
digits its edit letters in order, three bits each, in a field of fixed width whose unused end
is zero. The least integer is the cheapest way and, of several, the one with the least letters.

Scale: rows travel as keys (a digest for the text) and are sorted over all tasks by
conversation and turn, so a long conversation spans tasks. Each block of a conversation is
weighed once for every state it can be entered and left in. From one state no way through a
block is the beginning of another, so only their order is kept (``Block.rank``), blocks are
chained by small integers, and the choice goes back to the blocks. Texts move once, to the
place where their conversation is written out row by row, in one pass that holds one row at a
time; a digest of a whole conversation cannot be computed any other way.

Rows of one conversation are taken by turn, nulls first, then by role and by the digest of the
text. Equal rows count as one with a number of copies, of which all but the first are
duplicates. Null roles and texts are one space; null conversation ids are one conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

BLANKS = " \t\n\x0b\x0c\r"
#: Costs of the edits, and of leaving a truncated row in.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Letters in the order of their codes; code 0 is the padding.
LETTERS = "\0DIKR"
D, I, K, R = 1, 2, 3, 4
BITS = 3
#: States: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
OTHER = 0
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: A turn of this class may follow in these states.
KEEPS = {SYSTEM: (START,), USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,), OTHER: ()}
#: What is still to insert when the rows end.
TAIL = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
BLOCK = 256
HEAD = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


@dataclass
class Item:
    """A row and its copies: class of its role, how many, whether only deletion is allowed for
    the first (and then all), whether it is truncated."""

    kind: int
    copies: int
    forced: bool
    truncated: bool


class Weights:
    """Integers of one width: cost above ``digits`` letters."""

    def __init__(self, digits: int):
        self.shift = BITS * digits
        self.low = (1 << self.shift) - 1
        self.first = self.shift - BITS

    def edit(self, letter: int, cost: int, rest: int | None) -> int | None:
        """Put an edit before ``rest``."""
        if rest is None:
            return None
        return ((rest >> self.shift) + cost) << self.shift | letter << self.first | (rest & self.low) >> BITS

    def read(self, weight: int) -> tuple[int, str]:
        cost, letters = weight >> self.shift, []
        at = self.first
        while at >= 0 and (code := weight >> at & 7):
            letters.append(LETTERS[code])
            at -= BITS
        return cost, "".join(letters)


def least(*weights: int | None) -> int | None:
    return min((w for w in weights if w is not None), default=None)


def digits_for(items: list[Item]) -> int:
    """No way needs more letters: two inserts before a row, its own, one for its further copies, two at the end."""
    return 4 * len(items) + 2


def ways(items: list[Item], ends: list[int | None], w: Weights) -> list[int | None]:
    """Least weight from before the items to ``ends`` (weights of the rest by state behind them),
    by state before them. Nothing is inserted before a row that must go: after it is as cheap
    and its letter less."""
    rest = list(ends)
    for item in reversed(items):
        further = item.copies if item.forced else item.copies - 1
        if further:
            rest = [w.edit(D, DELETE * further, x) for x in rest]
        if item.forced:
            continue
        stays = TRUNCATED if item.truncated else 0
        after = [least(w.edit(D, DELETE, rest[q]), w.edit(K, stays, rest[item.kind]) if q in KEEPS[item.kind] else None,
                       w.edit(R, REROLE + stays, rest[NEXT[q]])) for q in range(4)]
        user, assistant = w.edit(I, INSERT, after[USER]), w.edit(I, INSERT, after[ASSISTANT])
        both = w.edit(I, INSERT, assistant)
        rest = [least(after[START], user, both), least(after[SYSTEM], user, both), least(after[USER], assistant), least(after[ASSISTANT], user)]
    return rest


def tail(w: Weights) -> list[int | None]:
    """Weights at the end of a conversation."""
    ends = []
    for q in range(4):
        weight: int | None = 0
        for _ in range(TAIL[q]):
            weight = w.edit(I, INSERT, weight)
        ends.append(weight)
    return ends


def solve(items: list[Item]) -> tuple[int, str]:
    """(cost, letters) of a whole conversation; a run of further copies is one letter."""
    w = Weights(digits_for(items))
    return w.read(ways(items, tail(w), w)[START])


@dataclass
class Block:
    """cost[q][r], and the place of the letters of q -> r among those of q (-1: no such way)."""

    cost: list[list[int]]
    rank: list[list[int]]


def weigh(items: list[Item]) -> Block:
    w = Weights(digits_for(items))
    columns = [ways(items, [0 if q == r else None for q in range(4)], w) for r in range(4)]
    cost, rank = [[-1] * 4 for _ in range(4)], [[-1] * 4 for _ in range(4)]
    for q in range(4):
        found = sorted((columns[r][q] & w.low, r) for r in range(4) if columns[r][q] is not None)
        for place, (_, r) in enumerate(found):
            cost[q][r], rank[q][r] = columns[r][q] >> w.shift, place
    return Block(cost, rank)


def chain(first: Block, second: Block) -> Block:
    """Two blocks as one: per entry and exit the least cost, then the least letters."""
    cost, rank = [[-1] * 4 for _ in range(4)], [[-1] * 4 for _ in range(4)]
    for q in range(4):
        order = []
        for r in range(4):
            choice = min(((first.cost[q][m] + second.cost[m][r], first.rank[q][m], second.rank[m][r])
                          for m in range(4) if first.cost[q][m] >= 0 and second.cost[m][r] >= 0), default=None)
            if choice:
                cost[q][r] = choice[0]
                order.append((choice[1:], r))
        for place, (_, r) in enumerate(sorted(order)):
            rank[q][r] = place
    return Block(cost, rank)


def route(blocks: list[Block], start: int, ends: list[int | None]) -> tuple[int, list[int]]:
    """(cost, state behind every block) of the least way from ``start``; ``ends`` are costs behind the last."""
    rest, steps = list(ends), []
    for block in reversed(blocks):
        choice = []
        for q in range(4):
            choice.append(min(((block.cost[q][r] + rest[r], block.rank[q][r], r) for r in range(4) if block.cost[q][r] >= 0 and rest[r] is not None), default=None))
        steps.append([c[2] if c else -1 for c in choice])
        rest = [c[0] if c else None for c in choice]
    states, q = [], start
    for step in reversed(steps):
        q = step[q]
        states.append(q)
    return rest[start], states


def letters_between(items: list[Item], start: int, end: int) -> str:
    w = Weights(digits_for(items))
    return w.read(ways(items, [0 if q == end else None for q in range(4)], w)[start])[1]


def carry_out(items: list[Item], letters: str, start: int, more: int) -> list[tuple[str, str | None, list[str], list[str]]]:
    """Per item: its audit letters, its role ('' to keep its own, None if it goes), roles inserted
    before it, and behind it (the last one has ``more``)."""
    out, at, state = [], 0, start
    for n, item in enumerate(items):
        before, audit, role = [], "", None
        if not item.forced:
            while letters[at] == "I":
                state = NEXT[state]
                before.append(NAMES[state])
                at += 1
            audit = letters[at]
            if audit == "K":
                state, role = item.kind, ""
            elif audit == "R":
                state = NEXT[state]
                role = NAMES[state]
            at += 1
        further = item.copies if item.forced else item.copies - 1
        at += 1 if further else 0
        behind = []
        if n == len(items) - 1:
            for _ in range(more):
                state = NEXT[state]
                behind.append(NAMES[state])
        out.append(("I" * len(before) + audit + "D" * further + "I" * len(behind), role, before, behind))
    return out


def legal(first: int, second: int) -> bool:
    return (first, second) in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))


@dataclass
class Counts:
    """What is counted over rows in order: faults, illegal neighbours, distinct turns, and the borders."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    first_kind: int | None = None
    last_kind: int | None = None

    def join(self, other: Counts) -> Counts:
        """The same over these rows and then ``other``'s."""
        if other.first_kind is None or self.first_kind is None:
            return other if self.first_kind is None else self
        return Counts(self.blank + other.blank, self.duplicate + other.duplicate, self.truncated + other.truncated,
                      self.illegal + other.illegal + (not legal(self.last_kind, other.first_kind)),
                      self.turns + other.turns - (self.last_turn is not None and self.last_turn == other.first_turn),
                      other.first_turn if self.first_turn is None else self.first_turn,
                      self.last_turn if other.last_turn is None else other.last_turn, self.first_kind, other.last_kind)

    def head(self, cost: int) -> tuple[int, ...]:
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost


def count(items: list[Item], blank: list[bool], turns: list[int | None]) -> Counts:
    c = Counts()
    for item, empty, turn in zip(items, blank, turns):
        c = c.join(Counts(
            blank=item.copies if empty else 0, duplicate=0 if empty else item.copies - (not item.forced), truncated=int(item.truncated),
            illegal=item.copies - 1, turns=int(turn is not None), first_turn=turn, last_turn=turn, first_kind=item.kind, last_kind=item.kind))
    return c


# ---- tables -------------------------------------------------------------------------------

ITEM = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("digest", pa.binary()), ("copies", pa.int64()),
                  ("blank", pa.bool_()), ("first", pa.bool_()), ("open", pa.bool_())])
ITEM_SQL = "struct<turn:bigint,role:string,digest:binary,copies:bigint,blank:boolean,first:boolean,open:boolean>"
COUNTS_SQL = ("struct<blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint,turns:bigint,"
              "first_turn:bigint,last_turn:bigint,first_kind:bigint,last_kind:bigint>")
COUNTS = pa.struct([(n, pa.int64()) for n in Counts.__dataclass_fields__])
HEAD_SQL = f"struct<{','.join(f'{n}:bigint' for n in HEAD)}>"
HEAD_TYPE = pa.struct([(n, pa.int64()) for n in HEAD])
LINE_SQL = "audit string, kept string, before array<string>, behind array<string>"
DECIDED_SQL = f"head {HEAD_SQL}, turn bigint, role string, digest binary, {LINE_SQL}"
OPEN_SQL = f"part int, number int, cost array<int>, rank array<int>, counts {COUNTS_SQL}, items array<{ITEM_SQL}>"


def items_of(rows: list[dict]) -> list[Item]:
    return [Item(INITIALS.get(r["role"][:1], OTHER), r["copies"], r["blank"] or not r["first"], r["open"] and r["first"] and not r["blank"]) for r in rows]


def counted(rows: list[dict], items: list[Item]) -> Counts:
    return count(items, [r["blank"] for r in rows], [r["turn"] for r in rows])


def flat(block: Block) -> tuple[list[int], list[int]]:
    return [x for row in block.cost for x in row], [x for row in block.rank for x in row]


def folded(cost: list[int], rank: list[int]) -> Block:
    return Block([cost[i:i + 4] for i in range(0, 16, 4)], [rank[i:i + 4] for i in range(0, 16, 4)])


class Out:
    """Rows of the worked table, column by column."""

    def __init__(self, conv: pa.DataType):
        self.types = {
            "conv": conv, "head": HEAD_TYPE, "turn": pa.int64(), "role": pa.string(), "digest": pa.binary(), "audit": pa.string(), "kept": pa.string(),
            "before": pa.list_(pa.string()), "behind": pa.list_(pa.string()), "part": pa.int32(), "number": pa.int32(), "cost": pa.list_(pa.int32()),
            "rank": pa.list_(pa.int32()), "counts": COUNTS, "items": pa.list_(ITEM)}
        self.rows: list[dict] = []

    def decided(self, conv, rows: list[dict], items: list[Item], letters: str, start: int, more: int) -> None:
        for row, (audit, kept, before, behind) in zip(rows, carry_out(items, letters, start, more)):
            self.rows.append({"conv": conv, "turn": row["turn"], "role": row["role"], "digest": row["digest"], "audit": audit, "kept": kept, "before": before, "behind": behind})

    def batch(self, names: list[str] | None = None) -> pa.RecordBatch:
        names = names or list(self.types)
        made = pa.record_batch([pa.array([r.get(n) for r in self.rows], self.types[n]) for n in names], names=names)
        self.rows = []
        return made


def settle(conv_type: pa.DataType):
    """Rows sorted by conversation -> decisions for conversations that lie inside one batch, blocks of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, out = TaskContext.get().partitionId(), 0, Out(conv_type)
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column(0).dictionary_encode(null_encoding="encode")
            at = np.append(np.flatnonzero(np.diff(conv.indices.to_numpy(zero_copy_only=False), prepend=-1)), batch.num_rows)
            every = batch.select(range(1, batch.num_columns)).to_pylist()
            for start, stop in zip(at[:-1].tolist(), at[1:].tolist()):
                name = batch.column(0)[start].as_py()
                if start > 0 and stop < batch.num_rows:
                    rows = every[start:stop]
                    items = items_of(rows)
                    cost, letters = solve(items)
                    bare = letters.rstrip("I")
                    out.rows.append({"conv": name, "head": dict(zip(HEAD, counted(rows, items).head(cost)))})
                    out.decided(name, rows, items, bare, START, len(letters) - len(bare))
                    continue
                for cut in range(start, stop, BLOCK):
                    rows = every[cut:min(cut + BLOCK, stop)]
                    items = items_of(rows)
                    cost, rank = flat(weigh(items))
                    out.rows.append({"conv": name, "part": part, "number": number, "cost": cost, "rank": rank, "counts": vars(counted(rows, items)), "items": rows})
                    number += 1
            yield out.batch()

    return run


SUMMARY = ["conv", "part", "number", "cost", "rank", "counts"]


def read_blocks(table: pa.Table, order: str) -> tuple[list[dict], list[Block]]:
    rows = sorted(table.to_pylist(), key=lambda r: r[order])
    return rows, [folded(r["cost"], r["rank"]) for r in rows]


def join_blocks(conv_type: pa.DataType):
    """Blocks of one conversation in one task -> one."""

    def run(group: pa.Table) -> pa.Table:
        rows, blocks = read_blocks(group, "number")
        whole, counts = blocks[0], Counts(**rows[0]["counts"])
        for row, block in zip(rows[1:], blocks[1:]):
            whole, counts = chain(whole, block), counts.join(Counts(**row["counts"]))
        cost, rank = flat(whole)
        out = Out(conv_type)
        out.rows.append({**{n: rows[0][n] for n in ("conv", "part", "number")}, "cost": cost, "rank": rank, "counts": vars(counts)})
        return pa.Table.from_batches([out.batch(SUMMARY)])

    return run


def choose(conv_type: pa.DataType):
    """All parts of one conversation, one row each -> the states each is entered and left in, and the counts."""

    def run(group: pa.Table) -> pa.Table:
        rows, blocks = read_blocks(group, "part")
        counts = Counts()
        for row in rows:
            counts = counts.join(Counts(**row["counts"]))
        cost, states = route(blocks, START, [INSERT * TAIL[q] for q in range(4)])
        out = Out(conv_type)
        for n, (row, before, behind) in enumerate(zip(rows, [START, *states], states)):
            out.rows.append({"conv": row["conv"], "part": row["part"], "rank": [before, behind, TAIL[behind] if n == len(rows) - 1 else 0],
                             "head": dict(zip(HEAD, counts.head(cost))) if n == 0 else None})
        return pa.Table.from_batches([out.batch(["conv", "part", "rank", "head"])])

    return run


DECIDED = ["conv", "head", "turn", "role", "digest", "audit", "kept", "before", "behind"]


def decide(conv_type: pa.DataType):
    """Blocks of one conversation in one task, and the row of ``choose`` for them -> decisions."""

    def run(group: pa.Table) -> pa.Table:
        chosen = group.filter(pa.compute.is_null(group.column("items"))).to_pylist()[0]
        rows, blocks = read_blocks(group.filter(pa.compute.is_valid(group.column("items"))), "number")
        state, last, more = chosen["rank"]
        _, states = route(blocks, state, [0 if q == last else None for q in range(4)])
        out = Out(conv_type)
        if chosen["head"] is not None:
            out.rows.append({"conv": chosen["conv"], "head": chosen["head"]})
        for n, (row, behind) in enumerate(zip(rows, states)):
            items = items_of(row["items"])
            out.decided(row["conv"], row["items"], items, letters_between(items, state, behind), state, more if n == len(rows) - 1 else 0)
            state = behind
        return pa.Table.from_batches([out.batch(DECIDED)])

    return run


def told(batches: Iterator[pa.RecordBatch], conv: str):
    """Sorted decisions and texts -> ('head', conversation, counts) first for each conversation, then
    ('edit', letters) and ('line', role, text, edit) in order."""
    head_seen, name, have, pending = False, None, False, None
    for batch in batches:
        for r in batch.to_pylist():
            if not have or r[conv] != name or (r[conv] is None) != (name is None):
                yield "conversation", r[conv], None, None
                have, name, pending, head_seen = True, r[conv], None, False
            if r["phase"] == 0:
                if r["head"] is not None and not head_seen:
                    head_seen = True
                    yield "head", r["head"], None, None
                continue
            key = (r["turn"], r["role"], r["digest"])
            if r["text"] is None:
                yield "edit", r["audit"], None, None
                for role in r["before"] or ():
                    yield "line", role, "", "insert"
                if r["kept"] is None:
                    pending = None
                    for role in r["behind"] or ():
                        yield "line", role, "", "insert"
                else:
                    pending = (key, r["kept"], r["behind"] or ())
            elif pending and pending[0] == key:
                yield "line", pending[1] or r["role"], r["text"], "rerole" if pending[1] else "keep"
                for role in pending[2]:
                    yield "line", role, "", "insert"
                pending = None


def report(conv: str, conv_type: pa.DataType):
    names = [conv, *HEAD, "audit", "repaired_sha256"]
    types = [conv_type, *[pa.int64()] * len(HEAD), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, name, head, audit, digest, lines = [], None, None, [], None, 0

        def close():
            rows.append((name, *(head[n] for n in HEAD), "".join(audit), digest.hexdigest()))

        for what, first, second, _ in told(batches, conv):
            if what == "conversation":
                if digest is not None:
                    close()
                name, head, audit, digest, lines = first, dict.fromkeys(HEAD, 0), [], hashlib.sha256(), 0
            elif what == "head":
                head = first
            elif what == "edit":
                audit.append(first)
            else:
                digest.update(f"{chr(10) if lines else ''}{first}:".encode())
                digest.update(second.encode())
                lines += 1
            if len(rows) >= 1000:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                rows = []
        if digest is not None:
            close()
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return run


def written(conv: str, conv_type: pa.DataType):
    names, types = [conv, "position", "role", "text", "edit"], [conv_type, pa.int64(), pa.string(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, name, position = [], 0, None, 0
        for what, first, second, edit in told(batches, conv):
            if what == "conversation":
                name, position = first, 0
            elif what == "line":
                rows.append((name, position, first, second, edit))
                position, size = position + 1, size + len(second) + 50
                if size > 1 << 22:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                    rows, size = [], 0
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return run


def damage(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, copies): the rows as a faulty export would leave them, by
    crc32("conv:turn") % 20: 0 drops the row (no copies), 1 empties the text, 2 removes its
    ends of sentences, 3 repeats it, 4 makes it the user's. Nulls are read as one space."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat_ws(":", blank(conv), blank(turn)).cast("binary")) % 20
    said = F.when(code == 1, "").when(code == 2, F.regexp_replace(blank(text), "[.!?]", "")).otherwise(blank(text))
    return conversations.select(conv, F.col(turn), F.when(code == 4, "user").otherwise(blank(role)).alias(role), said.alias(text),
                                F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("copies"))


def merged(rows: DataFrame, conv: str, turn: str, role: str, text: str, copies: str | None) -> DataFrame:
    """Decisions and texts of every conversation, dealt by conversation and in the order they are written out."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    said: Column = F.rtrim(F.col("text"), F.lit(BLANKS))
    every = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), spaced(role).alias("role"), spaced(text).alias("text"),
                        (F.col(copies) if copies else F.lit(1)).cast("long").alias("copies"))
    left = every.filter("copies > 0").select(
        "conv", "turn", "role", F.substring(F.unhex(F.sha2(F.col("text").cast("binary"), 256)), 1, 16).alias("digest"), "text", "copies")
    key = ["conv", "turn", "role", "digest"]
    slim = left.select(*key, "copies", (said == "").alias("blank"), (~F.substring(said, -1, 1).isin(".", "!", "?")).alias("open"))
    slim = slim.groupBy(*key, "blank", "open").agg(F.sum("copies").alias("copies"))
    firsts = slim.filter(~F.col("blank")).groupBy("conv", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("a"), "turn")).alias("f"))
    firsts = firsts.select("conv", F.col("f.turn").alias("turn"), "role", "digest", F.lit(False).alias("blank"), F.lit(False).alias("open"),
                           F.lit(0).cast("long").alias("copies"), F.lit(True).alias("first"))
    marked = slim.withColumn("first", F.lit(False)).unionByName(firsts).groupBy(*key).agg(
        F.sum("copies").alias("copies"), F.max("blank").alias("blank"), F.max("first").alias("first"), F.max("open").alias("open"))
    placed = marked.repartitionByRange(*key).sortWithinPartitions(*key)
    kind = rows.schema[conv].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    arrow, sql = to_arrow_type(kind), kind.simpleString()
    worked = stored(placed.mapInArrow(settle(arrow), f"conv {sql}, {DECIDED_SQL}, {OPEN_SQL}"), "settled")
    decided = worked.filter("items IS NULL").select(*DECIDED)
    open_ = worked.filter("items IS NOT NULL")
    pieces = open_.select(*SUMMARY).groupBy("conv", "part").applyInArrow(
        join_blocks(arrow), f"conv {sql}, part int, number int, cost array<int>, rank array<int>, counts {COUNTS_SQL}")
    chosen = pieces.groupBy("conv").applyInArrow(choose(arrow), f"conv {sql}, part int, rank array<int>, head {HEAD_SQL}")
    fields = ["conv", "part", "number", "cost", "rank", "head", "items"]
    gathered = open_.select(*fields).unionByName(chosen.select(*fields[:2], F.lit(None).cast("int").alias("number"), F.lit(None).cast("array<int>").alias("cost"),
                                                               "rank", "head", F.lit(None).cast(f"array<{ITEM_SQL}>").alias("items")))
    decided = decided.unionByName(gathered.groupBy("conv", "part").applyInArrow(decide(arrow), f"conv {sql}, {DECIDED_SQL}"))
    nothing = {n: F.lit(None) for n in ("head", "audit", "kept", "before", "behind", "text")}
    heads = every.select("conv").distinct().withColumns({"phase": F.lit(0), "turn": F.lit(None).cast("long"), "role": F.lit(None).cast("string"), "digest": F.lit(None).cast("binary")})
    told_ = decided.withColumn("phase", F.when(F.col("head").isNotNull(), 0).otherwise(1)).withColumn("text", F.lit(None).cast("string"))
    texts = left.filter(said != "").select("conv", F.lit(1).alias("phase"), "turn", "role", "digest", "text")
    order = ["conv", "phase", "turn", "role", "digest", "source"]
    every = None
    for number, part in enumerate((heads, told_, texts)):
        part = part.withColumns({n: c.cast(told_.schema[n].dataType) for n, c in nothing.items() if n not in part.columns}).withColumn("source", F.lit(number))
        every = part if every is None else every.unionByName(part)
    return every.repartition("conv").sortWithinPartitions(*order).withColumnRenamed("conv", conv)


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | None = None) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), one row per
    conversation. ``copies`` names a column that says how often a row stands in its place;
    a conversation whose rows all have none is returned with zeros and an empty audit.

    blank, duplicate, truncated: rows by their first fault. illegal: neighbours other than
    su, ua, au. gaps: turns missing between the first and the last. Turns are whole numbers.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = rows.schema[conv].dataType
    return merged(rows, conv, turn, role, text, copies).mapInArrow(
        report(conv, to_arrow_type(kind)), f"`{conv}` {kind.simpleString()}, {', '.join(f'{n} long' for n in HEAD)}, audit string, repaired_sha256 string")


def repaired(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | None = None) -> DataFrame:
    """(conv, position, role, text, edit): the rows of every repaired conversation, edit being
    keep, rerole or insert."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = rows.schema[conv].dataType
    return merged(rows, conv, turn, role, text, copies).mapInArrow(
        written(conv, to_arrow_type(kind)), f"`{conv}` {kind.simpleString()}, position long, role string, text string, edit string")
