"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds spans.

The patterns find e-mail addresses, IP addresses, payment cards and phone numbers. Their spans
in a bounded sample of documents, as they stand and respelled the way people hide such data
("name [at] host dot org", "192[.]0[.]2[.]1", a phone number without its country), train the
random field of ``semicrf``; all other numbers there are what it must leave alone. It then
chooses boundaries and kinds together over every whole text. Pattern spans always stay; a
span of the field is added where it touches none of them and its odds are high enough.

Nulls and odd rows: a null text has no spans; a null or repeated id is returned as it is, row
by row. A text of any length is handled whole, in linear time. Positions are code points. Other
columns are ignored. An empty table gives an empty result, and so no model.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .semicrf import KINDS, Model, Segment, decode, fit, regions

Span = tuple[int, int, int]  # kind, start, end
EMAIL, IP, CARD, PHONE = range(4)
# The patterns of the contract. A number's pattern starts where digits start.
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP_LIKE = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD_LIKE = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE_LIKE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

#: Digits with up to three separators between them: where candidates for numbers lie.
NUMBERS = re.compile(r"(?<![0-9])[+(]?[0-9]++(?:[\x20().\[\]/-]{0,3}[0-9]++)*+")
PIECE = re.compile(r"[0-9]+|[^0-9]")
AT = re.compile(r"@|\x20?[\[(]\x20?at\x20?[\])]\x20?|\x20at\x20", re.I)
DOT = r"(?:\.|\x20?[\[(]\x20?dot\x20?[\])]\x20?|\x20dot\x20)"
HOST = re.compile(rf"[A-Za-z0-9-]{{1,63}}(?:{DOT}[A-Za-z0-9-]{{1,63}}){{1,6}}", re.I)
HOST_END = re.compile(rf"{DOT}[A-Za-z0-9-]{{1,63}}", re.I)
#: A segment has at most so many runs of digits and separators, or characters before the "at".
MOST_PIECES, MOST_LOCAL = 48, 64
DIGITS = {CARD: (13, 19), PHONE: (7, 15), IP: (4, 12)}
#: Characters of context a training example keeps on either side.
CONTEXT = 40
#: Invented numbers of no person that training sees beside the corpus's own.
DECOYS = 210


def luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        d = int(d) * (1 + n % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def base_spans(text: str) -> list[Span]:
    """The patterns' spans, leftmost and not overlapping within a kind, by start and kind."""
    out: list[Span] = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        host = DOMAIN.match(text, at + 1) if start < at else None
        if host:
            end = host.end()
            out.append((EMAIL, start, end))
        at = text.find("@", max(at + 1, end))
    if DIGIT.search(text):
        for m in IP_LIKE.finditer(text):
            if all(map(byte, m.group().split("."))):
                out.append((IP, m.start(), m.end()))
        for m in CARD_LIKE.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((CARD, m.start(), m.end()))
        if "+" in text:
            for m in PHONE_LIKE.finditer(text):
                if 10 <= sum(map(str.isdigit, m.group())) <= 15:
                    out.append((PHONE, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], s[0], s[2]))


def around(c: str) -> str:
    return "edge" if not c else "letter" if c.isalpha() else "digit" if c.isdigit() else "space" if c.isspace() else c


def surroundings(text: str, start: int, end: int) -> list[str]:
    """Neighbouring characters, whether digits or letters go on behind one separator, and the word before."""
    left, right = text[start - 1:start] if start else "", text[end:end + 1]
    beyond_left = text[start - 2:start - 1] if start > 1 and not left.isalnum() else ""
    beyond_right = text[end + 1:end + 2] if right and not right.isalnum() else ""
    word = re.search(r"([A-Za-z]{2,16})[^A-Za-z0-9]{0,3}$", text[max(0, start - 20):start])
    return [f"l={around(left)}", f"r={around(right)}", f"ll={around(left)}{around(beyond_left)}", f"rr={around(right)}{around(beyond_right)}",
            f"w={word.group(1).lower() if word else ''}"]


def number_segments(text: str, low: int, high: int) -> Iterator[Segment]:
    """Candidates for IP addresses, cards and phone numbers within one run of numbers."""
    pieces = [(m.start() + low, m.group()) for m in PIECE.finditer(text[low:high])]
    numbers = [n for n, (_, p) in enumerate(pieces) if p[0].isdigit()]
    for i, first in enumerate(numbers):
        if len(pieces[first][1]) > 19:
            continue
        digits, shape = "", ""
        for j in range(i, len(numbers)):
            last = numbers[j]
            if last - first > MOST_PIECES or len(digits) + len(pieces[last][1]) > 19:
                break
            if j > i:
                shape += "".join(p for _, p in pieces[numbers[j - 1] + 1:last])
            digits += pieces[last][1]
            shape += str(len(pieces[last][1]))
            if len(digits) < 4:
                continue
            end = pieces[last][0] + len(pieces[last][1])
            starts = [first]
            if first and pieces[first - 1][1] in "+(":
                starts.append(first - 1)
            groups = j - i + 1
            separators = "".join(sorted({c for c in shape if not c.isdigit()}))
            for begin in starts:
                start = pieces[begin][0]
                if shape.count(")") != shape.count("(") + (begin < first and pieces[begin][1] == "("):
                    continue
                lead = pieces[begin][1] if begin < first else ""
                common = [f"n={len(digits)}", f"shape={lead}{shape}", f"sep={separators}", f"lead={lead}", f"groups={groups}", *surroundings(text, start, end)]
                for kind, (few, many) in DIGITS.items():
                    if not few <= len(digits) <= many:
                        continue
                    extra = []
                    if kind == IP:
                        parts = re.split(r"[^0-9]+", text[start:end])
                        if groups != 4 or lead or "." not in separators:
                            continue
                        extra = [f"bytes={all(map(byte, parts))}"]
                    elif kind == CARD:
                        if lead:
                            continue
                        extra = [f"luhn={luhn(digits)}", f"luhn={luhn(digits)},n={len(digits)}"]
                    else:
                        extra = [f"lead={lead},n={len(digits)}"]
                    yield Segment(start, end, kind, [f"{KINDS[kind]}:{f}" for f in ("", *common, *extra)])


def mail_segments(text: str) -> Iterator[Segment]:
    """Candidates for e-mail addresses around every "at" of any spelling."""
    for m in AT.finditer(text):
        start = m.start()
        floor = max(0, start - MOST_LOCAL)
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        host = HOST.match(text, m.end()) if start < m.start() else None
        if not host:
            continue
        starts = [start, *(i for i in range(start + 1, m.start()) if text[i - 1] in "._%+-" and text[i] not in "._%+-")]
        ends, at = [], re.match(r"[A-Za-z0-9-]+", host.group()).end() + host.start()
        while (label := HOST_END.match(text, at)) and label.end() <= host.end():
            at = label.end()
            ends.append(at)
        spelled = m.group().strip().lower()
        for begin in starts[:12]:
            for n, end in enumerate(ends):
                dots = re.findall(DOT, text[m.end():end], re.I)
                plain = all(d == "." for d in dots)
                if spelled == "at" and plain:
                    continue  # "look at home.Then": only a spelled dot makes this an address
                top = re.search(r"[A-Za-z0-9-]+$", text[m.end():end]).group()
                first = text[begin]
                yield Segment(begin, end, EMAIL, [f"email:{f}" for f in (
                    "", f"at={spelled}", f"dots={plain}", f"at={spelled},dots={plain}", f"labels={n + 1}", f"last={n + 1 == len(ends)}", f"whole={begin == start}",
                    f"top={top.isalpha()},{min(len(top), 6)}", f"first={around(first) if first.isalnum() else first}", *surroundings(text, begin, end))])


def candidates(text: str) -> list[Segment]:
    out = list(mail_segments(text))
    if DIGIT.search(text):
        for m in NUMBERS.finditer(text):
            piece = m.group()
            if len(piece) >= 7 and (piece.count(".") > 2 or sum(map(str.isdigit, piece)) > 6):
                out += number_segments(text, m.start(), m.end())
    return out


def added_spans(text: str, base: list[Span], model: Model, odds: float) -> list[tuple[int, int, int, float]]:
    """(kind, start, end, log odds) the field finds beside the patterns' spans."""
    taken: list[list[int]] = []  # the base's spans, kinds that overlap as one
    for start, end in sorted((s, e) for _, s, e in base):
        if taken and start < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], end)
        else:
            taken.append([start, end])
    out = []
    for region in regions(candidates(text)):
        for segment, gain in decode(model, region):
            n = bisect_left(taken, segment.end, key=lambda t: t[0]) - 1  # the last that starts before the segment ends
            if gain >= odds and (n < 0 or taken[n][1] <= segment.start):
                out.append((segment.kind, segment.start, segment.end, gain))
    return out


def respelled(kind: int, span: str, draw: random.Random) -> str | None:
    """The same datum in a spelling the patterns do not know."""
    digits = re.sub("[^0-9]", "", span)
    if kind == EMAIL:
        local, host = span.split("@")
        at, dot = draw.choice([(" at ", " dot "), (" [at] ", "."), ("(at)", "."), ("@", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]")])
        return local + at + host.replace(".", dot)
    if kind == IP:
        return span.replace(".", draw.choice(["[.]", "(.)", " . "]))
    if kind == CARD:
        return draw.choice([".", "/", " - "]).join(digits[i:i + 4] for i in range(0, len(digits), 4))
    if len(digits) < 11:
        return None
    a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
    return draw.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{digits[:-10]}-{a}-{b}-{c}", f"{digits[:-10]} ({a}) {b}-{c}"])


def decoys(draw: random.Random, count: int) -> Iterator[str]:
    """Numbers that are nobody's: dates with times, amounts, ranges of years, book numbers, long counts."""
    for n in range(count):
        a, b, c = draw.randrange(1, 28), draw.randrange(1, 12), draw.randrange(1950, 2030)
        yield " " + [f"{c}-{b:02}-{a:02} {a % 24:02}:{b * 4:02}", f"{a}.{b}.{c} {b}:{a + 20}", f"{c}-{c + a} {c + b}", f"978-{b % 10}-{a:02}-{draw.randrange(10**6):06}-{a % 10}",
                     f"{draw.randrange(10**10, 10**16)}", f"{a}.{b}.{a}-{b}.{c}", f"{c * a}.{b} ({c}) {a}"][n % 7] + " "


def example(text: str, spans: list[Span]) -> list[tuple[list[Segment], list[int]]]:
    """Regions of a text with the numbers of their true segments; a region whose truth is no candidate is left out."""
    out = []
    for region in regions(candidates(text)):
        low, high = min(s.start for s in region), max(s.end for s in region)
        own, end = [], -1
        for span in sorted((s for s in spans if s[1] < high and s[2] > low), key=lambda s: (s[1], -s[2])):
            if span[1] >= end:  # of overlapping kinds, the one that starts first, then the longer
                own.append(span)
                end = span[2]
        numbers = {(s.kind, s.start, s.end): n for n, s in enumerate(region)}
        if all(s in numbers for s in own):
            out.append((region, [numbers[s] for s in own]))
    return out


def windows(key: str, text: str):
    """Training windows of a task's documents: (hash order, text, spans) around every region and pattern span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[str, list[int]]] = []
            for value in batch.column(text).to_pylist():
                value = value or ""
                base = base_spans(value)
                for region in regions(candidates(value)):
                    low = max(0, min(s.start for s in region) - CONTEXT)
                    high = max(s.end for s in region) + CONTEXT
                    spans = [x for k, s, e in base if s >= low and e <= high for x in (k, s - low, e - low)]
                    rows.append((value[low:high], spans))
            yield pa.record_batch({"window": pa.array([r[0] for r in rows], pa.string()), "spans": pa.array([r[1] for r in rows], pa.list_(pa.int32()))})

    return run


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", train_docs: int = 20_000, train_windows: int = 4_000) -> Model:
    """Fit the field on the patterns' spans. Of more than ``train_docs`` documents, those with the
    smallest hash of the id are read, about that many; of their windows at most ``train_windows``,
    again by hash. Nothing else of the corpus reaches the driver."""
    total = docs.count()
    share = min(1.0, train_docs / max(1, total))
    hashed = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(12)), F.lit(1 << 20))
    found = docs.filter(hashed < int(share * (1 << 20)) + (share < 1.0)).select(key, text).mapInArrow(windows(key, text), "window string, spans array<int>")
    kept = found.distinct().orderBy(F.xxhash64("window", F.lit(12)), "window", "spans").limit(train_windows).collect()
    examples, draw = [], random.Random(12)
    for row in kept:
        spans = [tuple(row["spans"][i:i + 3]) for i in range(0, len(row["spans"]), 3)]
        examples += example(row["window"], spans)
        for kind, start, end in spans:
            hidden = respelled(kind, row["window"][start:end], draw)
            if hidden:
                context = row["window"][:start] + hidden + row["window"][end:]
                moved = [(k, s, e) if e <= start else (k, s + len(hidden) - (end - start), e + len(hidden) - (end - start)) for k, s, e in spans if e <= start or s >= end]
                examples += example(context, [*moved, (kind, start, start + len(hidden))])
    if examples:
        for text_ in decoys(draw, DECOYS):
            examples += example(text_, base_spans(text_))
    return fit(examples)


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
SCORED = pa.struct([*((f.name, f.type) for f in SPAN), ("score", pa.float64())])
SPAN_SQL, SCORED_SQL = "struct<kind:string,start:int,end:int>", "struct<kind:string,start:int,end:int,score:double>"


def find(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", odds: float = 2.2) -> DataFrame:
    """(key, base, added): the patterns' spans and those of the field, each by start, per row.
    ``odds`` is the least log odds of an added span (2.2: nine to one)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base_rows, added_rows = [], []
            for value in batch.column(1):
                value = value.as_py() or ""
                base = base_spans(value)
                base_rows.append([{"kind": KINDS[k], "start": s, "end": e} for k, s, e in base])
                added_rows.append([{"kind": KINDS[k], "start": s, "end": e, "score": x} for k, s, e, x in added_spans(value, base, model, odds)])
            yield pa.record_batch([batch.column(0), pa.array(base_rows, pa.list_(SPAN)), pa.array(added_rows, pa.list_(SCORED))], names=[key, "base", "added"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, base array<{SPAN_SQL}>, added array<{SCORED_SQL}>")


def train_and_find(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    return find(docs, train(docs, key, text, **options), key, text)
