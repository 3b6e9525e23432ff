"""HTML character references, decoded inside Spark.

A text is cut into references and the text between them; each reference is looked up by
itself: names in constant maps, numbers by conversion. Rules and names are those of HTML 5,
as the standard library's ``html`` module has them.
"""

from __future__ import annotations

import json
import zlib
from functools import cache
from html.entities import html5

from pyspark.sql import Column, functions as F

#: A reference, or a run of text without one.
PIECE = r"(?s)&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]++|&"
#: Maps the names are dealt into: Spark searches a map entry by entry.
SHARDS = 1024
UNKNOWN = "�"


@cache
def _names() -> str:
    """Constant array of small maps name -> characters, a name being in the map its checksum names."""
    table: list[dict[str, str]] = [{} for _ in range(SHARDS)]
    for name, characters in html5.items():
        table[zlib.crc32(name.encode()) % SHARDS][name] = characters
    return json.dumps(table)


@cache
def _unended() -> str:
    """Pattern of the names that count without a semicolon, longest first."""
    names = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    return f"^&({'|'.join(names)})"


@cache
def _windows() -> str:
    """What the numbers 128 to 159 stand for: the characters Windows has there."""
    return "".join(bytes([n]).decode("cp1252", "replace").replace(UNKNOWN, chr(n)) for n in range(128, 160))


def _character(number: Column) -> Column:
    """Text of one code point; nothing for those no page may hold."""
    banned = (
        number.between(1, 8) | (number == 11) | number.between(14, 31) | (number == 127) | number.between(0xFDD0, 0xFDEF) | (number % 0x10000 >= 0xFFFE)
    )
    return (
        F.when((number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF), F.lit(UNKNOWN))
        .when(number.between(128, 159), F.substring(F.lit(_windows()), (number - 127).cast("int"), F.lit(1)))
        .when(banned, F.lit(""))
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
    )


def _by_number(reference: Column) -> Column:
    digits = F.regexp_extract(reference, r"^&#[xX]?0*([0-9a-fA-F]*)", 1)
    read = F.when(F.substring(reference, 3, 1).isin("x", "X"), F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10))
    number = F.when(F.length(digits) > 7, F.lit(0x110000).cast("long")).otherwise(F.coalesce(read.cast("long"), F.lit(0).cast("long")))
    return bound(number, _character)


def _by_name(reference: Column, table: Column) -> Column:
    of = lambda name: F.try_element_at(F.get(table, (F.crc32(name.cast("binary")) % SHARDS).cast("int")), name)
    known = bound(F.substring(reference, 2, 40), of)
    start = lambda name: F.when(name != "", F.concat(of(name), F.substring(reference, F.length(name) + 2, F.lit(40)))).otherwise(reference)
    return F.coalesce(known, bound(F.regexp_extract(reference, _unended(), 1), start))


def bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unescaped(text: Column) -> Column:
    """Text with its character references decoded."""
    # The table is named once: Spark writes constants out wherever a plan is described.
    table = F.from_json(F.lit(_names()), "array<map<string,string>>")

    def decoded(x: Column) -> Column:
        piece = lambda p: (
            F.when(~p.startswith("&") | (p == "&"), p).when(p.startswith("&#"), _by_number(p)).otherwise(_by_name(p, x["table"])))
        return F.when(x["text"].contains("&"), F.array_join(F.transform(F.regexp_extract_all(x["text"], F.lit(PIECE), F.lit(0)), piece), "")).otherwise(x["text"])

    return bound(F.struct(text.alias("text"), table.alias("table")), decoded)
