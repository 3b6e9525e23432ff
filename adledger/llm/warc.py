"""WARC archives: writing with deduplicated payloads, and a reader that salvages.

An archive is a sequence of gzip members, one record each. It is written by Spark's text
sink, whose "line separator" is an empty gzip member: the files hold nothing but members,
and any Hadoop file system will do. The reader verifies every member (checksum, version
line, length, payload digest). After a failed check it looks for the next member or
version line that verifies, recovers all later records and logs the bytes in between; it
does so in the archive and in what is unpacked from a member.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the file formats.
EMPTY_MEMBER = bytes.fromhex("1f8b0800000000000003" "0300" "0000000000000000")
MEMBER = b"\x1f\x8b\x08"
VERSIONS = (b"WARC/1.0\r\n", b"WARC/1.1\r\n")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADER_STEP = 65_536
FEED = 16_384


# --- one record -----------------------------------------------------------------------

@dataclass
class Record:
    """A record that passed every check; ``refers_to`` is set for revisits only."""

    record_id: str
    record_type: str
    uri: str
    payload_bytes: int
    payload_digest: str
    refers_to: str | None
    block: bytes


def clean(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in value)


def encode(record_id: str, uri: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One record as a gzip member: a response with its payload, or a revisit without."""
    block = payload if refers_to is None else b""
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": f"<{record_id}>",
        "WARC-Date": "2000-01-01T00:00:00Z", "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Payload-Length": str(len(payload)), "Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(block)),
    }
    if uri is not None:
        fields["WARC-Target-URI"] = clean(uri)
    if refers_to is not None:
        fields |= {"WARC-Refers-To": f"<{refers_to}>", "WARC-Profile": REVISIT_PROFILE}
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode()
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(VERSIONS[1] + head + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def header_end(data: bytes, at: int) -> int:
    """End of the header that begins at ``at``, however long it is; -1 if the data ends or
    another record begins before."""
    for start in range(at, len(data), HEADER_STEP):
        stop = data.find(b"\r\n\r\n", start, start + HEADER_STEP + 3)
        if data.find(b"\r\nWARC/1.", start, stop if stop >= 0 else start + HEADER_STEP + 8) >= 0:
            return -1
        if stop >= 0:
            return stop
    return -1


def decode(data: bytes, at: int = 0) -> tuple[Record, int] | str:
    """The record that begins at ``at`` and its end, or why there is none."""
    if not data.startswith(VERSIONS, at):
        return "no version line"
    stop = header_end(data, at)
    if stop < 0:
        return "header without end"
    lines = data[at:stop].decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        return "no content length"
    first, last = stop + 4, stop + 4 + int(length)
    if data[last:last + 4] != b"\r\n\r\n":
        return "block without end"
    block, kind = data[first:last], fields.get("warc-type", "")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    if kind != "revisit" and digest and hashlib.sha256(block).hexdigest() != digest:
        return "payload digest differs"
    record_id, refers_to = (fields.get(k, "").strip("<>") or None for k in ("warc-record-id", "warc-refers-to"))
    if record_id is None or kind == "revisit" and refers_to is None:
        return "field missing"
    size = fields.get("warc-payload-length", "") if kind == "revisit" else length
    return Record(record_id, kind, fields.get("warc-target-uri", ""), int(size) if size.isdigit() else 0, digest,
                  refers_to if kind == "revisit" else None, block), last + 4


def open_member(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """Contents and end of the gzip member at ``at``, and what speaks against it: no reason if
    its checksum is verified, else the contents are those unpacked before the damage."""
    unpack, inside, step = zlib.decompressobj(31), [], FEED
    while not unpack.eof and at < len(data):
        before = unpack.copy() if step == FEED else None
        try:
            inside.append(unpack.decompress(data[at:at + step]))
            at += step
        except zlib.error as error:
            if before is None:
                return b"".join(inside), at, f"member: {error}"
            unpack, step = before, 1  # once more, to keep all that comes before the error
    if not unpack.eof:
        return b"".join(inside), len(data), "member without end"
    return b"".join(inside), min(at, len(data)) - len(unpack.unused_data), None


# --- a whole archive ------------------------------------------------------------------

def read_at(data: bytes, at: int, members: bool = True) -> tuple[list[Record | str], int | None] | str:
    """The records of the member, or the plain record, that begins at ``at``, with the reasons
    against other parts of the member, and the end (None if damage hides it). A reason alone
    if there is no record."""
    if not (members and data.startswith(MEMBER, at)):
        found = decode(data, at)
        return found if isinstance(found, str) else ([found[0]], found[1])
    inside, end, against = open_member(data, at)
    parts = list(salvage(inside, False))
    found = [f"{x} (unpacked bytes {a} to {b})" if isinstance(x, str) else x for a, b, x in parts]
    records = [x for x in found if not isinstance(x, str)]
    if against is None:
        return (found, end) if records or not found else parts[0][2]
    # Without the member's checksum only a digest vouches for a block; and if every record
    # passes although some byte is wrong, none can be told from the damaged one.
    sure = [x for x in records if x.payload_digest or not x.block]
    cut_off = against == "member without end"
    if not sure or not cut_off and len(sure) == len(found):
        return against
    return [*sure, *(x for x in found if isinstance(x, str)), against], None


def candidates(data: bytes, at: int, members: bool = True) -> Iterator[int]:
    """Places from ``at`` on where a member or a version line may begin, in order."""
    marks = (MEMBER, *VERSIONS) if members else VERSIONS
    ahead = {m: data.find(m, at) for m in marks}
    while any(place >= 0 for place in ahead.values()):
        mark, place = min(((m, p) for m, p in ahead.items() if p >= 0), key=lambda x: x[1])
        yield place
        ahead[mark] = data.find(mark, place + 1)


def salvage(data: bytes, members: bool = True) -> Iterator[tuple[int, int, Record | str]]:
    """(start, end, record or reason): every record that verifies, and between them the
    byte ranges in quarantine, without gap or overlap. What a member of several records holds
    is searched in the same way and has the place of the member. Empty members and the zero
    bytes that pad a file are skipped in silence."""
    at = 0
    while at < len(data):
        found = read_at(data, at, members) if data[at] else ([], at + len(data[at:]) - len(data[at:].lstrip(b"\0")))
        parts, end = ([found], None) if isinstance(found, str) else found
        if end is None:
            end = next((p for p in candidates(data, at + 1, members) if not isinstance(read_at(data, p, members), str)), len(data))
        for part in parts:
            yield at, end, part
        at = end


# --- on Spark -------------------------------------------------------------------------

RECORDS = "archive string, start long, end long, record_id string, record_type string, uri string, payload_bytes long, payload_digest string, refers_to string, payload binary, quarantined string"
RECORD_SCHEMA = pa.schema([
    ("archive", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()),
    ("uri", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()),
    ("payload", pa.binary()), ("quarantined", pa.string())])


def plan_records(pages: DataFrame, archives: int, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 100) -> DataFrame:
    """page_id, url, html, digest, refers_to: which page carries a payload and which refers,
    dealt into so many parts.

    Among pages with equal payloads of at least ``least`` bytes, the smallest id responds
    (every row of it, if it is repeated) and the others refer to it. A null html is an
    empty payload; a page without an id always responds and is never referred to.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    known = rows.filter(F.octet_length("html") >= least).select("digest", "page_id")
    shared = known.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).filter("first < last")
    # Who refers to whom is settled without payloads, which then travel once, dealt by page.
    refers = known.join(shared, "digest").filter("page_id > first").select("page_id", "digest", F.col("first").alias("refers_to")).distinct()
    return rows.repartition(archives, "page_id", "digest").join(refers, ["page_id", "digest"], "left").select(
        "page_id", "url", "html", "digest", "refers_to")


def name_of(page) -> str:
    return "urn:page:" + ("none" if page is None else str(page))


def to_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages, urls, digests, refers = (batch.column(n).to_pylist() for n in ("page_id", "url", "digest", "refers_to"))
        members = [encode(name_of(p), u, h.as_py(), d, None if r is None else name_of(r))
                   for p, u, h, d, r in zip(pages, urls, batch.column("html"), digests, refers)]
        yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], ["member"])


def write_archives(pages: DataFrame, path: str, archive_bytes: int = 8 << 20, **names) -> None:
    """Write a record per page into archives of about ``archive_bytes`` of payload.

    An archive is read in one piece later, so its size is what bounds a task's memory.
    """
    total = pages.agg(F.sum(F.octet_length(names.get("html", "html")))).first()[0] or 0
    (plan_records(pages, 1 + total // archive_bytes, **names).mapInArrow(to_members, "member binary")
     .select(F.col("member").cast("string")).write.option("encoding", "ISO-8859-1")
     .option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(path))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below a path and, with ``quarantined`` set, every byte
    range that holds none. No archive, or an empty one, gives no row."""

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                name, data = batch.column("path")[r].as_py(), batch.column("content")[r].as_py()
                rows, size = [], 0
                for start, end, found in salvage(data):
                    if isinstance(found, str):
                        rows.append((name, start, end, None, None, None, None, None, None, None, found))
                    else:
                        rows.append((name, start, end, found.record_id, found.record_type, found.uri, found.payload_bytes,
                                     found.payload_digest, found.refers_to, found.block, None))
                        size += len(found.block)
                    if size > 4 << 20 or len(rows) >= 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RECORD_SCHEMA)], schema=RECORD_SCHEMA)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RECORD_SCHEMA)], schema=RECORD_SCHEMA)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(run, RECORDS)
