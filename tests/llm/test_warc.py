import glob
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from adledger.llm import queries, warc

PAGES = "page_id long, url string, html string, extra string"


def archive(n=6):
    payloads = [bytes(random.Random(i).randbytes(200 + i)) for i in range(n)]
    members = [warc.encode(f"urn:page:{i}", f"http://x/{i}", p, hashlib.sha256(p).hexdigest(), None) for i, p in enumerate(payloads)]
    return payloads, members


def ids(found):
    return [x.record_id for _, _, x in found if not isinstance(x, str)]


def check_cover(data, found):
    """Records and gaps lie one after the other."""
    at = 0
    for start, end, _ in found:
        assert start >= at and end > start
        at = end
    assert at <= len(data)


def test_whole_archive():
    payloads, members = archive()
    found = list(warc.salvage(warc.EMPTY_MEMBER.join(members) + b"\0" * 20))
    assert [x.block for _, _, x in found] == payloads


def test_salvage_after_damage():
    _, members = archive()
    sound = warc.EMPTY_MEMBER.join(members)
    begins = [sound.index(m) for m in members]
    flipped = bytearray(sound)
    flipped[begins[2] + 60] ^= 0xFF
    found = list(warc.salvage(bytes(flipped)))
    assert ids(found) == [f"urn:page:{i}" for i in (0, 1, 3, 4, 5)]
    gaps = [(a, b) for a, b, x in found if isinstance(x, str)]
    assert len(gaps) == 1 and gaps[0][0] == begins[2] and begins[2] < gaps[0][1] <= begins[3]
    cut = sound[:begins[1] + 30] + sound[begins[3]:]
    found = list(warc.salvage(cut))
    assert ids(found) == [f"urn:page:{i}" for i in (0, 3, 4, 5)]
    check_cover(cut, found)
    found = list(warc.salvage(b"junk" + sound[:-15]))
    assert ids(found) == [f"urn:page:{i}" for i in range(5)] and isinstance(found[-1][2], str) and isinstance(found[0][2], str)


def test_plain_records_and_false_marks():
    _, members = archive(3)
    plain = [gzip.decompress(m) for m in members]
    data = plain[0] + b"WARC/1.0\r\nno header" + warc.MEMBER + b"zz" + plain[1] + members[2]
    found = list(warc.salvage(data))
    assert ids(found) == [f"urn:page:{i}" for i in range(3)]
    broken = plain[1].replace(b"Content-Length: ", b"Content-Length: 9")
    assert ids(warc.salvage(plain[0] + broken + plain[2])) == ["urn:page:0", "urn:page:2"]
    wrong = bytearray(plain[1])
    wrong[-10] ^= 1
    found = list(warc.salvage(bytes(wrong) + plain[2]))
    assert ids(found) == ["urn:page:2"] and found[0][2] == "payload digest differs"
    assert list(warc.salvage(b"")) == []


def test_round_trip(spark, tmp_path):
    big = "<p>équal</p>" * 30
    rows = [(3, "u3", big, "x"), (1, "u1", big, "x"), (2, None, big, "x"), (1, "u1", big, "x"), (5, "bad\r\nurl", None, "x"), (6, "u", "", "x"),
            (7, "u", "short", "x"), (8, "u", "short", None), (None, "u", big, "x"), (9, "u", "b" * 99, "x"), (10, "u", "b" * 99, "x"), (11, "u", "z" * 2_000_000, "x")]
    pages = spark.createDataFrame(rows, PAGES)
    path = str(tmp_path / "archives")
    warc.write_archives(pages, path, archive_bytes=2000)
    files = [f for f in glob.glob(path + "/part-*")]
    text = b"".join(gzip.decompress(open(f, "rb").read()) for f in files)  # any gzip reader can read them
    assert text.count(b"WARC/1.1\r\n") == len(rows)
    got = warc.read_archives(spark, path)
    assert got.filter("quarantined IS NOT NULL").count() == 0
    found = sorted((r["record_id"], r["record_type"], r["payload_bytes"], r["refers_to"]) for r in got.collect())
    n = len(big.encode())
    assert found == sorted([
        ("urn:page:3", "revisit", n, "urn:page:1"), ("urn:page:1", "response", n, None), ("urn:page:1", "response", n, None),
        ("urn:page:2", "revisit", n, "urn:page:1"), ("urn:page:5", "response", 0, None), ("urn:page:6", "response", 0, None),
        ("urn:page:7", "response", 5, None), ("urn:page:8", "response", 5, None), ("urn:page:none", "response", n, None),
        ("urn:page:9", "response", 99, None), ("urn:page:10", "response", 99, None), ("urn:page:11", "response", 2_000_000, None)], key=lambda x: x)
    assert {r["payload_digest"] for r in got.filter("record_id = 'urn:page:3'").collect()} == {hashlib.sha256(big.encode()).hexdigest()}


def test_members_of_several_records():
    _, members = archive(40)
    plain = [gzip.decompress(m) for m in members]
    wrong = bytearray(plain[2])
    wrong[-10] ^= 1
    inside = b"".join([*plain[:2], bytes(wrong), *plain[3:5]])
    found = list(warc.salvage(gzip.compress(inside) + members[5]))
    assert ids(found) == [f"urn:page:{i}" for i in (0, 1, 3, 4, 5)]
    assert [x.startswith("payload digest differs") for _, _, x in found if isinstance(x, str)] == [True]
    longer = inside.replace(b"Content-Length: 201", b"Content-Length: 901")
    assert ids(warc.salvage(gzip.compress(longer))) == [f"urn:page:{i}" for i in (0, 3, 4)]


def test_damage_inside_a_member_of_several_records():
    _, members = archive(40)
    whole = gzip.compress(b"".join(gzip.decompress(m) for m in members))
    everything = [f"urn:page:{i}" for i in range(40)]
    for damaged in (bytes([*whole[:len(whole) // 2], *[x ^ 0x55 for x in whole[len(whole) // 2:len(whole) // 2 + 3]], *whole[len(whole) // 2 + 3:]]),
                    whole[:len(whole) // 2]):
        for data in (damaged, damaged + warc.EMPTY_MEMBER + members[0]):
            found = list(warc.salvage(data))
            got = ids(found)[:-1] if data is not damaged else ids(found)
            assert len(got) >= 15 and got == [i for i in everything if i in got] and len(got) < 40
            assert any(isinstance(x, str) for _, _, x in found)
    assert ids(warc.salvage(whole[:-4])) == everything  # only the checksum is cut off
    flipped = whole[:-6] + bytes([whole[-6] ^ 1]) + whole[-5:]
    assert ids(warc.salvage(flipped)) == []  # no record can be told from the damaged one


def test_long_url(spark, tmp_path):
    url = "http://x/" + "é\n" * 150_000
    pages = spark.createDataFrame([(1, url, "long", "x"), (2, "u", "short", "x")], PAGES)
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    got = queries.op2_warc(spark, str(tmp_path)).collect()
    assert sorted((r["page_id"], r["payload_bytes"]) for r in got) == [(1, 4), (2, 5)]
    member = warc.encode("urn:page:1", url, b"long", hashlib.sha256(b"long").hexdigest(), None)
    assert [x.uri for _, _, x in warc.salvage(member)] == [warc.clean(url)]
    plain = gzip.decompress(member)
    assert ids(warc.salvage(b"WARC/1.1\r\nno end\r\n" + plain)) == ["urn:page:1"]


def test_query_fails_on_what_it_cannot_read(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, "u", "text", "x")], PAGES).write.parquet(str(tmp_path / "pages.parquet"))
    monkeypatch.setattr(warc, "encode", lambda *page: b"damaged")
    with pytest.raises(Exception, match="unreadable record"):
        queries.op2_warc(spark, str(tmp_path)).collect()


def test_no_pages(spark, tmp_path):
    path = str(tmp_path / "none")
    warc.write_archives(spark.createDataFrame([], PAGES), path)
    assert warc.read_archives(spark, path).count() == 0


def test_damaged_file_on_spark(spark, tmp_path):
    pages = spark.range(50).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.repeat(F.concat(F.lit("x"), F.col("id")), 50).alias("html"))
    path = str(tmp_path / "damaged")
    warc.write_archives(pages, path)
    file = glob.glob(path + "/part-*")[0]
    data = bytearray(open(file, "rb").read())
    data[len(data) // 2] ^= 0x55
    other = tmp_path / "copied"  # without the checksum files of the local file system
    other.mkdir()
    (other / "a.warc.gz").write_bytes(bytes(data))
    got = warc.read_archives(spark, str(other))
    assert got.filter("quarantined IS NULL").count() == 49 and got.filter("quarantined IS NOT NULL AND `end` > start").count() == 1
