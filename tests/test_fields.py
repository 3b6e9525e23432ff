"""Edge rows of field extraction, numbers, dates and records."""

import re

import pytest
from pyspark.sql import functions as F

from adledger.functions import listing, numbers, records, text, times
from adledger.operators.extraction import TransientError, llm_extract, parse_listing, with_model_text


def test_price(apply):
    got = apply(listing.extract_price, ["$12,500 obo", "$ 900", "$,", "12,500", "$1 then $2", None, "$99999999999999999999"])
    assert got == [12500, 900, None, None, 1, None, None]


def test_year(apply):
    got = apply(listing.extract_year, ["posted 2024 for a 2011 Ford", "12015", "in 1999.", "2111", "é2001", "x_2001"])
    assert got == [2024, None, 1999, None, None, None]


def test_make_model(apply):
    rows = ["for sale Honda Civic", "honda civic", "Ford\nF150 x", "BMW X5 Mini Cooper", "éHonda Civic"]
    assert apply(listing.extract_make, rows) == ["Honda", None, "Ford", "Mini", None]
    assert apply(listing.extract_model, rows) == ["Civic", None, "F150", "Cooper", None]


def test_mileage(apply):
    rows = ["Odometer: 98,000", "120.5k miles", "mileage: , then 45k mi", "185,000 mi", "999 mi", "odometer - 7", "none",
            "MILEAGE 12", "3k milestones", None]
    assert apply(listing.extract_mileage, rows) == [98000, 120500, 45000, 185000, 999, 7, None, 12, None, None]


def python_plain_miles(s):
    """The published pattern, run by Python."""
    m = re.search(r"(\d{1,3}(?:[,\d]{3})*)\s*(?:mi|mile|miles)\b", s, re.I)
    return int(re.sub(r"[^\d]", "", m.group(1))) if m else None


def test_plain_miles_equals_the_published_pattern(apply):
    rows = [f"{n} mi" for n in ["1", "12", "123", "1234", "12345", "123456", "1234567", "1,234", "12,345", "123,456",
                                "1,234,567", "12,345,678", "12,34", "1,2345", "12,,345", "9,99,999", "85,000", "12 345"]]
    rows += ["id7 8 miles", "12,500MI", "5 mile x", "7 minutes", "12 miles", "1,2,3 mi", ",,123 mi"]
    assert apply(listing.extract_mileage, rows) == [python_plain_miles(r) for r in rows]


def test_thousand_miles_equals_the_published_pattern(apply):
    def published(s):
        m = re.search(r"(\d+(?:\.\d+)?)\s*k\s*(?:mi|mile|miles)\b", s, re.I)
        return int(float(m.group(1)) * 1000) if m else None

    rows = ["1.2.5k miles", "12.k mi", "99.99 K  MILES", "1234k mi", ".5k mi", "a12kmiles", "0.0019k mi", "7 k mi"]
    assert apply(listing.extract_mileage, rows) == [published(r) for r in rows]


def test_words(apply):
    assert apply(listing.extract_transmission, ["CVT", "stick shift", "AUTO", "stickshift", "stick\nshift", "gearbox"]) == [
        "automatic", "manual", "automatic", "manual", "manual", None]
    assert apply(listing.extract_fuel, ["Gasoline", "EV", "DIESEL gas", "hybrid", "gases"]) == [
        "gas", "electric", "diesel", "hybrid", None]
    assert apply(listing.extract_drivetrain, ["all wheel drive", "allwheeldrive", "4WD", "rear wheel drive", "all  wheel drive"]) == [
        "AWD", None, "4WD", "RWD", None]


def test_image_url(apply):
    url = lambda c: listing.extract_image_url(c, "img.example.com")
    assert apply(url, ["x HTTPS://IMG.example.com/A.jpg\" y", "https://imgxexample.com/a"]) == ["HTTPS://IMG.example.com/A.jpg", None]


def test_parse_listing_is_one_projection(frame):
    out = parse_listing(frame("id long, text string", [(1, "Honda Civic $5,000 2010 gas")]))
    row = out.first()
    assert (row.id, row.price, row.year, row.make, row.fuel_type) == (1, 5000, 2010, "Honda", "gas")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_numbers(apply, frame):
    assert apply(numbers.clean_numeric, ["$9,500", "-500", "1.2.3", ".", None, "", "1e5", "5.", ".5"]) == [
        9500.0, 500.0, None, None, None, None, 15.0, 5.0, 0.5]
    assert apply(numbers.safe_int, ["1,234", " 5 ", "12.5", "", None, "+7", "-3", "x", " 8"]) == [
        1234, 5, None, None, None, 7, -3, None, 8]
    assert apply(numbers.to_numeric_coerce, ["$9,500", "9500", " 7 "]) == [None, 9500.0, 7.0]
    df = frame("v double", [(12500000.0,), (-500.0,), (None,)])
    got = [r[0] for r in df.select(numbers.clean_numeric_column(df, "v")).collect()]
    assert got == [12500000.0, 500.0, None]
    assert apply(lambda c: numbers.round2(c), [0.125, 0.375], "double") == [0.12, 0.38]


def test_norm_str(apply):
    assert apply(text.norm_str, [" a ", "  ", None, "  b\t"]) == ["a", None, None, "b"]


def test_run_ids(apply):
    iso = lambda c: times.iso_z(times.parse_run_id(c, "null"))
    assert apply(iso, ["20251026170002", "20251026T170002Z", "zz", "20251326170002"]) == [
        "2025-10-26T17:00:02Z", "2025-10-26T17:00:02Z", None, None]
    now = lambda c: times.parse_run_id(c) == F.current_timestamp()
    assert apply(now, ["zz", "20251026170002"]) == [True, False]


def test_local_day(apply):
    day = lambda c: times.local_day(c).cast("string")
    assert apply(day, ["2026-04-04T02:00:00Z", "bad", "2026-04-04T12:00:00+00:00", None]) == ["2026-04-03", None, "2026-04-04", None]
    assert apply(lambda c: times.local_day(c, "No/Where").cast("string"), ["2026-04-04T02:00:00Z"]) == ["2026-04-04"]


def test_source_key(apply):
    key = lambda c: records.norm_source_key(c, "default")
    got = [tuple(r) for r in apply(key, ["gs://b/a/c.txt", "/a/c.txt", "gs://b", None, " a.txt "])]
    assert got == [("b", "a/c.txt"), ("default", "a/c.txt"), ("default", None), ("default", None), ("default", "a.txt")]


def test_canonical(apply):
    assert apply(records.canonical_make, ["VW", "chevy", "land rover", ""]) == ["Volkswagen", "Chevrolet", "Land Rover", None]
    assert apply(lambda c: records.canonical_value(c, "condition"), ["Like New", "mint"]) == ["like new", None]
    assert apply(records.canonical_state, ["ct", "Conn"]) == ["CT", None]
    assert apply(records.canonical_zip, ["06511", "6511"]) == ["06511", None]


def test_llm_extract(frame, tmp_path):
    calls = str(tmp_path / "calls")

    def answer(body):
        if body == "flaky":
            with open(calls, "a") as f:
                f.write("x")
            if len(open(calls).read()) < 3:
                raise TransientError("busy")
        if body == "broken":
            raise RuntimeError("no")
        if body == "list":
            return "[1]"
        return {"price": "1,200", "make": "  ", "model": " Civic ", "year": 12.5}

    df = frame("id long, raw_text string", [(1, "ok"), (2, "broken"), (3, "list"), (4, None), (5, "flaky")])
    rows = {r.id: r for r in llm_extract(df, answer, wait=0.0).collect()}
    assert (rows[1].price, rows[1].make, rows[1].model, rows[1].year, rows[1].error) == (1200, None, "Civic", None, None)
    assert rows[2].error == "RuntimeError: no" and rows[2].price is None
    assert rows[3].error.startswith("ValueError") and rows[4].error is None
    assert rows[5].price == 1200 and rows[5].error is None


def test_transient_failures_give_up(frame):
    def busy(body):
        raise TransientError("busy")

    row = llm_extract(frame("raw_text string", [("a",)]), busy, wait=0.0).first()
    assert row.error == "TransientError: busy"


def test_model_text(frame):
    row = with_model_text(frame("raw_text string", [("Nice Car\nprice: 5",)])).first()
    assert (row.combined_text, row.combined_text_len, row.has_combined_text) == ("nice car", 8, True)


@pytest.mark.parametrize("keep,expected", [(False, '{"a":1}'), (True, '{"a":1,"b":null}')])
def test_json_record(frame, keep, expected):
    df = frame("a long, b string", [(1, None)])
    assert df.select(records.to_json_record(["a", "b"], keep)).first()[0] == expected
