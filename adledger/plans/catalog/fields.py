"""Field extraction from listing texts, numbers, dates, records."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ...functions import html, listing, numbers, records, text, times
from ...operators.extraction import llm_extract, parse_listing
from ...operators.filters import conform
from ...schemas import table_schema
from .common import L, THOUSANDS, derive, listings, table

# ---- one query per extracted field -----------------------------------------


def _field(fn, name: str):
    def query(spark, folder):
        return listings(spark, folder).select("listing_id", fn("text").alias(name))
    return query


def _make_model(spark, folder):
    return listings(spark, folder).select(
        "listing_id", listing.extract_make("text").alias("make"), listing.extract_model("text").alias("model"))


PRICE_SQL = r"TRY_CAST(replace(regexp_extract(text, '\$\s?([0-9,]+)', 1), ',', '') AS BIGINT)"
YEAR_SQL = r"TRY_CAST(regexp_extract(text, '\b(?:19|20)\d{2}\b') AS BIGINT)"
MAKE_MODEL_RE = r"\b([A-Z][a-z]+)\s+([A-Z][A-Za-z0-9]+)"
MAKE_SQL = f"nullif(regexp_extract(text, '{MAKE_MODEL_RE}', 1), '')"
MODEL_SQL = f"nullif(regexp_extract(text, '{MAKE_MODEL_RE}', 2), '')"
MILEAGE_SQL = r"""coalesce(
  TRY_CAST(replace(regexp_extract(text, '(?i)(?:mileage|odometer)\s*[:-]?\s*([\d,]+)', 1), ',', '') AS BIGINT),
  CAST(trunc(TRY_CAST(regexp_extract(text, '(?i)(\d+(?:\.\d+)?)\s*k\s*(?:mi|mile|miles)\b', 1) AS DOUBLE) * 1000) AS BIGINT),
  TRY_CAST(regexp_replace(regexp_extract(text, '(?i)(\d{1,3}(?:[,\d]{3})*)\s*(?:mi|mile|miles)\b', 1), '[^\d]', '', 'g') AS BIGINT))"""
GEAR_WORD = r"lower(regexp_extract(text, '(?i)\b(automatic|auto|manual|cvt|stick\s?shift)\b', 1))"
GEAR_SQL = f"CASE WHEN {GEAR_WORD} IN ('automatic', 'auto', 'cvt') THEN 'automatic' WHEN {GEAR_WORD} <> '' THEN 'manual' END"
FUEL_WORD = r"lower(regexp_extract(text, '(?i)\b(gas|gasoline|diesel|electric|ev|hybrid)\b', 1))"
FUEL_SQL = (f"CASE {FUEL_WORD} WHEN 'gasoline' THEN 'gas' WHEN 'gas' THEN 'gas' WHEN 'ev' THEN 'electric' "
            "WHEN 'electric' THEN 'electric' WHEN 'diesel' THEN 'diesel' WHEN 'hybrid' THEN 'hybrid' END")
DRIVE_WORD = (r"lower(regexp_extract(text, '(?i)\b(4wd|awd|fwd|rwd|four\s?wheel\s?drive|rear\s?wheel\s?drive"
              r"|front\s?wheel\s?drive|all\s?wheel\s?drive)\b', 1))")
DRIVE_SQL = (f"CASE {DRIVE_WORD} WHEN 'awd' THEN 'AWD' WHEN 'all wheel drive' THEN 'AWD' WHEN '4wd' THEN '4WD' "
             "WHEN 'four wheel drive' THEN '4WD' WHEN 'fwd' THEN 'FWD' WHEN 'front wheel drive' THEN 'FWD' "
             "WHEN 'rwd' THEN 'RWD' WHEN 'rear wheel drive' THEN 'RWD' END")
IMAGE_SQL = r"""nullif(regexp_extract(text, '(?i)https://images\.example\.org/[^\s"''<>]+'), '')"""
FIELD_SQL = {
    "price": PRICE_SQL, "year": YEAR_SQL, "make": MAKE_SQL, "model": MODEL_SQL, "mileage": MILEAGE_SQL,
    "transmission": GEAR_SQL, "fuel_type": FUEL_SQL, "drivetrain": DRIVE_SQL, "image_url": IMAGE_SQL,
}
PARSED_SQL = ", ".join(f"{sql} AS {name}" for name, sql in FIELD_SQL.items())
#: Parsed records of all listings, for other oracles.
PARSED_CTE = (f"{L}, p AS (SELECT listing_id, post_id, run_id, path AS source_txt, text, {PARSED_SQL} FROM l)")


def _parse_listing(spark, folder):
    return parse_listing(listings(spark, folder).drop("path", "post_id", "run_id"))


# ---- rule-based callable for llm_extract -----------------------------------

def answer_by_rules(body: str) -> dict:
    """Stand-in extraction function: first line number as price, gear words, odd blanks."""
    import re

    number = re.search(r"listing (\d+)", body)
    n = int(number.group(1))
    if n % 17 == 0:
        raise ValueError("no answer")
    return {"price": f"{n:,}", "year": "12.5" if n % 2 else " 2001 ", "make": "  ", "model": " m%d " % (n % 3),
            "mileage": None, "engine_cylinders": 4}


def _llm_extract(spark, folder):
    raw = listings(spark, folder).select("listing_id", F.col("text").alias("raw_text"))
    out = llm_extract(raw, answer_by_rules, wait=0.0)
    return out.select("listing_id", "price", "year", "make", "model", "mileage", "engine_cylinders", "error")


# ---- numbers ----------------------------------------------------------------

RAW_NUMBERS = f"""
SELECT o_orderkey AS id, CASE o_orderkey % 8
  WHEN 0 THEN '$' || {THOUSANDS.format(x='CAST(floor(o_totalprice) AS BIGINT)')}
  WHEN 1 THEN ' ' || CAST(o_orderkey AS STRING) || ' ' WHEN 2 THEN '-500' WHEN 3 THEN '1.2.3'
  WHEN 4 THEN '.' WHEN 5 THEN '' WHEN 6 THEN CAST(o_orderkey AS STRING) || '.5' ELSE NULL END AS raw
FROM {{orders}}"""
N = f"n AS ({RAW_NUMBERS.format(orders='orders')})"


def _number(fn, name):
    def query(spark, folder):
        return derive(spark, folder, RAW_NUMBERS, "orders").select("id", fn("raw").alias(name))
    return query


def _fmt_number(spark, folder):
    o = table(spark, folder, "orders")
    whole = F.floor("o_totalprice")
    return o.select("o_orderkey", numbers.fmt_number(whole, 0).alias("label"), whole.cast("bigint").alias("amount"),
                    numbers.fmt_number(whole / 10, 1).alias("tenths"))


def _rounding(digits, parts=8):
    def query(spark, folder):
        # Halves of the last digit are exact in binary, so both engines round the same number.
        value = F.col("o_orderkey") / parts
        return table(spark, folder, "orders").select(
            "o_orderkey", numbers.round_half_even(value, digits).alias("rounded"))
    return query


# ---- run ids and dates ------------------------------------------------------

EVENT_RUNS = """
SELECT event_id, ts, user_id, value,
  CASE WHEN event_id % 50 = 7 THEN 'zz' WHEN event_id % 2 = 0 THEN {ymd} || 'T' || {hms} || 'Z' ELSE {ymd} || {hms} END AS run_id
FROM {{events}}""".format(
    ymd="CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS STRING)",
    hms="lpad(CAST(hour(ts) AS STRING), 2, '0') || lpad(CAST(minute(ts) AS STRING), 2, '0') || '05'")
E_CTE = f"e AS ({EVENT_RUNS.format(events='events')})"
PLAIN_TS = "strptime(replace(replace(run_id, 'T', ''), 'Z', ''), '%Y%m%d%H%M%S')"


def event_runs(spark, folder):
    return derive(spark, folder, EVENT_RUNS, "events")


def _parse_run_id(spark, folder):
    return event_runs(spark, folder).select(
        "event_id", times.iso_z(times.parse_run_id("run_id", "oldest")).alias("scraped_at"))


def _iso_z(spark, folder):
    return table(spark, folder, "events").select("event_id", times.iso_z("ts").alias("iso"))


def _run_hour(spark, folder):
    key = times.run_hour("ts")
    return table(spark, folder, "events").select(
        "event_id", key.alias("run_hour"), times.iso_z(times.parse_run_hour(key)).alias("parsed"))


def _local_day(spark, folder):
    iso = F.when(F.col("event_id") % 40 == 9, F.lit("bad")).otherwise(times.iso_z("ts"))
    return table(spark, folder, "events").select(
        "event_id", times.local_day(iso).cast("string").alias("date_local"))


# ---- records ----------------------------------------------------------------

def _parse_llm_json(spark, folder):
    parsed = records.parse_llm_json("props", ["k", "price", "make"])
    return table(spark, folder, "events").select(
        "event_id", parsed["k"].alias("k"), parsed["price"].alias("price"), parsed["make"].alias("make"))


def _to_json_record(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", records.to_json_record(["c_custkey", "c_name", "c_mktsegment"]).alias("json"))


SOURCE_KEYS = """
SELECT o_orderkey AS id, CASE o_orderkey % 6 WHEN 0 THEN 'gs://b' || CAST(o_custkey AS STRING) || '/a/' || CAST(o_orderkey AS STRING) || '.txt'
  WHEN 1 THEN '/a/' || CAST(o_orderkey AS STRING) || '.txt' WHEN 2 THEN 'gs://b' WHEN 3 THEN NULL WHEN 4 THEN '  '
  ELSE 'a/' || CAST(o_orderkey AS STRING) || '.txt' END AS source_txt FROM {orders}"""


def _norm_source_key(spark, folder):
    key = records.norm_source_key("source_txt", "main")
    return derive(spark, folder, SOURCE_KEYS, "orders").select(
        "id", key["bucket"].alias("bucket"), key["key"].alias("key"))


VOCAB_INPUT = """
SELECT o_orderkey AS id,
  CASE o_orderkey % 4 WHEN 0 THEN 'VW' WHEN 1 THEN ' chevy ' WHEN 2 THEN 'land rover' ELSE '' END AS make,
  CASE o_orderkey % 3 WHEN 0 THEN 'Automatic' WHEN 1 THEN 'cvt' ELSE ' MANUAL ' END AS transmission,
  CASE o_orderkey % 5 WHEN 0 THEN 'Like New' WHEN 1 THEN 'mint' ELSE 'Good' END AS condition,
  CASE o_orderkey % 3 WHEN 0 THEN 'ct' WHEN 1 THEN 'Conn' ELSE 'MA' END AS state,
  CASE o_orderkey % 3 WHEN 0 THEN '06511' WHEN 1 THEN '6511' ELSE ' 10001 ' END AS zip_code,
  CASE o_orderkey % 3 WHEN 0 THEN 'FWD' WHEN 1 THEN 'tracks' ELSE ' 4wd ' END AS drivetrain,
  CASE o_orderkey % 4 WHEN 0 THEN 'Diesel' WHEN 1 THEN 'steam' WHEN 2 THEN ' HYBRID' END AS fuel_type,
  CASE o_orderkey % 3 WHEN 0 THEN 'SUV' WHEN 1 THEN 'ute' ELSE ' Sedan ' END AS body_type,
  CASE o_orderkey % 3 WHEN 0 THEN 'Clean' WHEN 1 THEN 'lost' ELSE 'Rebuilt' END AS title_status,
  CASE o_orderkey % 3 WHEN 0 THEN 'land cruiser' WHEN 1 THEN ' f150 ' ELSE '' END AS model,
  CASE o_orderkey % 3 WHEN 0 THEN 'Dark RED' WHEN 1 THEN ' ' ELSE 'blue' END AS color,
  CASE o_orderkey % 3 WHEN 0 THEN 'new haven' WHEN 1 THEN 'HARTFORD' ELSE '' END AS city
FROM {orders}"""


def _canonical(spark, folder):
    return records.canonical_record(derive(spark, folder, VOCAB_INPUT, "orders"))


def _canonical_make(spark, folder):
    return derive(spark, folder, VOCAB_INPUT, "orders").select("id", records.canonical_make("make").alias("make"))


def _post_id_from_path(spark, folder):
    return listings(spark, folder).select("listing_id", html.post_id_from_path("path").alias("name"))


def _post_id_from_url(spark, folder):
    return table(spark, folder, "pages").select("page_id", html.post_id_from_url("url").alias("post_id"))


def _conform(spark, folder):
    parsed = parse_listing(listings(spark, folder).withColumn("extra", F.lit(1)))
    schema = table_schema(["post_id", "year", "city", "combined_text_len"])
    return conform(parsed, schema)


QUERIES = {
    **{f"extract_{n}": _field(fn, n) for n, fn in {
        "price": listing.extract_price, "year": listing.extract_year, "mileage": listing.extract_mileage,
        "transmission": listing.extract_transmission, "image_url": listing.extract_image_url,
        "drivetrain": listing.extract_drivetrain}.items()},
    "extract_fuel": _field(listing.extract_fuel, "fuel_type"),
    "extract_make_model": _make_model,
    "parse_listing": _parse_listing,
    "llm_extract": _llm_extract,
    "clean_numeric": _number(numbers.clean_numeric, "number"),
    "safe_int": _number(numbers.safe_int, "number"),
    "norm_str": _number(text.norm_str, "value"),
    "to_numeric_coerce": _number(numbers.to_numeric_coerce, "number"),
    "fmt_number": _fmt_number,
    "round1": _rounding(1),
    "round2": _rounding(2),
    "round4": _rounding(4, 32),
    "parse_run_id": _parse_run_id,
    "iso_z": _iso_z,
    "run_hour": _run_hour,
    "local_day": _local_day,
    "parse_llm_json": _parse_llm_json,
    "to_json_record": _to_json_record,
    "norm_source_key": _norm_source_key,
    "canonical_vocabularies": _canonical,
    "canonical_make": _canonical_make,
    "post_id_from_path": _post_id_from_path,
    "post_id_from_url": _post_id_from_url,
    "conform": _conform,
}

_F = f"WITH {L} SELECT listing_id, "
ORACLES = {
    **{f"extract_{n}": f"{_F}{FIELD_SQL[n]} AS {n} FROM l"
       for n in ("price", "year", "mileage", "transmission", "image_url", "drivetrain")},
    "extract_fuel": f"{_F}{FUEL_SQL} AS fuel_type FROM l",
    "extract_make_model": f"{_F}{MAKE_SQL} AS make, {MODEL_SQL} AS model FROM l",
    "parse_listing": f"{_F}{PARSED_SQL} FROM l",
    "llm_extract": """
SELECT o_orderkey AS listing_id, CASE WHEN ok THEN o_orderkey END AS price,
  CASE WHEN ok AND o_orderkey % 2 = 0 THEN CAST(2001 AS BIGINT) END AS year, CAST(NULL AS VARCHAR) AS make,
  CASE WHEN ok THEN 'm' || (o_orderkey % 3) END AS model, CAST(NULL AS BIGINT) AS mileage,
  CASE WHEN ok THEN CAST(4 AS BIGINT) END AS engine_cylinders,
  CASE WHEN NOT ok THEN 'ValueError: no answer' END AS error
FROM (SELECT o_orderkey, o_orderkey % 17 <> 0 AS ok FROM orders)""",
    "clean_numeric": f"WITH {N} SELECT id, TRY_CAST(regexp_replace(raw, '[^\\d.]+', '', 'g') AS DOUBLE) AS number FROM n",
    "safe_int": f"""WITH {N}, t AS (SELECT id, trim(replace(raw, ',', '')) AS s FROM n)
SELECT id, CASE WHEN regexp_full_match(s, '[+-]?\\d+') THEN CAST(s AS BIGINT) END AS number FROM t""",
    "norm_str": f"WITH {N} SELECT id, nullif(trim(raw), '') AS value FROM n",
    "to_numeric_coerce": f"WITH {N} SELECT id, TRY_CAST(raw AS DOUBLE) AS number FROM n",
    "fmt_number": "SELECT o_orderkey, format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS label, CAST(floor(o_totalprice) AS BIGINT) AS amount, format('{:,.1f}', floor(o_totalprice) / 10) AS tenths FROM orders",
    "round1": "SELECT o_orderkey, round_even(o_orderkey / 8.0::DOUBLE, 1) AS rounded FROM orders",
    "round2": "SELECT o_orderkey, round_even(o_orderkey / 8.0::DOUBLE, 2) AS rounded FROM orders",
    "round4": "SELECT o_orderkey, round_even(o_orderkey / 32.0::DOUBLE, 4) AS rounded FROM orders",
    "parse_run_id": f"""WITH {E_CTE} SELECT event_id, CASE WHEN run_id = 'zz' THEN '1970-01-01T00:00:00Z'
  ELSE strftime({PLAIN_TS}, '%Y-%m-%dT%H:%M:%SZ') END AS scraped_at FROM e""",
    "iso_z": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM events",
    "run_hour": "SELECT event_id, strftime(ts, '%Y%m%d%H') AS run_hour, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%SZ') AS parsed FROM events",
    "local_day": """SELECT event_id, CASE WHEN event_id % 40 <> 9 THEN
  strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d') END AS date_local FROM events""",
    "parse_llm_json": "SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS BIGINT) AS price, CAST(NULL AS VARCHAR) AS make FROM events",
    "to_json_record": """SELECT c_custkey, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '"}' AS json FROM customer""",
    "norm_source_key": f"""WITH s AS ({SOURCE_KEYS.format(orders='orders')})
SELECT id, CASE WHEN id % 6 = 0 THEN split_part(source_txt, '/', 3) ELSE 'main' END AS bucket,
  CASE WHEN id % 6 IN (0, 1, 5) THEN 'a/' || id || '.txt' END AS key FROM s""",
    "canonical_make": """SELECT o_orderkey AS id,
  CASE o_orderkey % 4 WHEN 0 THEN 'Volkswagen' WHEN 1 THEN 'Chevrolet' WHEN 2 THEN 'Land Rover' END AS make FROM orders""",
    "canonical_vocabularies": """
SELECT o_orderkey AS id,
  CASE o_orderkey % 4 WHEN 0 THEN 'Volkswagen' WHEN 1 THEN 'Chevrolet' WHEN 2 THEN 'Land Rover' END AS make,
  CASE o_orderkey % 3 WHEN 0 THEN 'automatic' WHEN 2 THEN 'manual' END AS transmission,
  CASE o_orderkey % 5 WHEN 0 THEN 'like new' WHEN 1 THEN NULL ELSE 'good' END AS condition,
  CASE o_orderkey % 3 WHEN 0 THEN 'CT' WHEN 2 THEN 'MA' END AS state,
  CASE o_orderkey % 3 WHEN 0 THEN '06511' WHEN 2 THEN '10001' END AS zip_code,
  CASE o_orderkey % 3 WHEN 0 THEN 'fwd' WHEN 2 THEN '4wd' END AS drivetrain,
  CASE o_orderkey % 4 WHEN 0 THEN 'diesel' WHEN 2 THEN 'hybrid' END AS fuel_type,
  CASE o_orderkey % 3 WHEN 0 THEN 'suv' WHEN 2 THEN 'sedan' END AS body_type,
  CASE o_orderkey % 3 WHEN 0 THEN 'clean' WHEN 2 THEN 'rebuilt' END AS title_status,
  CASE o_orderkey % 3 WHEN 0 THEN 'Land Cruiser' WHEN 1 THEN 'F150' END AS model,
  CASE o_orderkey % 3 WHEN 0 THEN 'dark red' WHEN 2 THEN 'blue' END AS color,
  CASE o_orderkey % 3 WHEN 0 THEN 'New Haven' WHEN 1 THEN 'Hartford' END AS city FROM orders""",
    "post_id_from_path": "SELECT o_orderkey AS listing_id, CAST(o_orderkey AS VARCHAR) AS name FROM orders",
    "post_id_from_url": r"SELECT page_id, regexp_extract(url, '/(\d+)\.html?$', 1) AS post_id FROM pages",
    "conform": f"WITH {L} SELECT post_id, {YEAR_SQL} AS year, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS BIGINT) AS combined_text_len FROM l",
}
