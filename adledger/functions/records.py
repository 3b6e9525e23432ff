"""JSON records, source keys, nested columns, vocabularies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schemas import EXTRACTED_FIELDS, field_type, text_schema
from .numbers import _col, safe_int
from .text import norm_str, strip


def parse_llm_json(c: Column | str, fields: list[str] = EXTRACTED_FIELDS) -> Column:
    """Answer text of a field extractor as a struct of normalised fields."""
    # An option keeps the optimizer from cutting the schema down to one field per use:
    # the answer is parsed once for all of them.
    raw = F.from_json(_col(c), text_schema(fields), {"mode": "PERMISSIVE"})
    return F.struct(*[
        (safe_int(raw[f]) if field_type(f) == T.LongType() else norm_str(raw[f])).alias(f)
        for f in fields
    ])


def to_json_record(columns: list[str], keep_nulls: bool = False) -> Column:
    """One compact JSON document per row; sparse unless ``keep_nulls``."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": str(not keep_nulls).lower()})


def norm_source_key(c: Column | str, default_bucket: str) -> Column:
    """``gs://bucket/key`` or a relative key as struct(bucket, key)."""
    s = strip(F.coalesce(_col(c), F.lit("")))
    full = s.startswith("gs://")
    has_key = s.rlike(r"^gs://[^/]*/")
    bucket = F.when(has_key, F.regexp_extract(s, r"^gs://([^/]*)/", 1)).otherwise(F.lit(default_bucket))
    key = (
        F.when(has_key, F.regexp_extract(s, r"(?s)^gs://[^/]*/(.*)$", 1))
        .when(full | (s == ""), F.lit(None))
        .otherwise(F.regexp_replace(s, "^/+", ""))
    )
    return F.struct(bucket.alias("bucket"), F.nullif(key, F.lit("")).alias("key"))


def expand_struct(df: DataFrame, column: str, prefix: str = "") -> DataFrame:
    """Nested fields as top-level columns, name prefix removed."""
    fields = df.schema[column].dataType.fieldNames()
    kept = [c for c in df.columns if c != column]
    return df.select(*kept, *[F.col(column)[f].alias(f.removeprefix(prefix)) for f in fields])


# The vocabularies a normalised record may use.
MAKE_ALIASES = {"vw": "Volkswagen", "chevy": "Chevrolet"}
VOCABULARIES = {
    "transmission": ["automatic", "manual"],
    "drivetrain": ["fwd", "rwd", "awd", "4wd"],
    "fuel_type": ["gasoline", "diesel", "electric", "hybrid"],
    "condition": ["new", "like new", "good", "fair", "salvage"],
    "body_type": ["sedan", "suv", "truck", "coupe", "convertible", "van", "wagon", "hatchback"],
    "title_status": ["clean", "salvage", "rebuilt", "flood", "missing", "other"],
}


def canonical_make(c: Column | str, aliases: dict[str, str] = MAKE_ALIASES) -> Column:
    """Manufacturer in title case, short names spelled out."""
    name = norm_str(c)
    out = F.initcap(name)
    for short, full in aliases.items():
        out = F.when(F.lower(name) == short, F.lit(full)).otherwise(out)
    return out


def canonical_value(c: Column | str, field: str) -> Column:
    """Lower-case value of the field's vocabulary, NULL outside it."""
    value = F.lower(norm_str(c))
    return F.when(value.isin(VOCABULARIES[field]), value)


def canonical_model(c: Column | str) -> Column:
    return F.initcap(norm_str(c))


def canonical_color(c: Column | str) -> Column:
    return F.lower(norm_str(c))


def canonical_city(c: Column | str) -> Column:
    return F.initcap(norm_str(c))


def canonical_state(c: Column | str) -> Column:
    value = F.upper(norm_str(c))
    return F.when(value.rlike("^[A-Z]{2}$"), value)


def canonical_zip(c: Column | str) -> Column:
    value = norm_str(c)
    return F.when(value.rlike("^[0-9]{5}$"), value)


def canonical_record(df: DataFrame) -> DataFrame:
    """Apply every vocabulary to the columns that exist."""
    rules = {
        "make": canonical_make, "model": canonical_model, "color": canonical_color,
        "city": canonical_city, "state": canonical_state, "zip_code": canonical_zip,
    }
    fixes = {c: rule(c) for c, rule in rules.items() if c in df.columns}
    fixes.update({c: canonical_value(c, c) for c in VOCABULARIES if c in df.columns})
    return df.withColumns(fixes)
