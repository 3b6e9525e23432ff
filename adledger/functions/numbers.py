"""Number parsing and formatting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


# The Unicode blanks.
BLANK_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_numeric(c: Column | str) -> Column:
    """Keep digits and dots of a text value, then read it as a double or NULL.

    The sign is dropped and two dots make the value NULL.
    """
    kept = F.regexp_replace(_col(c), r"(?U)[^\d.]+", "")
    # Guarded: a failing text-to-double cast throws inside, which is slow.
    return F.when(kept.rlike(r"^(?:[0-9]+\.?[0-9]*|\.[0-9]+)$"), kept.try_cast("double"))


def clean_numeric_column(df: DataFrame, name: str) -> Column:
    """`clean_numeric` for a text column; a column already numeric only loses its
    sign (its text form could carry an exponent, whose digits must not leak in)."""
    if isinstance(df.schema[name].dataType, T.NumericType):
        return F.abs(F.col(name).cast("double"))
    return clean_numeric(F.col(name).cast("string"))


def safe_int(c: Column | str) -> Column:
    """Whole number after removing commas and outer blanks, else NULL (``12.5`` is NULL)."""
    text = F.replace(_col(c).cast("string"), F.lit(","), F.lit(""))
    bare = F.btrim(text, F.lit(BLANK_CHARACTERS))
    return F.when(bare.rlike(r"^[+-]?[0-9]+$"), bare.try_cast("bigint"))


def to_numeric_coerce(c: Column | str) -> Column:
    """Number or NULL, with no cleaning: ``$9,500`` is NULL."""
    return _col(c).try_cast("double")


def fmt_number(c: Column | str, digits: int = 0) -> Column:
    """Thousands-separated label; keep the numeric twin beside it."""
    return F.format_number(_col(c), digits)


def round_half_even(c: Column | str, digits: int) -> Column:
    return F.bround(_col(c), digits)


def round1(c: Column | str) -> Column:
    return round_half_even(c, 1)


def round2(c: Column | str) -> Column:
    return round_half_even(c, 2)


def round4(c: Column | str) -> Column:
    return round_half_even(c, 4)
