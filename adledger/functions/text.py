"""Text cleaning. Patterns carry ``(?U)`` so blanks, digits and word borders are
Unicode-aware and ``(?d)`` so only a newline ends a line."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from .numbers import BLANK_CHARACTERS, _col

# Any blank, for patterns with (?U): the White_Space property and four ASCII separators.
BLANK = r"[\s\x1c-\x1f]"

# What the modeling text drops, in this order. The thousands form
# of a dollar amount goes before the plain form.
REMOVED_FROM_LISTING_TEXT = [
    rf"(?Uidm)^{BLANK}*image_url{BLANK}*:{BLANK}*.*$",
    r"(?U)https?://[^\s\x1c-\x1f]+",
    rf"(?Uidm)^{BLANK}*(price|asking price|listed price){BLANK}*[:\-]{BLANK}*.*$",
    rf"(?U)\${BLANK}*\d{{1,3}}(?:,\d{{3}})+(?:\.\d+)?",
    rf"(?U)\${BLANK}*\d+(?:\.\d+)?",
]
# Marks of a file path inside a text.
PATH_MARKS = r"scrapes/|gs://|\.txt"


def strip(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit(BLANK_CHARACTERS))


def collapse(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), f"(?U){BLANK}+", " ")


def norm_str(c: Column | str) -> Column:
    """Trimmed text; empty is NULL."""
    return F.nullif(strip(_col(c).cast("string")), F.lit(""))


def clean_text_value(c: Column | str) -> Column:
    """Lower case, single spaces, trimmed; NULL becomes ''."""
    return F.trim(collapse(F.lower(F.coalesce(_col(c).cast("string"), F.lit("")))))


def clean_listing_text(c: Column | str) -> Column:
    """Listing text for modeling: no image lines, URLs, price lines or dollar amounts."""
    raw = F.coalesce(_col(c), F.lit(""))
    kept = reduce(lambda t, p: F.regexp_replace(t, p, " "), REMOVED_FROM_LISTING_TEXT, raw)
    return F.trim(collapse(F.lower(kept)))


def combined_text_fallback(title: Column | str | None, description: Column | str | None) -> Column:
    """Title and description as one cleaned text; a missing side counts as ''."""
    sides = [F.lit("") if c is None else F.coalesce(_col(c), F.lit("")) for c in (title, description)]
    return clean_text_value(F.concat(sides[0], F.lit(" "), sides[1]))


def text_len(c: Column | str) -> Column:
    return F.length(F.coalesce(_col(c), F.lit(""))).cast("bigint")


def has_text(c: Column | str) -> Column:
    return text_len(c) > 0


def text_excerpt(c: Column | str, length: int = 250) -> Column:
    return F.substring(collapse(F.coalesce(_col(c), F.lit(""))), 1, length)


def append_image_line(text: Column | str, image_url: Column | str) -> Column:
    """Add the image line the text extractor looks for, when there is an image."""
    url = F.coalesce(_col(image_url), F.lit(""))
    line = F.concat(F.lit("\nimage_url: "), url, F.lit("\n"))
    return F.concat(_col(text), F.when(url != "", line).otherwise(F.lit("")))


def looks_like_path(c: Column | str) -> Column:
    return F.coalesce(_col(c).rlike(PATH_MARKS), F.lit(False))


def price_in_text(price: Column | str, text: Column | str) -> Column:
    """Does the whole-number price stand in the text, plain or with thousands commas?

    The two spellings with a leading ``$`` contain these two, so they need no test.
    """
    whole = _col(price).try_cast("bigint")
    body = F.lower(F.coalesce(_col(text), F.lit("")))
    found = body.contains(whole.cast("string")) | body.contains(F.format_number(whole, 0))
    return F.coalesce(found, F.lit(False))


# The punctuation a token loses.
PUNCTUATION = r"""[!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~']"""


def split_tokens(c: Column | str, at_most: int | None = None) -> Column:
    """Lower case, ASCII punctuation removed, split on blanks.

    ``at_most`` gives the first tokens only, without splitting the rest of the text.
    """
    lower = F.lower(F.coalesce(_col(c), F.lit("")))
    bare = strip(F.regexp_replace(lower, PUNCTUATION, ""))
    if at_most is None:
        tokens = F.split(bare, f"(?U){BLANK}+")
    else:
        tokens = F.slice(F.split(bare, f"(?U){BLANK}+", at_most + 1), 1, at_most)
    return F.filter(tokens, lambda t: t != "")
