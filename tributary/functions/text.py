"""Cleaning and normalizing text, one Column at a time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats the checks must accept.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
PHONE_PATTERN = r"^[\d\s\-\+\(\)]+$"
COUNTRY_CODE = "51"
NULL_TOKENS = ("null",)
MAX_VARCHAR = 65535
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def repair_encoding(c: Column) -> Column:
    """Replace characters outside the basic plane (U+0000 to U+FFFF) by ``?``.

    Plain ASCII, the usual case, has as many bytes as characters and skips the
    pattern.
    """
    return F.when(F.octet_length(c) == F.length(c), c).otherwise(
        F.regexp_replace(c, "[^\\x{0000}-\\x{FFFF}]", "?")
    )


def tokens_to_null(c: Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    return F.when(F.lower(F.trim(c)).isin([t.lower() for t in tokens]), F.lit(None)).otherwise(c)


def drop_control_chars(c: Column) -> Column:
    """Line ends become one ``\\n``; every other control character but tab goes."""
    unified = F.regexp_replace(c, "\\r\\n?", "\n")
    return F.regexp_replace(unified, "[\\x00-\\x08\\x0B-\\x1F\\x7F]", "")


def strip_spaces(c: Column) -> Column:
    """Trim every kind of white space, not just blanks."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def collapse_spaces(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "\\s+", " "))


def valid_email(c: Column) -> Column:
    """Trimmed and lower-cased; null when it is not an address."""
    return F.regexp_substr(F.lower(strip_spaces(c)), F.lit(EMAIL_PATTERN))


def phone_digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def phone_international(c: Column, country_code: str = COUNTRY_CODE) -> Column:
    """``+<country><digits>``; a number that already starts with the code keeps it."""
    digits = phone_digits(c)
    # The digits stand outside the branches, where Spark finds them once.
    return F.concat(F.when(digits.startswith(country_code), F.lit("+")).otherwise(F.lit("+" + country_code)), blank_to_null(digits))


def title_case(c: Column) -> Column:
    """Capital at the start of every run of letters (``o'neil`` gives ``O'Neil``)."""
    runs = F.regexp_extract_all(c, F.lit("(\\p{L}+|[^\\p{L}]+)"), F.lit(1))
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(r.substr(F.lit(2), F.length(r))))),
        "",
    )


def change_case(c: Column, case: str = "lower") -> Column:
    builders = {"lower": F.lower, "upper": F.upper, "title": title_case}
    if case not in builders:
        raise ValueError(f"unknown case: {case}")
    return builders[case](c)


def truncate(c: Column, length: int = MAX_VARCHAR) -> Column:
    return F.substring(c.cast("string"), 1, min(length, MAX_VARCHAR))


def material_key(c: Column, width: int = 18) -> Column:
    """Right-most ``width`` characters of the zero-padded code."""
    padded = F.concat(F.lit("0" * width), c.cast("string"))
    return padded.substr(F.length(padded) - F.lit(width - 1), F.lit(width))


def valid_json(c: Column, length: int | None = None) -> Column:
    """The whole JSON text when it parses, and fits ``length`` characters if that is given; else null, never a part."""
    good = F.try_parse_json(c).isNotNull()
    return F.when(good if length is None else good & (F.char_length(c) <= length), c)
