"""Cleaning and normalizing whole tables, each in one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions import clock, parse, text


def clean(
    df: DataFrame,
    trim: bool = True,
    empty_to_null: bool = True,
    fix_encoding: bool = True,
    null_tokens: tuple[str, ...] = (),
    drop_controls: bool = False,
) -> DataFrame:
    """Trim, empty to null and encoding repair on every string column.

    The null tokens and control characters are a second, stricter mode.
    """

    def one(c: Column) -> Column:
        # The repair neither makes nor removes blanks, so it may come first, where its input is a plain column.
        if fix_encoding:
            c = text.repair_encoding(c)
        if drop_controls:
            c = text.strip_spaces(text.drop_control_chars(c))
        if trim:
            c = F.trim(c)
        if null_tokens:
            c = text.tokens_to_null(c, null_tokens)
        if empty_to_null:
            c = text.blank_to_null(c)
        return c

    return df.select(
        *[
            one(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


RULES = {
    "email_lower": lambda c: F.lower(c),
    "email": lambda c: text.valid_email(c),
    "phone_digits": lambda c: text.phone_digits(c),
    "phone": lambda c, country_code=text.COUNTRY_CODE: text.phone_international(c, country_code),
    "date": lambda c: parse.date_text(c, parse.DATE_FORMATS[:1]),
    "timestamp": lambda c: parse.timestamp_text(c, parse.TIMESTAMP_FORMATS[:1]),
    "timestamp_to_utc": lambda c: clock.iso_to_utc(c),
    "trim": lambda c: text.strip_spaces(c),
    "case": lambda c, case="lower": text.change_case(c, case),
    "remove_extra_spaces": lambda c: text.collapse_spaces(c),
}


def normalize(df: DataFrame, rules: dict[str, dict]) -> DataFrame:
    """Apply ``{column: {"type": ..., "params": {...}}}``.

    A column that is absent is skipped; an unknown type is an error. Parsers
    leave columns that are not text alone.
    """
    for rule in rules.values():
        if rule["type"] not in RULES:
            raise ValueError(f"unknown normalization: {rule['type']}")
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        rule = rules.get(f.name)
        if rule and isinstance(f.dataType, T.StringType):
            c = RULES[rule["type"]](c, **rule.get("params", {}))
        out.append(c.alias(f.name))
    return df.select(*out)


def contact_rules(emails=(), phones=(), dates=(), timestamps=()) -> dict[str, dict]:
    """The simple rule set: lower-case email, digits-only phone, fixed-format dates."""
    kinds = {"email_lower": emails, "phone_digits": phones, "date": dates, "timestamp": timestamps}
    return {c: {"type": kind} for kind, names in kinds.items() for c in names}
