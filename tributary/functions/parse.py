"""Text to typed values. A value that does not parse becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings and formats, in the order they are tried.
TRUE_WORDS = ["true", "1", "yes", "y", "t"]
FALSE_WORDS = ["false", "0", "no", "n", "f"]
DATE_FORMATS = ["yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "yyyy/MM/dd"]
TIMESTAMP_FORMATS = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "dd/MM/yyyy HH:mm:ss",
    "MM/dd/yyyy HH:mm:ss",
]
NUMBER_SHAPE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def bool_text(c: Column) -> Column:
    word = F.lower(c.cast("string"))
    return F.when(word.isin(TRUE_WORDS), F.lit(True)).when(word.isin(FALSE_WORDS), F.lit(False))


def fixed_width(fmt: str) -> tuple[str, list[tuple[str, int]]]:
    """Shape of a fixed-width format (see ``shape_of``), and where each of its parts starts (from 1)."""
    plain = fmt.replace("'", "")
    shape = "".join("0" if ch in "yMdHms" else ch for ch in plain)
    parts = [(p, plain.index(p) + 1) for p in ("yyyy", "MM", "dd", "HH", "mm", "ss") if p in plain]
    return shape, parts


def shape_of(c: Column) -> Column:
    """The text with every digit made 0: all values of a fixed-width format have one shape."""
    return F.translate(c, "0123456789", "0000000000")


def _iso(c: Column, fmt: str) -> Column:
    """Text of this format in ISO order."""
    at = {p: F.substring(c, start, len(p)) for p, start in fixed_width(fmt)[1]}
    iso = [at["yyyy"], F.lit("-"), at["MM"], F.lit("-"), at["dd"]]
    if "HH" in at:
        iso += [F.lit(" "), at["HH"], F.lit(":"), at["mm"], F.lit(":"), at["ss"]]
    return F.concat(*iso)


def _by_shape(c: Column, formats: list[str], target: str, shape: Column | None) -> Column:
    """Text whose shape is that of a format, put into ISO order and cast; anything else is null.

    Checking the shape first keeps text that does not match away from the parser, which is slow when it fails.
    Formats of one shape are tried in their order. ``shape`` is ``shape_of(c)`` where the caller has it already.
    """
    shape = shape_of(c) if shape is None else shape
    by_shape: dict[str, list[str]] = {}
    for fmt in formats:
        by_shape.setdefault(fixed_width(fmt)[0], []).append(fmt)
    out = None
    for fits, same in by_shape.items():
        tries = [_iso(c, f).try_cast(target) for f in same]
        value = tries[0] if len(tries) == 1 else F.coalesce(*tries)
        out = F.when(shape == fits, value) if out is None else out.when(shape == fits, value)
    return out


def date_text(c: Column, formats: list[str] = DATE_FORMATS, shape: Column | None = None) -> Column:
    return _by_shape(c, formats, "date", shape)


def timestamp_text(c: Column, formats: list[str] = TIMESTAMP_FORMATS, shape: Column | None = None) -> Column:
    return _by_shape(c, formats, "timestamp", shape)


def flag_01(c: Column) -> Column:
    """1 and 0 become true and false; anything else is null."""
    return F.when(c == 1, F.lit(True)).when(c == 0, F.lit(False))


def flag_nonzero(c: Column) -> Column:
    """Any value but zero is true."""
    return c != 0


def number_text(c: Column) -> Column:
    """Decimal or exponent notation to double; other text, also ``nan``, is null."""
    text = F.trim(c)
    return F.when(text.rlike(NUMBER_SHAPE), text.try_cast("double"))


def decimal_of(c: Column, precision: int = 12, scale: int = 9) -> Column:
    return c.try_cast(f"decimal({precision},{scale})")


def decimal_overflows(c: Column, precision: int, scale: int) -> Column:
    """True where the value rounded to ``scale`` needs more than ``precision`` digits."""
    return c.isNotNull() & c.try_cast(f"decimal({precision},{scale})").isNull()
