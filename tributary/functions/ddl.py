"""Warehouse column types to Spark types."""

from __future__ import annotations

import re

# Base type names and the Spark types they become.
SPARK_TYPES = {
    "VARCHAR": "string",
    "CHAR": "string",
    "TEXT": "string",
    "SMALLINT": "int",
    "INT": "int",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DECIMAL": "decimal",
    "NUMERIC": "decimal",
    "TIMESTAMP": "timestamp",
    "DATE": "date",
    "BOOLEAN": "boolean",
    "DOUBLE": "double",
    "FLOAT": "double",
}

_SHAPE = re.compile(r"^\s*([A-Za-z]+)\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?")


def parse(declared: str) -> tuple[str, int | None, int | None]:
    """``DECIMAL(12,9)`` gives ``("DECIMAL", 12, 9)``."""
    found = _SHAPE.match(declared)
    if not found:
        raise ValueError(f"not a column type: {declared!r}")
    base, first, second = found.groups()
    return base.upper(), int(first) if first else None, int(second) if second else None


def spark_type(declared: str) -> str:
    """The base name decides, so BIGINT is never mistaken for INT."""
    base, first, second = parse(declared)
    target = SPARK_TYPES.get(base, "string")
    if target == "decimal":
        return f"decimal({first or 18},{second if second is not None else (0 if first else 2)})"
    return target


def text_length(declared: str) -> int | None:
    base, first, _ = parse(declared)
    return first if base in ("VARCHAR", "CHAR") else None
