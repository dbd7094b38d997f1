"""Dotted paths such as ``addresses[0].city`` compiled to Columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STEP = re.compile(r"([^.\[\]]+)|\[(\d*)\]")


def _steps(path: str) -> list[str | int]:
    out: list[str | int] = []
    for name, index in _STEP.findall(path):
        out.append(name if name else int(index or 0))
    return out


def path_column(df: DataFrame, path: str, null_type: str = "string") -> Column:
    """Value at ``path``. ``[]`` means the first element; an absent step gives null.

    A field name applied to an array reads the array's first element, so
    ``items.id`` and ``items[0].id`` agree.
    """
    null = F.lit(None).cast(null_type)
    steps = _steps(path)
    if not steps or steps[0] not in df.columns:
        return null
    dtype: T.DataType = df.schema[steps[0]].dataType
    value = F.col(f"`{steps[0]}`")
    for step in steps[1:]:
        if isinstance(step, int):
            if not isinstance(dtype, T.ArrayType):
                return null
            value, dtype = F.get(value, F.lit(step)), dtype.elementType
            continue
        if isinstance(dtype, T.ArrayType):
            value, dtype = F.get(value, F.lit(0)), dtype.elementType
        if isinstance(dtype, T.StructType) and step in dtype.names:
            value, dtype = value.getField(step), dtype[step].dataType
        elif isinstance(dtype, T.MapType):
            value, dtype = F.try_element_at(value, F.lit(step)), dtype.valueType
        else:
            return null
    return value


def first_map_key(value: Column) -> Column:
    return F.get(F.map_keys(value), F.lit(0))


def json_path(text: Column, path: str) -> Column:
    """Scalar at ``a.b[].c`` inside raw JSON text; ``[]`` means the first element."""
    return F.get_json_object(text, "$." + path.replace("[]", "[0]"))
