"""Nested JSON to flat rows, child tables and key-value tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _free_name(wanted: str, taken: set[str]) -> str:
    if wanted not in taken:
        return wanted
    n = 1
    while f"{wanted}_{n}" in taken:
        n += 1
    return f"{wanted}_{n}"


def _struct_leaves(df: DataFrame, max_depth: int | None, separator: str) -> list[tuple[Column, str, T.DataType]]:
    """Walk the schema once; every leaf gets a name no other column has."""
    taken = set(df.columns)
    leaves: list[tuple[Column, str, T.DataType]] = []

    def walk(value: Column, name: str, dtype: T.DataType, depth: int) -> None:
        if isinstance(dtype, T.StructType) and (max_depth is None or depth < max_depth):
            for f in dtype.fields:
                child = _free_name(f"{name}{separator}{f.name}", taken)
                taken.add(child)
                walk(value.getField(f.name), child, f.dataType, depth + 1)
        else:
            leaves.append((value, name, dtype))

    for f in df.schema.fields:
        walk(F.col(f"`{f.name}`"), f.name, f.dataType, 0)
    return leaves


def explode_arrays(df: DataFrame) -> DataFrame:
    """One row per element of every top-level array; an empty array keeps its row.

    Several arrays multiply. Prefer child tables; this mode exists because
    flat exports ask for it.
    """
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            others = [F.col(f"`{c}`") for c in df.columns if c != f.name]
            position = df.columns.index(f.name)
            cols = [*others[:position], F.explode_outer(F.col(f"`{f.name}`")).alias(f.name), *others[position:]]
            df = df.select(*cols)
    return df


def flatten(df: DataFrame, max_depth: int | None = None, arrays: str = "keep", separator: str = "_") -> DataFrame:
    """All structs become ``parent_child`` columns in a single projection, down to ``max_depth`` levels if it is given.

    ``arrays``: ``keep`` leaves arrays as they are, ``explode`` multiplies rows
    before flattening, ``json`` writes arrays and maps as JSON text.
    """
    if arrays not in ("keep", "explode", "json"):
        raise ValueError(f"unknown array mode: {arrays}")
    if arrays == "explode":
        df = explode_arrays(df)
    out = []
    for value, name, dtype in _struct_leaves(df, max_depth, separator):
        if arrays == "json" and isinstance(dtype, (T.ArrayType, T.MapType)):
            value = F.to_json(value)
        out.append(value.alias(name))
    return df.select(*out)


def child_table(
    df: DataFrame,
    array: str,
    parent_key: str = "id",
    foreign_key: str | None = None,
    ordinal: bool = False,
    keep_empty: bool = True,
) -> DataFrame:
    """One row per array element with the parent's key.

    A null or empty array keeps one row of nulls unless ``keep_empty`` is off.
    """
    key = foreign_key or parent_key
    if ordinal:
        generator = F.posexplode_outer(F.col(array)) if keep_empty else F.posexplode(F.col(array))
        rows = df.select(F.col(parent_key).alias(key), generator.alias("position", "_element"))
        lead = [key, "position"]
    else:
        generator = F.explode_outer(F.col(array)) if keep_empty else F.explode(F.col(array))
        rows = df.select(F.col(parent_key).alias(key), generator.alias("_element"))
        lead = [key]
    element = rows.schema["_element"].dataType
    if isinstance(element, T.StructType):
        taken = set(lead)
        fields = []
        for name in element.names:
            free = _free_name(name, taken)
            taken.add(free)
            fields.append(F.col("_element").getField(name).alias(free))
        return flatten(rows.select(*lead, *fields))
    return rows.withColumnRenamed("_element", array)


def one_to_one_table(df: DataFrame, obj: str, parent_key: str = "id", foreign_key: str | None = None) -> DataFrame:
    return flatten(df.select(F.col(parent_key).alias(foreign_key or parent_key), F.col(f"{obj}.*")))


def key_value_table(df: DataFrame, obj: str, parent_key: str = "id", foreign_key: str | None = None) -> DataFrame:
    """(key, field, value) rows from a struct or a map; other types give an empty table."""
    key = F.col(parent_key).alias(foreign_key or parent_key)
    dtype = df.schema[obj].dataType
    if isinstance(dtype, T.StructType):
        pairs = F.array(
            *[
                F.struct(F.lit(n).alias("field"), F.col(obj).getField(n).cast("string").alias("value"))
                for n in dtype.names
            ]
        )
        return df.select(key, F.explode(pairs).alias("_pair")).select(
            foreign_key or parent_key, "_pair.field", "_pair.value"
        )
    if isinstance(dtype, T.MapType):
        return df.select(key, F.explode_outer(F.col(obj)).alias("field", "value")).withColumn(
            "value", F.col("value").cast("string")
        )
    schema = T.StructType(
        [
            T.StructField(foreign_key or parent_key, df.schema[parent_key].dataType),
            T.StructField("field", T.StringType()),
            T.StructField("value", T.StringType()),
        ]
    )
    return df.sparkSession.createDataFrame([], schema)


def split_entity(df: DataFrame, relations, parent_key: str = "id") -> dict[str, DataFrame]:
    """Parent and child tables of one entity, keyed by table name (parent under ``""``)."""
    tables: dict[str, DataFrame] = {}
    parent = df
    for r in relations:
        if r.column not in df.columns:
            continue
        if r.kind == "one_to_many":
            tables[r.table] = child_table(df, r.column, parent_key, r.foreign_key)
        elif r.kind == "one_to_one":
            tables[r.table] = one_to_one_table(df, r.column, parent_key, r.foreign_key)
        elif r.kind == "key_value":
            tables[r.table] = key_value_table(df, r.column, parent_key, r.foreign_key)
        else:
            raise ValueError(f"unknown relation kind: {r.kind}")
        parent = parent.drop(r.column)
    tables[""] = flatten(parent)
    return tables


def zip_arrays(df: DataFrame, parent_key: str, arrays: list[str]) -> DataFrame:
    """Pair arrays by position; the shorter one is padded with nulls."""
    zipped = F.arrays_zip(*[F.col(a) for a in arrays])
    rows = df.select(parent_key, F.posexplode(zipped).alias("position", "_pair"))
    return rows.select(parent_key, "position", *[F.col("_pair").getField(a).alias(a) for a in arrays])


def count_where(array: Column, predicate) -> Column:
    """Elements that satisfy ``predicate``; a missing array counts as 0."""
    return F.coalesce(F.size(F.filter(array, predicate)), F.lit(0))


def array_length(array: Column) -> Column:
    return F.coalesce(F.size(array), F.lit(0))


def array_field_max(array: Column, field: str) -> Column:
    return F.array_max(F.transform(array, lambda e: e.getField(field)))


def complex_to_json(df: DataFrame) -> DataFrame:
    """Every struct, array and map column as whole JSON text."""
    return df.select(
        *[
            F.to_json(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def project(df: DataFrame, targets: list[str]) -> tuple[DataFrame, list[str]]:
    """Keep the target columns that exist, and name those that do not."""
    present = [c for c in targets if c in df.columns]
    return df.select(*present), [c for c in targets if c not in df.columns]
