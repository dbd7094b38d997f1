"""Reading Bronze JSON, Silver and Gold tables and relational extracts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# The envelope around every Bronze record.
METADATA_FIELDS = (
    ("client_id", "string"),
    ("entity_type", "string"),
    ("ingestion_timestamp", "string"),
    ("source", "string"),
    ("api_version", "string"),
    ("event_type", "string"),
    ("version", "int"),
)
METADATA_DDL = "struct<" + ",".join(f"{n}:{t}" for n, t in METADATA_FIELDS) + ">"


def as_schema(schema: str | T.StructType) -> T.StructType:
    return T._parse_datatype_string(schema) if isinstance(schema, str) else schema


def parse_lines(lines: DataFrame, schema: str | T.StructType, keep_corrupt: bool = True) -> DataFrame:
    """Text lines (column ``value``) to typed columns, batch or stream.

    A line that does not parse fills ``_corrupt_record`` only. Columns the text
    already has beside ``value`` (partitions) are kept. Reading lines as text
    allows any later query on them, also one that asks for the broken lines alone.
    """
    wanted = as_schema(schema)
    beside = [c for c in lines.columns if c != "value"]
    inside = [f for f in wanted.fields if f.name not in beside]
    if keep_corrupt and CORRUPT not in wanted.names:
        inside.append(T.StructField(CORRUPT, T.StringType()))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    record = F.from_json("value", T.StructType(inside), options)
    parsed = lines.filter(F.length(F.trim("value")) > 0).select(*beside, record.alias("_r"))
    out = [F.col(f.name) if f.name in beside else F.col("_r").getField(f.name).alias(f.name) for f in wanted.fields]
    out += [F.col(c) for c in beside if c not in wanted.names]
    if keep_corrupt and CORRUPT not in wanted.names:
        out.append(F.col("_r").getField(CORRUPT).alias(CORRUPT))
    return parsed.select(*out)


def read_json(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None, keep_corrupt: bool = True
) -> DataFrame:
    """JSON lines. With a schema nothing is inferred and broken lines are kept in ``_corrupt_record``."""
    if schema is None:
        return spark.read.option("mode", "PERMISSIVE").json(path)
    return parse_lines(spark.read.text(path), schema, keep_corrupt)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable rows, and the broken lines in dead-letter form."""
    if CORRUPT not in df.columns:
        return df, df.limit(0)
    broken = F.col(CORRUPT).isNotNull()
    letters = df.filter(broken).select(F.col(CORRUPT).alias("record"), F.lit("CORRUPT_JSON").alias("_dlq_reason"))
    return df.filter(~broken).drop(CORRUPT), letters


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet with partition discovery."""
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def read_many(spark: SparkSession, paths: list[str], fmt: str = "parquet") -> DataFrame:
    """Several tables stacked by column name; absent columns become null."""
    tables = [spark.read.format(fmt).load(p) for p in paths]
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def read_table(spark: SparkSession, name: str, snapshot_id: int | None = None) -> DataFrame:
    """A catalog table, at a snapshot where the catalog supports it."""
    if snapshot_id is None:
        return spark.table(name)
    return spark.read.option("snapshot-id", snapshot_id).table(name)


def wrap_envelope(df: DataFrame, client: str, entity: str, source: str, at: Column, version: str = "v2") -> DataFrame:
    """Every row as ``{_metadata, data}``."""
    meta = F.struct(
        F.lit(client).alias("client_id"),
        F.lit(entity).alias("entity_type"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ingestion_timestamp"),
        F.lit(source).alias("source"),
        F.lit(version).alias("api_version"),
    )
    return df.select(meta.alias("_metadata"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("data"))


def unwrap_envelope(df: DataFrame, meta_prefix: str = "_metadata_", data_prefix: str = "") -> DataFrame:
    meta = [F.col("_metadata").getField(n).alias(meta_prefix + n) for n in df.schema["_metadata"].dataType.names]
    data = [F.col("data").getField(n).alias(data_prefix + n) for n in df.schema["data"].dataType.names]
    return df.select(*meta, *data)


def unwrap_pages(df: DataFrame, payload: str, element_ddl: str) -> DataFrame:
    """One row per record of a page. The payload is a JSON list, or an object with ``data``; else nothing."""
    text = F.trim(F.col(payload))
    listed = F.from_json(text, f"array<{element_ddl}>")
    paged = F.from_json(text, f"struct<data:array<{element_ddl}>>").getField("data")
    records = F.when(text.startswith("["), listed).when(text.startswith("{"), paged)
    others = [c for c in df.columns if c != payload]
    return df.select(*others, F.explode(records).alias("_r")).select(*others, "_r.*")


@dataclass(frozen=True)
class Relational:
    """A table behind JDBC."""

    url: str
    table: str
    properties: dict[str, str] = field(default_factory=dict)


def extract_partitioned(
    spark: SparkSession,
    source: Relational | DataFrame,
    key: str,
    lower: int,
    upper: int,
    n: int,
    where: str | None = None,
) -> DataFrame:
    """Read in ``n`` key ranges at once.

    Ranges of the key give every row to exactly one reader, which slices by
    offset cannot promise. The bounds only place the cuts: rows outside them
    are read by the first and last range. A DataFrame stands in for the
    database where there is none.
    """
    if isinstance(source, Relational):
        table = f"(SELECT * FROM {source.table} WHERE {where}) t" if where else source.table
        return spark.read.jdbc(
            source.url, table, column=key, lowerBound=lower, upperBound=upper, numPartitions=n,
            properties=source.properties,
        )
    df = source.filter(where) if where else source
    return df.repartitionByRange(n, key)


def initial_load(
    orders: DataFrame, customers: DataFrame, on: Column, created: str, floor, client: str, entity: str, at: Column
) -> DataFrame:
    """First load: orders from a date on, with their customer, wrapped for Bronze."""
    rows = orders.filter(F.col(created) >= F.lit(floor)).join(customers, on, "left")
    return wrap_envelope(rows, client, entity, "initial_load", at)


def day_window(days: DataFrame, column: str, first: int, last: int) -> DataFrame:
    """Rows of the day dimension between two day keys."""
    return days.filter(F.col(column).between(first, last))


def read_dead_letters(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The dead letters of all runs, with the name of each one's run."""
    return spark.read.schema(T.StructType([*as_schema(schema).fields, T.StructField("run", T.StringType())])).json(path)
