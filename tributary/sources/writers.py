"""Writing each layer. None of these gathers data into one task unless asked to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators.nested import complex_to_json, flatten
from tributary.operators.tables import date_partitions

def write_json(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> None:
    """JSON lines; one file only on request, for small exports."""
    (df.coalesce(1) if single_file else df).write.mode(mode).json(path)


def write_text(df: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON text per row."""
    df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value")).write.mode(mode).text(path)


def write_partitioned(
    df: DataFrame, path: str, by: list[str], mode: str = "overwrite", sort: list[str] | None = None
) -> None:
    """Snappy Parquet by partition; overwrite replaces only the partitions that occur.

    A rebalance groups each partition's rows into full-size files and splits a
    partition that is far larger than the others.
    """
    out = df.hint("rebalance", *[F.col(c) for c in by])
    if sort:
        out = out.sortWithinPartitions(*by, *sort)
    (
        out.write.mode(mode)
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def land(df: DataFrame, path: str, client: str, entity: str, as_of: Column, fmt: str = "json") -> None:
    """Append raw rows to Bronze under client, entity, year, month, day. No rows, no files."""
    stamped = date_partitions(df.withColumn("_landed", as_of), "_landed").drop("_landed")
    parts = ["client", "entity", "year", "month", "day"]
    named = stamped.withColumns({"client": F.lit(client), "entity": F.lit(entity)})
    named.write.mode("append").partitionBy(*parts).format(fmt).save(path)


def append(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    write_partitioned(df, path, by)


def full_replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


# Table properties.
TABLE_PROPERTIES = {"write.target-file-size-bytes": "134217728", "history.expire.max-snapshot-age-ms": "2592000000"}


def create_table(df: DataFrame, table: str, by: list[str] | None = None, properties: dict[str, str] | None = None) -> None:
    """Create an empty table with the schema of ``df``."""
    writer = df.limit(0).write.mode("overwrite").format("parquet")
    for k, v in (properties or TABLE_PROPERTIES).items():
        writer = writer.option(k, v)
    (writer.partitionBy(*by) if by else writer).saveAsTable(table)


def create_catalog_table(
    df: DataFrame, table: str, transforms: list[Column] | None = None, properties: dict[str, str] | None = None
) -> None:
    """Create or replace a table in a catalog that knows partition transforms (``years``, ``months``, ``days``)."""
    writer = df.limit(0).writeTo(table)
    for k, v in (properties or TABLE_PROPERTIES).items():
        writer = writer.tableProperty(k, v)
    (writer.partitionedBy(*transforms) if transforms else writer).createOrReplace()


def write_dead_letters(letters: DataFrame, path: str, run: str) -> None:
    """JSON below the run's name; a run that is repeated replaces its own letters and no others."""
    letters.write.mode("overwrite").option("partitionOverwriteMode", "static").json(f"{path}/run={run}")


# Audit tables.
AUDIT_TABLES = {
    "data_gaps_log": "gap_id string, entity_type string, table_name string, field_name string, "
    "record_count bigint, timestamp timestamp",
    "data_quality_issues": "issue_id string, table_name string, record_id string, validation_rule string, "
    "error_message string, timestamp timestamp",
    "schema_changes_log": "change_id string, table_name string, change_type string, column_name string, "
    "old_type string, new_type string, timestamp timestamp",
}


def create_audit_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """Empty, typed audit tables below ``root``; returns their paths."""
    paths = {}
    for name, ddl in AUDIT_TABLES.items():
        paths[name] = f"{root}/{name}"
        spark.createDataFrame([], ddl).write.mode("ignore").parquet(paths[name])
    return paths


def append_audit(df: DataFrame, root: str, name: str) -> None:
    schema = T._parse_datatype_string(AUDIT_TABLES[name])
    df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]).write.mode("append").parquet(
        f"{root}/{name}"
    )


def export_with_manifest(df: DataFrame, path: str, n: int, key: str | None = None, where: str | None = None) -> DataFrame:
    """Write about ``n`` Parquet files and a JSON manifest of rows and bytes per file."""
    spark = df.sparkSession
    rows = df.filter(where) if where else df
    (rows.repartitionByRange(n, key) if key else rows.repartition(n)).write.mode("overwrite").parquet(f"{path}/data")
    counts = (
        spark.read.parquet(f"{path}/data")
        .groupBy(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    sizes = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .load(f"{path}/data")
        .select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"))
    )
    manifest = sizes.join(counts, "file", "left").select(
        "file", F.coalesce("rows", F.lit(0)).alias("rows"), "bytes", F.lit(where).alias("where_clause")
    )
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
    return spark.read.schema("file string, rows bigint, bytes bigint, where_clause string").json(f"{path}/manifest")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; nested columns are flattened, arrays become JSON text."""
    complex_to_json(flatten(df)).write.mode("overwrite").option("header", True).csv(path)


def staged_load(
    gold: DataFrame,
    stage_path: str,
    checks: Callable[[DataFrame], None],
    load: Callable[[DataFrame], None],
) -> None:
    """Write to a staging folder, check what was staged, then load from it.

    ``checks`` raises to stop the load; the stage is then left for inspection.
    """
    gold.write.mode("overwrite").parquet(stage_path)
    staged = gold.sparkSession.read.schema(gold.schema).parquet(stage_path)
    checks(staged)
    load(staged)
