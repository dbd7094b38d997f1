"""Only what is new since the last run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names a record may give its modification time under, in order.
MODIFIED_FIELDS = ("dateModified", "date_modified", "updated_at", "modified_at")


def since(df: DataFrame, column: str, last) -> DataFrame:
    """Rows after ``last``; the first run (None) passes everything. The filter reaches the scan."""
    return df if last is None else df.filter(F.col(column) > F.lit(last))


def overlapping(df: DataFrame, column: str, last: Column, overlap_minutes: int = 5) -> DataFrame:
    """Rows after ``last`` minus an overlap, so late arrivals are seen twice rather than never."""
    return df.filter(F.col(column) > F.timestamp_add("MINUTE", F.lit(-overlap_minutes), last))


def next_watermark(df: DataFrame, columns: list[str]) -> DataFrame:
    """Newest time over the first present column of each row."""
    present = [F.col(f"`{c}`") for c in columns if c in df.columns]
    return df.agg(F.max(F.coalesce(*present)).alias("watermark"))


def advance(state: DataFrame, entity: str, newest: DataFrame) -> DataFrame:
    """State rows (entity, watermark) after a successful write; it never moves back."""
    fresh = newest.select(F.lit(entity).alias("entity"), "watermark")
    return state.unionByName(fresh).groupBy("entity").agg(F.max("watermark").alias("watermark"))
