"""Good and bad rows, and the dead-letter form of the bad ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _valid() -> Column:
    """A row of unknown validity counts as bad, so it is never lost."""
    return F.coalesce(F.col("_quality_valid"), F.lit(False))


def good(df: DataFrame) -> DataFrame:
    return df.filter(_valid())


def bad(df: DataFrame) -> DataFrame:
    return df.filter(~_valid())


def split_bad(df: DataFrame, mode: str = "flag") -> DataFrame:
    """``exclude`` drops bad rows, ``flag`` keeps them marked; both set ``_error_handled``."""
    if "_quality_valid" not in df.columns:
        return df.withColumn("_error_handled", F.lit(False))
    if mode == "exclude":
        return good(df).withColumn("_error_handled", F.lit(True))
    if mode == "flag":
        return df.withColumn("_error_handled", ~_valid())
    raise ValueError(f"unknown recovery mode: {mode}")


def dead_letters(df: DataFrame, at: Column) -> DataFrame:
    return bad(df).withColumns({"_dlq_timestamp": at, "_dlq_reason": F.col("_quality_issues")})
