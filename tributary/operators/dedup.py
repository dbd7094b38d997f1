"""Finding duplicates and choosing one record per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.operators.skew import with_group_stats

# Lower wins when two copies arrived at the same time.
SOURCE_PRIORITY = {"webhook": 1, "polling": 2}
OTHER_SOURCE = 3


def _require(df: DataFrame, keys: list[str]) -> None:
    if not keys:
        raise ValueError("name at least one key column")
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"key columns not found: {missing}")


def mark_duplicates(df: DataFrame, keys: list[str], min_hot_rows: int | None = None, stored: bool = False) -> DataFrame:
    """Add ``is_duplicate`` and ``duplicate_group_id``; null keys form one group.

    ``stored`` says that ``df`` only reads stored columns, which then need no staging (``skew.with_group_stats``).

    The group id is a hash of the key, so it needs no global order. See
    ``windows.dense_group_id`` for consecutive numbers.
    """
    _require(df, keys)
    counted = with_group_stats(df, keys, min_hot_rows, stored, _copies=F.count(F.lit(1)))
    return counted.select(
        *df.columns,
        (F.col("_copies") > 1).alias("is_duplicate"),
        F.xxhash64(*keys).alias("duplicate_group_id"),
    )


def null_count(columns: list[str]) -> Column:
    if not columns:
        return F.lit(0)
    return reduce(lambda a, b: a + b, [F.col(f"`{c}`").isNull().cast("int") for c in columns])


def row_fingerprint(df: DataFrame) -> Column:
    """A number that depends on the row alone, the last resort among equal rows."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def resolve_conflicts(
    df: DataFrame,
    keys: list[str],
    order_col: str | None = None,
    priority: Column | None = None,
    strategy: str = "most_recent",
    tie_break: list[Column] | None = None,
) -> DataFrame:
    """One record per key: latest first, then priority, then fewest nulls.

    Ties fall to the row fingerprint, so the winner does not depend on how the
    data is partitioned. The ``row_number() = 1`` form lets Spark cut every key
    to one candidate per task before the shuffle, hot keys included.
    """
    _require(df, keys)
    business = [c for c in df.columns if c not in ("is_duplicate", "duplicate_group_id")]
    latest = [F.col(order_col).desc_nulls_last()] if order_col and order_col in df.columns else []
    ranked = [priority.asc_nulls_last()] if priority is not None else []
    fewest = [null_count(business).asc()]
    orders = {
        "most_recent": latest + ranked + fewest,
        "least_nulls": fewest + latest + ranked,
        "first": [F.col(order_col).asc_nulls_last()] if latest else [],
    }
    if strategy not in orders:
        raise ValueError(f"unknown strategy: {strategy}")
    last = tie_break if tie_break is not None else [row_fingerprint(df.select(*business)).asc()]
    window = Window.partitionBy(*keys).orderBy(*orders[strategy], *last)
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .drop("_rank", "is_duplicate", "duplicate_group_id")
    )


def source_rank(source: Column, table: dict[str, int] = SOURCE_PRIORITY, other: int = OTHER_SOURCE) -> Column:
    chain = None
    for name, rank in table.items():
        chain = F.when(source == name, rank) if chain is None else chain.when(source == name, rank)
    return chain.otherwise(F.lit(other))


def merge_versions(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """Field by field: the newest value that is not null."""
    _require(df, keys)
    others = [c for c in df.columns if c not in keys and c != order_col]
    picks = [
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(order_col, F.xxhash64(c)))).alias(c) for c in others
    ]
    return df.groupBy(*keys).agg(F.max(order_col).alias(order_col), *picks).select(*df.columns)


def pk_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    _require(df, keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def pk_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """Total rows, distinct keys and surplus rows, in one pass."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return per_key.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("surplus_rows"),
    )
