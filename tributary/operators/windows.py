"""Top rows per key and global numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.operators.skew import joined_to_hot, staged_with_hot
from tributary.session import materialize


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows per key. Spark cuts each task's rows to ``n`` per key before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(window)).filter(F.col("_n") <= n).drop("_n")


def _ranged(df: DataFrame, order: list[str]) -> DataFrame:
    """Sorted, balanced ranges with a fixed range number, written once.

    The written copy pins every row to its range: recomputing the sampling of
    range bounds could move rows between the counting and the numbering step.
    """
    parts = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
    return materialize(parts.withColumn("_range", F.spark_partition_id()), "ranged")


def _numbered(df: DataFrame, order: list[str], weight: Column) -> DataFrame:
    """Running total of ``weight`` over the global order, as ``_end``."""
    ranged = _ranged(df, order)
    inside = Window.partitionBy("_range").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    local = ranged.withColumn(
        "_local", F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    # One row per range: at most as many as there are shuffle partitions.
    totals = ranged.groupBy("_range").agg(F.sum(weight).alias("_total"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    return (
        local.join(F.broadcast(offsets), "_range")
        .withColumn("_end", F.col("_local") + F.col("_offset"))
        .drop("_range", "_local", "_offset")
    )


def surrogate_key(df: DataFrame, order: list[str], name: str = "sk") -> DataFrame:
    """1, 2, 3 … in the given order over the whole table, without a single-task sort.

    ``order`` should identify a row; add columns to break ties.
    """
    return _numbered(df, order, F.lit(1)).withColumn(name, F.col("_end").cast("bigint")).drop("_end")


def dense_group_id(df: DataFrame, keys: list[str], name: str = "duplicate_group_id") -> DataFrame:
    """Smallest global row number of each key, attached to every row of the key.

    The input is evaluated once. Keys are counted map-side, numbered in their order and joined back: the few hot keys
    by broadcast, the others by an equi-join on the keys.
    """
    staged, hot, _ = staged_with_hot(df, keys)
    sizes = staged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    first = _numbered(sizes, keys, F.col("_rows")).select(*keys, (F.col("_end") - F.col("_rows") + 1).cast("bigint").alias(name))
    first = materialize(first, "numbered") if hot else first
    is_hot = F.xxhash64(*keys).isin(hot) if hot else F.lit(False)
    right = first.filter(~is_hot).withColumnsRenamed({k: f"_n_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"`_n_{k}`"))
    rest = staged.filter(~is_hot).join(right, same, "left").drop(*right.columns[: len(keys)])
    if not hot:
        return rest
    return rest.unionByName(joined_to_hot(staged.filter(is_hot), first.filter(is_hot), keys))
