"""Group-by from settings, totals and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.config import AggSpec, Metric
from tributary.functions.money import ratio

# Names of the aggregate columns.
PREFIX = {"sum": "total_", "avg": "promedio_", "min": "min_", "max": "max_", "count_distinct": "distintos_"}
ROW_COUNT = "num_registros"
DISTINCT = "count_distinct"
_FUNCTIONS = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, DISTINCT: F.count_distinct}


def time_dims(df: DataFrame, column: str) -> DataFrame:
    """Year, month, day and ISO week; no change when the column is absent."""
    if column not in df.columns:
        return df
    c = F.col(column)
    return df.withColumns({"year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c), "week": F.weekofyear(c)})


def _metric_columns(df: DataFrame, metrics: tuple[Metric, ...]) -> list[Column]:
    out = []
    for m in metrics:
        for fn in m.functions:
            if m.column == "*":
                if fn == "count":
                    out.append(F.count(F.lit(1)).alias(ROW_COUNT))
            elif m.column in df.columns and fn in _FUNCTIONS:
                out.append(_FUNCTIONS[fn](m.column).alias(PREFIX[fn] + m.column))
    return out


def aggregate(df: DataFrame, spec: AggSpec) -> DataFrame:
    """Group by the dimensions that exist; nothing to compute means pass-through."""
    if spec.date_column:
        df = time_dims(df, spec.date_column)
    if not spec.dimensions or not spec.metrics:
        return df
    columns = _metric_columns(df, spec.metrics)
    if not columns:
        return df
    return df.groupBy(*[d for d in spec.dimensions if d in df.columns]).agg(*columns)


def profile(df: DataFrame) -> DataFrame:
    """Rows, filled, nulls and null share per column: one scan, one row per column."""
    stats = [
        F.struct(F.lit(c).alias("column"), F.count(F.lit(1)).alias("rows"), F.count(F.col(f"`{c}`")).alias("filled"))
        for c in df.columns
    ]
    wide = df.agg(*[s.alias(f"s{i}") for i, s in enumerate(stats)])
    tall = wide.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(stats))])).alias("s")).select("s.*")
    return tall.withColumns(
        {"nulls": F.col("rows") - F.col("filled"), "null_share": ratio(F.col("rows") - F.col("filled"), F.col("rows"))}
    )


def completeness(df: DataFrame) -> DataFrame:
    """Share of non-null cells over the whole table."""
    return profile(df).agg(ratio(F.sum("filled"), F.sum("rows")).alias("completeness"))


def describe(df: DataFrame) -> DataFrame:
    """Count, mean, standard deviation, min and max of every numeric column."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    stats = [
        F.struct(
            F.lit(n).alias("column"),
            F.count(n).alias("count"),
            F.avg(n).alias("mean"),
            F.stddev(n).alias("stddev"),
            F.min(n).cast("double").alias("min"),
            F.max(n).cast("double").alias("max"),
        ).alias(f"s{i}")
        for i, n in enumerate(names)
    ]
    wide = df.agg(*stats)
    return wide.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(names))])).alias("s")).select("s.*")


def bounds(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("low"), F.max(column).alias("high"))


def freshness(df: DataFrame, etl_time: str, key: str, defects: dict[str, Column]) -> DataFrame:
    """Newest load time, rows, distinct keys and one count per defect, keyed in one pass."""
    per_key = df.groupBy(key).agg(
        F.max(etl_time).alias("_newest"),
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(c).alias(n) for n, c in defects.items()],
    )
    return per_key.agg(
        F.max("_newest").alias("newest"),
        F.sum("_rows").alias("rows"),
        F.count(key).alias("distinct_keys"),
        *[F.sum(n).alias(n) for n in defects],
    )


def capped(picked: Column, requested: Column) -> Column:
    """Picked, but never more than requested."""
    return F.least(picked, requested)
