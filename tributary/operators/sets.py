"""Unions over tenants and set comparisons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.operators.windows import top_per_key


def union_tenants(tables: dict[str, DataFrame], origin: str | None = "origin") -> DataFrame:
    """Stack tables by column name; absent columns are null; the tenant becomes a column."""
    named = [df.withColumn(origin, F.lit(name)) if origin else df for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def tenants(df: DataFrame, wanted: list[str], column: str = "client") -> DataFrame:
    """Filter on the tenant column; on a table partitioned by it only those folders are read."""
    return df.filter(F.col(column).isin(wanted))


def union_by_priority(tables: list[DataFrame], keys: list[str], order: list[Column]) -> DataFrame:
    """Distinct rows of each table; the first table wins per key."""
    ranked = [df.distinct().withColumn("_priority", F.lit(n)) for n, df in enumerate(tables)]
    stacked = reduce(lambda a, b: a.unionByName(b), ranked)
    return top_per_key(stacked, keys, [F.col("_priority").asc(), *order]).drop("_priority")


def either(df: DataFrame, conditions: list[Column]) -> DataFrame:
    """Rows of several disjoint filters in one scan."""
    return df.filter(reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions]))


def schema_set_diff(expected: DataFrame, actual: DataFrame, name: str = "name") -> DataFrame:
    """Names on one side only or on both, labelled."""
    a = expected.select(name).distinct().withColumn("_e", F.lit(True))
    b = actual.select(name).distinct().withColumn("_a", F.lit(True))
    state = (
        F.when(F.col("_e").isNull(), F.lit("unexpected"))
        .when(F.col("_a").isNull(), F.lit("missing"))
        .otherwise(F.lit("common"))
    )
    return a.join(b, name, "full").select(name, state.alias("state"))


def column_catalog(df: DataFrame, table: str) -> DataFrame:
    """(table, column, type) rows of a schema."""
    rows = [(table, f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "table string, column string, type string")


def delete_where(df: DataFrame, conditions: list[Column]) -> DataFrame:
    """What is left after a series of deletes. A null condition deletes nothing."""
    gone = reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions], F.lit(False))
    return df.filter(~gone)
