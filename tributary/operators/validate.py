"""Checks of whole tables and comparisons between layers and sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.config import TableSpec
from tributary.functions.money import ratio


def schema_check(df: DataFrame, spec: TableSpec) -> list[tuple[str, str, str]]:
    """(check, column, status): missing columns fail, extra ones warn."""
    want, have = set(spec.fields), set(df.columns)
    out = [("schema", c, "FAIL") for c in sorted(want - have)]
    return out + [("schema", c, "WARN") for c in sorted(have - want)]


def validate(df: DataFrame, spec: TableSpec) -> DataFrame:
    """(check, column, status, detail) rows from one aggregate over the table."""
    rows = schema_check(df, spec)
    spark = df.sparkSession
    calculated = [n for n, f in spec.fields.items() if f.calculated]
    required = [n for n, f in spec.fields.items() if not f.nullable or f.primary_key]
    watched = [c for c in dict.fromkeys([*calculated, *spec.gap_fields, *required]) if c in df.columns]
    counts = df.agg(F.count(F.lit(1)).alias("_all"), *[F.count(F.col(c)).alias(c) for c in watched])

    def line(check: str, column: str, status: Column, detail: Column) -> Column:
        return F.struct(
            F.lit(check).alias("check"), F.lit(column).alias("column"), status.alias("status"),
            detail.cast("bigint").alias("detail"),
        )

    lines = [line("not_empty", "*", F.when(F.col("_all") > 0, "PASS").otherwise("FAIL"), F.col("_all"))]
    for c in watched:
        nulls = F.col("_all") - F.col(c)
        if c in calculated:
            lines.append(line("calculated", c, F.when(F.col(c) > 0, "PASS").otherwise("FAIL"), F.col(c)))
        if c in spec.gap_fields:
            lines.append(line("gap", c, F.when(nulls > 0, "WARN").otherwise("PASS"), nulls))
        if c in required:
            lines.append(line("required", c, F.when(nulls == 0, "PASS").otherwise("FAIL"), nulls))
    tall = counts.select(F.explode(F.array(*lines)).alias("l")).select("l.*")
    if not rows:
        return tall
    known = spark.createDataFrame([(*r, None) for r in rows], "check string, column string, status string, detail bigint")
    return known.unionByName(tall)


def overall(report: DataFrame) -> DataFrame:
    """PASS when nothing failed."""
    failed = F.count_if(F.col("status") == "FAIL")
    return report.agg(
        failed.alias("failures"), F.when(failed == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status")
    )


def quality_score(existing: int, valid_schemas: int, tables: int) -> float:
    return (existing + valid_schemas) / (2 * tables) if tables else 0.0


def reconcile(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows per layer and the share kept from the layer before."""
    counts = [
        df.agg(F.lit(n).alias("position"), F.lit(name).alias("layer"), F.count(F.lit(1)).alias("rows"))
        for n, (name, df) in enumerate(layers.items())
    ]
    stacked = reduce(lambda a, b: a.unionByName(b), counts)
    before = stacked.select((F.col("position") + 1).alias("position"), F.col("rows").alias("rows_before"))
    return stacked.join(before, "position", "left").withColumn(
        "kept_share", ratio(F.col("rows"), F.col("rows_before"))
    )


def compare_sources(sources: dict[str, DataFrame], metrics: list[Column]) -> DataFrame:
    """The same metrics of several sources, one labelled row each."""
    rows = [df.agg(F.lit(name).alias("source"), *metrics) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b), rows)


def missing_either_side(left: DataFrame, right: DataFrame, key: str, names: tuple[str, str]) -> DataFrame:
    """Keys found on one side only: one full join of the distinct keys."""
    a = left.select(key).distinct().withColumn("_l", F.lit(True))
    b = right.select(key).distinct().withColumn("_r", F.lit(True))
    issue = F.when(F.col("_r").isNull(), F.lit(f"missing in {names[1]}")).when(
        F.col("_l").isNull(), F.lit(f"missing in {names[0]}")
    )
    return a.join(b, key, "full").select(key, issue.alias("issue")).filter("issue is not null")
