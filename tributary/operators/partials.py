"""Totals that survive incremental runs: mergeable partial aggregates, stored per run.

A run aggregates its own rows only. Per group it stores sums, counts, minima and maxima, and for distinct counts the
keys that no other run has stored yet, one row per group and key, so no group's keys ever meet in one row. The totals of
all runs come from one aggregate over what is stored. A run that is repeated overwrites its own part, so a replay after
a failure changes nothing. Sums merge exactly for whole numbers and decimals; keep money in hundredths.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.config import AggSpec
from tributary.functions.money import ratio
from tributary.operators.aggregate import DISTINCT, PREFIX, ROW_COUNT, time_dims
from tributary.session import materialize

_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
#: Parts that a metric's function is put together from.
_PARTS = {"sum": ("sum",), "avg": ("sum", "count"), "min": ("min",), "max": ("max",), "count": (), DISTINCT: ()}


def _parts(spec: AggSpec) -> list[tuple[str, str]]:
    """(part, column) pairs to keep, without repetition."""
    wanted = [(p, m.column) for m in spec.metrics if m.column != "*" for f in m.functions for p in _PARTS[f]]
    return list(dict.fromkeys(wanted))


def _distinct(spec: AggSpec) -> list[str]:
    return list(dict.fromkeys(m.column for m in spec.metrics if DISTINCT in m.functions))


def _merged(spec: AggSpec) -> list[Column]:
    return [F.sum("_rows").alias("_rows"), *[_MERGE[p](f"_{p}_{c}").alias(f"_{p}_{c}") for p, c in _parts(spec)]]


def partial(df: DataFrame, spec: AggSpec, extra: list[str] | None = None) -> DataFrame:
    """Partial aggregates per group, finer by the columns ``extra``."""
    make = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    columns = [F.count(F.lit(1)).alias("_rows"), *[make[p](c).alias(f"_{p}_{c}") for p, c in _parts(spec)]]
    return df.groupBy(*spec.dimensions, *(extra or [])).agg(*columns)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of all runs below ``path``; None before the first run."""
    try:
        return spark.read.option("recursiveFileLookup", "true").parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def record(df: DataFrame, spec: AggSpec, path: str, run: str) -> None:
    """Store the partial aggregates of ``df`` as ``run``. The input is evaluated once; names of runs must differ."""
    spark, keys = df.sparkSession, _distinct(spec)
    if spec.date_column:
        df = time_dims(df, spec.date_column)
    missing = [d for d in spec.dimensions if d not in df.columns]
    if missing:
        raise ValueError(f"dimensions not found: {missing}")
    names = {k: f"_key_{i}" for i, k in enumerate(keys)}
    named = df.withColumns({n: F.col(f"`{k}`").cast("string") for k, n in names.items()})
    fine = materialize(partial(named, spec, list(names.values())), "partials")
    if keys:
        pairs = F.array(*[F.struct(F.lit(k).alias("_column"), F.col(n).alias("_value")) for k, n in names.items()])
        seen = fine.select(*spec.dimensions, F.explode(pairs).alias("_p")).select(*spec.dimensions, "_p.*")
        seen = seen.filter("_value IS NOT NULL").distinct().withColumn("_run", F.lit(run))
        known = _stored(spark, f"{path}/keys")
        if known is not None:
            on = [*spec.dimensions, "_column", "_value"]
            other = known.filter(F.col("_run") != run).select(*[F.col(c).alias(f"_known_{c}") for c in on])
            same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in on])
            seen = seen.join(other, same, "left_anti")
        materialize(seen, path=f"{path}/keys/{run}")
    groups = fine.groupBy(*spec.dimensions).agg(*_merged(spec))
    materialize(groups.withColumn("_run", F.lit(run)), path=f"{path}/groups/{run}")


def totals(spark: SparkSession, spec: AggSpec, path: str) -> DataFrame:
    """The aggregate of everything recorded, with the columns that ``aggregate`` would give for all rows at once.

    Groups and keys are read as one set of rows, so one shuffle of small rows merges both.
    """
    groups = _stored(spark, f"{path}/groups")
    if groups is None:
        raise ValueError(f"nothing recorded at {path}")
    columns, both = _distinct(spec), groups
    if columns:
        keys = _stored(spark, f"{path}/keys").drop("_run", "_value")
        both = groups.drop("_run").unionByName(keys, allowMissingColumns=True)
    else:
        both = both.withColumn("_column", F.lit(None).cast("string"))
    counted = [F.count_if(F.col("_column") == c).alias(f"_{DISTINCT}_{c}") for c in columns]
    merged = both.groupBy(*spec.dimensions).agg(*_merged(spec), *counted)
    out: list[Column] = []
    for m in spec.metrics:
        for f in m.functions:
            if f == "count":
                out.append(F.col("_rows").alias(ROW_COUNT))
            elif f == "avg":
                out.append(ratio(F.col(f"_sum_{m.column}"), F.col(f"_count_{m.column}")).alias(PREFIX[f] + m.column))
            else:
                out.append(F.col(f"_{f}_{m.column}").alias(PREFIX[f] + m.column))
    return merged.select(*spec.dimensions, *out)


def update(df: DataFrame, spec: AggSpec, path: str, run: str) -> DataFrame:
    """Record ``df`` as ``run`` and return the totals of all runs so far."""
    record(df, spec, path, run)
    return totals(df.sparkSession, spec, path)
