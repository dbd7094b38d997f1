"""Inferred types that are kept from run to run and only ever widen.

The types form a lattice: nothing seen, then int, bigint, decimals by their digits, double, with text above all; flags,
dates and times have only text above them. A run's plan is stored as rows (column, type); the plan in force is the join
of all runs' rows, so it does not depend on their order and a repeated run changes nothing.

The first run profiles its input. Later runs convert by the plan without a profile: a value that does not fit goes,
as it is, into the ``_untyped`` object of its row, so none is lost, and afterwards only those values are profiled to
widen the plan for the next run.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators import typing
from tributary.session import materialize

UNTYPED = "_untyped"
TEXT = "string"
_SCHEMA = "column string, type string, run string"
#: Whole numbers as decimals: digits that always suffice.
_WHOLE = {"int": 10, "bigint": 19}


def _decimal(kind: str) -> tuple[int, int] | None:
    """Whole and fractional digits of a number type that is exact; None for others."""
    if kind in _WHOLE:
        return _WHOLE[kind], 0
    found = re.fullmatch(r"decimal\((\d+),(\d+)\)", kind)
    return (int(found[1]) - int(found[2]), int(found[2])) if found else None


def join(a: str | None, b: str | None) -> str | None:
    """The least type that holds every value of both; None is the type of a column without values."""
    if a is None or b is None or a == b:
        return b if a is None else a
    if {a, b} == {"int", "bigint"}:
        return "bigint"
    if {a, b} == {"int", "double"}:
        return "double"
    x, y = _decimal(a), _decimal(b)
    if x is None or y is None:
        return TEXT
    whole, scale = max(x[0], y[0]), max(x[1], y[1])
    return f"decimal({whole + scale},{scale})" if whole + scale <= typing.MAX_DIGITS else TEXT


def merged(*plans: dict[str, str]) -> dict[str, str]:
    """The join of several plans, column by column."""
    out: dict[str, str] = {}
    for plan in plans:
        for column, kind in plan.items():
            out[column] = join(out.get(column), kind)
    return out


def of_profile(profile: DataFrame) -> dict[str, str]:
    """Types without loss, text included; columns without values are left open. One row per column is read."""
    rows = profile.filter("filled > 0").select("column", typing.decided_type(1.0).alias("type")).collect()
    return {r["column"]: r["type"] for r in rows}


def load(spark: SparkSession, path: str) -> dict[str, str] | None:
    """The plan in force; None before the first run. There is one row per column and run."""
    try:
        rows = spark.read.schema(_SCHEMA).option("recursiveFileLookup", "true").parquet(path).collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return merged(*[{r["column"]: r["type"]} for r in rows])


def save(spark: SparkSession, plan: dict[str, str], path: str, run: str) -> None:
    rows = [(c, t, run) for c, t in sorted(plan.items())]
    materialize(spark.createDataFrame(rows, _SCHEMA).coalesce(1), path=f"{path}/{run}")


def apply(df: DataFrame, plan: dict[str, str]) -> DataFrame:
    """Typed columns, and ``_untyped``: a JSON object, column to text, of a row's values that do not fit (null if all do)."""
    planned = [c for c in typing.text_columns(df) if plan.get(c, TEXT) != TEXT]
    typed = typing.apply_types(df, {c: plan[c] for c in planned})
    if not planned:
        return typed.withColumn(UNTYPED, F.lit(None).cast("string"))
    misfit = [
        F.when(
            F.col(f"`{c}`").isNotNull() & typing._to_inferred(F.col(f"`{c}`"), plan[c]).isNull(),
            F.struct(F.lit(c).alias("key"), F.col(f"`{c}`").alias("value")),
        )
        for c in planned
    ]
    kept = F.map_from_entries(F.array_compact(F.array(*misfit)))
    values = [typing._to_inferred(F.col(f"`{f}`"), plan[f]).alias(f) if f in planned else F.col(f"`{f}`") for f in df.columns]
    return df.select(*values, F.when(F.size(kept) > 0, F.to_json(kept)).alias(UNTYPED))


def typed(df: DataFrame, path: str, run: str, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Convert by the stored plan; only columns that no run has seen yet are profiled."""
    spark = df.sparkSession
    plan = load(spark, path) or {}
    fresh = tuple(c for c in typing.text_columns(df, exclude) if c not in plan)
    if fresh:
        found = of_profile(typing.inference_profile(df.select(*[F.col(f"`{c}`") for c in fresh])))
        save(spark, found, path, run)
        plan = merged(plan, found)
    return apply(df, {c: t for c, t in plan.items() if c not in exclude})


def learn(written: DataFrame, path: str, run: str) -> dict[str, str]:
    """Widen the stored plan by the values that did not fit in a run's output; returns the plan in force.

    Reads the ``_untyped`` column alone. Call it on the written rows, so that nothing is evaluated again.
    """
    spark = written.sparkSession
    misfits = F.from_json(UNTYPED, "map<string,string>")
    tall = written.filter(F.col(UNTYPED).isNotNull()).select(F.explode(misfits).alias("column", "value"))
    found = of_profile(typing.profile_values(tall))
    if found:
        save(spark, found, path, f"{run}-widened")
    return load(spark, path) or {}
