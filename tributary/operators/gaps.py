"""Missing data: mark, fill, describe and report."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.config import TableSpec
from tributary.functions.clock import to_micros
from tributary.functions.ddl import spark_type
from tributary.session import materialize

# Fields the source does not offer, and how much each one matters.
FIELD_IMPACT = {"items_substituted_qty": "medium", "items_qty_missing": "high", "total_changes": "low"}
IMPACT_LEVELS = ("low", "medium", "high")


def mark_gaps(df: DataFrame, critical: list[str], ignore_missing: bool = False) -> DataFrame:
    """Add ``has_critical_gaps``. A column that does not exist is an error unless ignored."""
    missing = [c for c in critical if c not in df.columns]
    if missing and not ignore_missing:
        raise ValueError(f"critical columns not found: {missing}")
    present = [c for c in critical if c in df.columns]
    flag = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in present], F.lit(False))
    return df.withColumn("has_critical_gaps", flag)


def fill_defaults(df: DataFrame, defaults: dict[str, Any], flag_imputed: bool = False) -> DataFrame:
    """Replace nulls by defaults; optionally record which values were put in."""
    out = []
    for c in df.columns:
        col = F.col(f"`{c}`")
        out.append(F.coalesce(col, F.lit(defaults[c])).alias(c) if c in defaults else col)
    if flag_imputed:
        out += [F.col(f"`{c}`").isNull().alias(f"_{c}_imputed") for c in defaults if c in df.columns]
    return df.select(*out)


def reject_incomplete(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("has_critical_gaps"))


def handle_gaps(
    df: DataFrame,
    critical: list[str],
    defaults: dict[str, Any] | None = None,
    reject: bool = False,
    fill_first: bool = False,
) -> DataFrame:
    """Mark then fill, or fill then mark when ``fill_first`` is set."""
    if fill_first:
        df = mark_gaps(fill_defaults(df, defaults or {}), critical, ignore_missing=True)
    else:
        df = fill_defaults(mark_gaps(df, critical), defaults or {})
    return reject_incomplete(df) if reject else df


def add_gap_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Typed null columns for the fields the source is known not to have."""
    absent = {n: F.lit(None).cast(spark_type(spec.fields[n].type)) for n in spec.gap_fields if n not in df.columns}
    return df.withColumns(absent) if absent else df


def gap_log(df: DataFrame, spec: TableSpec, entity: str, at: Column) -> DataFrame:
    """One log row per gap field of the table, with the number of records it affects."""
    fields = [n for n in spec.gap_fields if n not in df.columns]
    total = df.agg(F.count(F.lit(1)).alias("record_count"))
    names = F.array(*[F.lit(n) for n in fields]) if fields else F.array().cast("array<string>")
    return total.select(F.posexplode(names).alias("_n", "field_name"), "record_count").select(
        F.concat_ws("_", F.lit(entity), "field_name", F.col("_n").cast("string")).alias("gap_id"),
        F.lit(entity).alias("entity_type"),
        F.lit(spec.name).alias("table_name"),
        "field_name",
        "record_count",
        at.alias("timestamp"),
    )


def missing_quantity(df: DataFrame) -> Column:
    """Requested minus picked; what is absent counts as nothing picked, or nothing missing."""
    if "quantity" in df.columns and "quantity_picked" in df.columns:
        return F.col("quantity") - F.coalesce(F.col("quantity_picked"), F.lit(0))
    if "quantity" in df.columns:
        return F.col("quantity")
    return F.lit(0)


def gap_metadata(df: DataFrame, fields: list[str], impact: dict[str, str] = FIELD_IMPACT) -> Column:
    """JSON per row: unavailable fields, those calculated anyway, and the worst impact."""
    present = [f for f in fields if f in df.columns]
    levels = [IMPACT_LEVELS.index(impact[f]) for f in present if f in impact]
    worst = IMPACT_LEVELS[max(levels)] if levels else "low"
    names = F.array(*[F.lit(f) for f in present]) if present else F.array().cast("array<string>")
    filled = (
        F.array_compact(F.array(*[F.when(F.col(f).isNotNull(), F.lit(f)) for f in present]))
        if present
        else F.array().cast("array<string>")
    )
    return F.to_json(
        F.struct(names.alias("unavailable_fields"), filled.alias("calculated_fields"), F.lit(worst).alias("impact"))
    )


_GAP_JSON = "unavailable_fields array<string>, calculated_fields array<string>, impact string"


def gap_report(df: DataFrame, column: str = "_data_gaps") -> DataFrame:
    """Long report (kind, name, records): totals, per field, per impact, overall impact.

    Per row, the metadata is turned into its few report lines, so one grouped
    count produces the whole report.
    """
    parsed = df.select(F.from_json(F.col(column), _GAP_JSON).alias("g"))
    gaps = F.coalesce(F.col("g.unavailable_fields"), F.array().cast("array<string>"))
    done = F.coalesce(F.col("g.calculated_fields"), F.array().cast("array<string>"))

    def line(kind: str, name: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), name.alias("name"))

    lines = F.concat(
        F.array(line("total", F.lit("records"))),
        F.when((F.size(gaps) > 0) | (F.size(done) > 0), F.array(line("total", F.lit("records_with_gaps")))).otherwise(
            F.array().cast("array<struct<kind:string,name:string>>")
        ),
        F.transform(gaps, lambda f: line("unavailable", f)),
        F.transform(done, lambda f: line("calculated", f)),
        F.array(line("impact", F.coalesce(F.col("g.impact"), F.lit("low")))),
    )
    counted = (
        parsed.select(F.explode(lines).alias("l"))
        .groupBy(F.col("l.kind").alias("kind"), F.col("l.name").alias("name"))
        .agg(F.count(F.lit(1)).alias("records"))
    )
    return counted


def overall_impact(report: DataFrame) -> DataFrame:
    """Worst impact level that occurs, or ``none``."""
    rank = F.array_position(F.array(*[F.lit(x) for x in IMPACT_LEVELS]), F.col("name"))
    worst = F.max(F.when(F.col("kind") == "impact", rank))
    label = F.coalesce(F.get(F.array(*[F.lit(x) for x in IMPACT_LEVELS]), (worst - 1).cast("int")), F.lit("none"))
    return report.agg(label.alias("impact_assessment"))


def _neighbours(df: DataFrame, keys: list[str], ts: str, column: str, tie: list[str], both: bool) -> DataFrame:
    """``_prev`` and, if ``both``, ``_next``: the nearest known (value, time) at or before each row, and after it.

    A segmented scan. Rows are sorted into ranges over (key, time, tie) and written once with their range's number, so
    a key with a third of all rows is spread over many ranges, down to the rows of one instant and tie. Windows work
    inside a key's part of a range. Between ranges only edges move: a range shares at most its first and its last key
    with other ranges, so there are at most two edges a range, which are carried along their key and broadcast back.
    The rows are shuffled twice in all, whichever way is filled.
    """
    order = [F.col(f"`{c}`") for c in [*keys, ts, *tie]]
    ranged = materialize(
        df.repartitionByRange(*[c.asc_nulls_first() for c in order]).withColumn("_range", F.spark_partition_id()), "ranged"
    )
    known = F.when(F.col(column).isNotNull(), F.struct(F.col(column).alias("value"), F.col(ts).alias("at")))
    inside = Window.partitionBy("_range", *keys)
    place = [F.col(f"`{c}`") for c in [ts, *tie]]
    so_far = inside.orderBy(*[c.asc_nulls_first() for c in place]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    to_come = inside.orderBy(*[c.desc_nulls_last() for c in place]).rowsBetween(Window.unboundedPreceding, -1)
    near = {"_prev": F.last(known, ignorenulls=True).over(so_far)}
    if both:
        near["_next"] = F.last(known, ignorenulls=True).over(to_come)
    filled = ranged.withColumns(near)

    at = F.when(F.col(column).isNotNull(), F.struct(*place))
    parts = ranged.groupBy("_range", *keys).agg(F.max_by(known, at).alias("_last"), F.min_by(known, at).alias("_first"))
    ends = ranged.groupBy("_range").agg(F.min(F.struct(*keys)).alias("_low"), F.max(F.struct(*keys)).alias("_high"))
    # Parts of keys at the ends of their range: the only ones that another range can continue.
    at_end = (F.struct(*keys) == F.col("_low")) | (F.struct(*keys) == F.col("_high"))
    edges = parts.join(F.broadcast(ends), "_range").filter(at_end).drop("_low", "_high")
    along = Window.partitionBy(*keys)
    before = along.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    after = along.orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(
        F.col("_range").alias("_c_range"), *[F.col(f"`{k}`").alias(f"_c_{k}") for k in keys],
        F.last("_last", ignorenulls=True).over(before).alias("_before"), F.last("_first", ignorenulls=True).over(after).alias("_after"),
    )
    match = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_c_{k}`")) for k in keys], F.col("_range") == F.col("_c_range"))
    joined = filled.join(F.broadcast(carried), match, "left")
    found = [F.coalesce("_prev", "_before").alias("_prev")] + ([F.coalesce("_next", "_after").alias("_next")] if both else [])
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *found)


def forward_fill(df: DataFrame, keys: list[str], ts: str, column: str, tie: list[str] | None = None) -> DataFrame:
    """Fill nulls with the last known value of the key and flag what was filled."""
    spanned = _neighbours(df, keys, ts, column, tie or [], both=False)
    filled = F.coalesce(F.col(column), F.col("_prev.value"))
    return spanned.select(
        *[c for c in df.columns if c != column],
        filled.alias(column),
        (F.col(column).isNull() & filled.isNotNull()).alias(f"_{column}_imputed"),
    )


def interpolate(df: DataFrame, keys: list[str], ts: str, column: str, tie: list[str] | None = None) -> DataFrame:
    """Linear value between the nearest known neighbours in time, to the microsecond; ends stay null."""
    spanned = _neighbours(df, keys, ts, column, tie or [], both=True)
    before, after = F.col("_prev"), F.col("_next")
    width = to_micros(after["at"]) - to_micros(before["at"])
    step = F.try_divide((to_micros(F.col(ts)) - to_micros(before["at"])).cast("double"), width.cast("double"))
    guess = before["value"] + (after["value"] - before["value"]) * F.coalesce(step, F.lit(0.0))
    filled = F.coalesce(F.col(column), guess)
    return spanned.select(
        *[c for c in df.columns if c != column],
        filled.alias(column),
        (F.col(column).isNull() & filled.isNotNull()).alias(f"_{column}_imputed"),
    )


def gap_trends(log: DataFrame, since: Column, by_day: bool = False) -> DataFrame:
    """Affected records and occurrences by entity and field (or by day) since a time."""
    recent = log.filter(F.col("timestamp") >= since)
    dims = [F.col("timestamp").cast("date").alias("day")] if by_day else ["entity_type", "field_name"]
    out = recent.groupBy(*dims).agg(
        F.sum("record_count").alias("affected_records"), F.count(F.lit(1)).alias("occurrences")
    )
    return out.orderBy("day") if by_day else out.orderBy(F.col("affected_records").desc(), "entity_type", "field_name")
