"""Quality rules to flags, issue rows, a gate and a split."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tributary.config import RuleSet, TableSpec
from tributary.functions import ddl, text
from tributary.functions.money import ratio
from tributary.operators.skew import with_group_stats
from tributary.session import materialize

# Issue marks, in the order they are written.
MARKS = {
    "completeness": "COMPLETENESS_FAIL;",
    "validity": "VALIDITY_FAIL;",
    "range": "RANGE_FAIL;",
    "consistency": "CONSISTENCY_FAIL;",
    "format": "FORMAT_FAIL;",
    "expression": "RULE_FAIL;",
    "uniqueness": "UNIQUENESS_FAIL;",
}
# Ranges implied by a column's type or name.
SMALLINT_RANGE = (0, 32767)
INT_RANGE = (0, 2147483647)
NAME_RANGES = [
    (("quantity", "stock"), (0, None)),
    (("price", "amount"), (0, None)),
    (("lat",), (-90, 90)),
    (("lng", "lon"), (-180, 180)),
]


def _ok(condition: Column) -> Column:
    """A rule that cannot be decided holds."""
    return F.coalesce(condition, F.lit(True))


def _unique_name(columns: tuple[str, ...]) -> str:
    return "_repeated_" + "_".join(columns)


def mark_sets(df: DataFrame, rules: RuleSet | None) -> DataFrame:
    """Evaluate the rules over groups of rows: one ``_repeated_…`` flag per set of columns that must be unique.

    Every row of an offending group is marked, the first one too. Keys with a null part are not compared, as in SQL;
    whether they may be null is for the completeness rules. Hot keys are found while the rows are staged, and their
    rows are not shuffled. Sets with columns that do not exist are left out.
    """
    for columns in rules.unique if rules else ():
        if columns and set(columns) <= set(df.columns):
            whole = reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in columns])
            counted = with_group_stats(df, list(columns), _copies=F.count(F.lit(1)))
            df = counted.withColumn(_unique_name(columns), whole & (F.col("_copies") > 1)).drop("_copies")
    return df


def _single_rules(df: DataFrame, rules: RuleSet) -> list[tuple[str, str, str, Column]]:
    """(dimension, column, message, passes) for every rule whose columns exist."""
    have = set(df.columns)
    out: list[tuple[str, str, str, Column]] = []
    for c in rules.critical:
        if c in have:
            out.append(("completeness", c, "is null", F.col(c).isNotNull()))
    for c, allowed in rules.valid_values.items():
        if c in have:
            out.append(("validity", c, "not an allowed value", _ok(F.col(c).isin(list(allowed)))))
    for c, (low, high) in rules.ranges.items():
        if c in have:
            test = F.lit(True)
            if low is not None:
                test = test & (F.col(c) >= low)
            if high is not None:
                test = test & (F.col(c) <= high)
            out.append(("range", c, "out of range", _ok(test)))
    for w in rules.consistency:
        if w.column in have and w.required in have:
            test = _ok(F.col(w.column) != w.value) | F.col(w.required).isNotNull()
            test = F.when(F.col(w.column).isNull(), F.lit(True)).otherwise(test)
            out.append(("consistency", w.required, f"required when {w.column} is {w.value}", test))
    for c, pattern in rules.formats.items():
        if c in have:
            out.append(("format", c, "wrong format", _ok(F.col(c).rlike(pattern))))
    for name, expression in rules.expressions.items():
        out.append(("expression", name, expression, _ok(F.expr(expression))))
    for columns in rules.unique:
        if _unique_name(columns) in have:
            out.append(("uniqueness", ",".join(columns), "is repeated", ~F.col(_unique_name(columns))))
    return out


def check(df: DataFrame, rules: RuleSet | None) -> DataFrame:
    """Add ``_quality_valid`` and ``_quality_issues``; neither is ever null. Rules over groups are marked first."""
    names = df.columns
    df = mark_sets(df, rules)
    single = _single_rules(df, rules) if rules else []
    passes: dict[str, Column] = {}
    for dimension, _, _, ok in single:
        passes[dimension] = passes[dimension] & ok if dimension in passes else ok
    valid = reduce(lambda a, b: a & b, passes.values(), F.lit(True))
    marks = [F.when(~passes[d], F.lit(m)) for d, m in MARKS.items() if d in passes]
    issues = F.concat_ws("", *marks) if marks else F.lit("")
    return df.select(*[F.col(f"`{c}`") for c in names], valid.alias("_quality_valid"), issues.alias("_quality_issues"))


def issue_rows(df: DataFrame, rules: RuleSet, table: str, record_id: str, at: Column) -> DataFrame:
    """One row per failed rule and record; a repeated key gives one for each of its records."""
    df = mark_sets(df, rules)
    failed = [
        F.when(
            ~ok,
            F.struct(
                F.lit(f"{dimension}:{column}").alias("validation_rule"),
                F.lit(f"{column} {message}").alias("error_message"),
            ),
        )
        for dimension, column, message, ok in _single_rules(df, rules)
    ]
    rows = df.select(
        F.col(record_id).cast("string").alias("record_id"), F.explode(F.array_compact(F.array(*failed))).alias("_f")
    )
    return rows.select(
        F.md5(F.concat_ws("|", F.lit(table), "record_id", "_f.validation_rule")).alias("issue_id"),
        F.lit(table).alias("table_name"),
        "record_id",
        "_f.validation_rule",
        "_f.error_message",
        at.alias("timestamp"),
    )


def score(df: DataFrame) -> DataFrame:
    """Rows, valid rows and the valid share."""
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("_quality_valid")).alias("valid")
    ).withColumn("score", ratio(F.col("valid"), F.col("total")))


class GateError(ValueError):
    """Too few valid rows. ``evidence`` is the path of the staged rows, with their issues."""

    def __init__(self, total: int, valid: int, threshold: float, evidence: str | None = None):
        self.total, self.valid, self.threshold, self.evidence = total, valid, threshold, evidence
        share = "no rows" if not total else f"{valid / total:.1%} valid, {threshold:.1%} wanted, {total - valid} of {total} rows failed"
        super().__init__(f"quality gate: {share}" + (f"; rows kept at {evidence}" if evidence else ""))


def audited(checked: DataFrame, threshold: float, path: str) -> DataFrame:
    """Write checked rows to ``path`` and return them if enough are valid; raise ``GateError`` otherwise.

    The shares are observed by the write itself, so the rows are evaluated once and the gate judges exactly those
    that will be published. An empty input does not pass.
    """
    seen = Observation()
    counts = (F.count(F.lit(1)).alias("total"), F.count_if(F.col("_quality_valid")).alias("valid"))
    staged = materialize(checked.observe(seen, *counts), path=path)
    total, valid = seen.get["total"] or 0, seen.get["valid"] or 0
    if not total or valid / total < threshold:
        raise GateError(total, valid, threshold, path)
    return staged


def gate(df: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Return ``df`` when enough rows are valid; raise otherwise. Empty input raises."""
    row = score(df).first()
    if not row["total"] or row["score"] < threshold:
        raise GateError(row["total"], row["valid"], threshold)
    return df


def rules_from_table(spec: TableSpec, base: RuleSet | None = None) -> RuleSet:
    """Rules implied by column types, names, nullability and primary key; explicit rules win."""
    base = base or RuleSet()
    ranges: dict[str, tuple[float | None, float | None]] = {}
    formats: dict[str, str] = {}
    for name, f in spec.fields.items():
        kind, lower = ddl.parse(f.type)[0], name.lower()
        if kind == "SMALLINT":
            ranges[name] = SMALLINT_RANGE
        elif kind in ("INT", "INTEGER"):
            ranges[name] = INT_RANGE
        else:
            for parts, limits in NAME_RANGES:
                if any(p in lower for p in parts):
                    ranges[name] = limits
                    break
        if "email" in lower:
            formats[name] = text.EMAIL_PATTERN
        elif "phone" in lower:
            formats[name] = text.PHONE_PATTERN
    return RuleSet(
        critical=base.critical or tuple(n for n, f in spec.fields.items() if not f.nullable),
        valid_values=base.valid_values or spec.valid_values,
        ranges=base.ranges or ranges,
        consistency=base.consistency,
        formats=base.formats or formats,
        expressions=base.expressions,
        threshold=base.threshold,
        unique=base.unique or ((spec.primary_key,) if spec.primary_key else ()),
    )


def unique_per_client(ident: str, client: str = "client_id") -> tuple[str, ...]:
    """The Silver rule that an id occurs once within its client, for ``RuleSet.unique``."""
    return (client, ident)


# Rules of each layer, as Spark expressions.
SILVER_RULES = {
    "positive_total": "total_amount > 0",
    "created_not_in_future": "date_created <= as_of",
}
GOLD_RULES = {
    "total_adds_up": "abs(total_amount - (items_amount + shipping_amount - discounts_amount)) < 0.005",
    "modified_after_created": "date_modified >= date_created",
    "has_changes": "total_changes >= 1",
}


def anomalies(df: DataFrame, column: str, by: list[str], z: float = 3.0) -> DataFrame:
    """Rows further than ``z`` standard deviations from their group's mean.

    Means and deviations come from one small aggregate joined back, not from a
    window over the group.
    """
    with_stats = with_group_stats(df, by, _mean=F.avg(column), _dev=F.stddev_pop(column))
    distance = F.try_divide(F.col(column) - F.col("_mean"), F.col("_dev"))
    return with_stats.withColumn("z_score", distance).filter(F.abs("z_score") > z).drop("_mean", "_dev")
