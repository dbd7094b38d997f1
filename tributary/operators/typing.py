"""Type conversion: by rule, or inferred from the data in one aggregate pass.

``type_plan`` keeps inferred types from run to run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions import clock, parse, text

MAX_INT = 2147483647
#: Characters of the longest value that can be a flag, a date or a time, and some more; numbers may be longer.
LONGEST = 40

# Name parts that mark a 0/1 column as a flag in extract mode.
FLAG_WORDS = (
    "is_", "has_", "can_", "should_", "enabled", "disabled",
    "active", "validated", "pending", "gift", "infinite", "tracking",
)
EXTRACT_NULLS = ("", "None", "nan", "NaN")


def text_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def inference_profile(df: DataFrame, exclude: tuple[str, ...] = (), ints_as_bool: bool = True) -> DataFrame:
    """One row per string column with the share of its values that each type accepts.

    Columns become rows inside the scan's own task, so one grouped aggregate
    with one set of tests serves any number of columns, and each task shuffles
    a value of a column once.
    """
    names = text_columns(df, exclude)
    if not names:
        return profile_values(df.sparkSession.createDataFrame([], "column string, value string"), ints_as_bool)
    return profile_values(df.select(*[F.col(f"`{n}`") for n in names]).unpivot([], names, "column", "value"), ints_as_bool)


def profile_values(tall: DataFrame, ints_as_bool: bool = True) -> DataFrame:
    """The profile of (column, value) rows.

    Equal values are counted first, so that each is tested once: flags, dates and amounts repeat by the thousand. Long
    values that are no numbers fit no type and count as one value, so whole texts are not shuffled. The shape of a
    value, its digits made 0, says which formats it can have; only those are tried.
    """
    words = [w for w in parse.TRUE_WORDS + parse.FALSE_WORDS if ints_as_bool or w not in ("0", "1")]
    shapes = {
        "date": [parse.fixed_width(f)[0] for f in parse.DATE_FORMATS],
        "timestamp": [parse.fixed_width(f)[0] for f in parse.TIMESTAMP_FORMATS],
    }
    trimmed = tall.select("column", F.trim("value").alias("text"))
    plain = (F.length("text") > LONGEST) & ~F.col("text").rlike(parse.NUMBER_SHAPE)
    short = trimmed.select("column", F.when(plain, F.lit("text")).otherwise(F.col("text")).alias("text"))
    each = short.groupBy("column", "text").agg(F.count(F.lit(1)).alias("rows"))
    shaped = each.select("*", parse.shape_of(F.col("text")).alias("shape"))
    numeric = F.substring("shape", 1, 1).isin("0", "+", "-", ".") & F.col("text").rlike(parse.NUMBER_SHAPE)
    tested = shaped.select(
        "column",
        "rows",
        "text",
        ((F.length("text") <= 5) & F.lower("text").isin(words)).alias("boolean"),
        *[(F.col("shape").isin(fits) & _to_inferred(F.col("text"), t).isNotNull()).alias(t) for t, fits in shapes.items()],
        numeric.alias("is_number"),
    )
    # Where the parts of a number are, without another expression: sign, whole digits, fraction, exponent.
    number = F.when(F.col("is_number"), F.lower("text"))
    parts = tested.select("column", "text", "rows", "boolean", "date", "timestamp", "is_number", number.alias("n")).select(
        "*", F.instr("n", "e").alias("e"), F.instr("n", ".").alias("dot"), F.substring("n", 1, 1).isin("+", "-").cast("int").alias("sign")
    )
    mantissa_end = F.when(F.col("e") > 0, F.col("e") - 1).otherwise(F.length("n"))
    digits = parts.select(
        "*",
        (F.when(F.col("dot") > 0, F.col("dot") - 1).otherwise(mantissa_end) - F.col("sign")).alias("whole"),
        F.when(F.col("dot") > 0, mantissa_end - F.col("dot")).otherwise(0).alias("behind"),
        F.when(F.col("e") > 0, F.col("n").substr(F.col("e") + 1, F.lit(12)).try_cast("int")).otherwise(F.lit(0)).alias("power"),
    )

    filled = F.sum(F.when(F.col("text").isNotNull(), F.col("rows")))

    def share(test: Column) -> Column:
        fit = F.when(F.coalesce(test, F.lit(False)), F.col("rows")).otherwise(F.lit(0))
        return F.sum(F.when(F.col("text").isNotNull(), fit)) / filled

    is_number = F.coalesce(F.col("is_number"), F.lit(False))
    has_power = is_number & (F.col("e") > 0)
    # An exponent that is no 32-bit number makes the value too wide for anything but text.
    whole = F.greatest(F.col("whole") + F.coalesce("power", F.lit(1000)), F.lit(1))
    behind = F.greatest(F.col("behind") - F.coalesce("power", F.lit(0)), F.lit(0))
    leading = is_number & (F.col("whole") > 1) & (F.col("n").substr(F.col("sign") + 1, F.lit(1)) == "0")
    return digits.groupBy("column").agg(
        F.coalesce(filled, F.lit(0)).alias("filled"),
        *[share(F.col(t)).alias(t) for t in ("boolean", "date", "timestamp")],
        share(F.col("is_number")).alias("number"),
        F.bool_or(is_number & (F.col("dot") > 0)).alias("any_decimal"),
        F.bool_or(has_power).alias("any_exponent"),
        F.bool_or(is_number & (F.col("e") == 0)).alias("any_plain"),
        F.bool_or(leading).alias("any_leading_zero"),
        F.bool_or(is_number & ~F.coalesce(F.col("boolean"), F.lit(False))).alias("any_other_number"),
        F.max(F.abs(F.when(is_number, F.col("n").try_cast("double")))).alias("max_abs"),
        F.max(F.when(is_number, whole)).alias("whole_digits"),
        F.max(F.when(is_number, behind)).alias("scale"),
        F.max(F.when(is_number, F.col("whole") + F.col("behind"))).alias("significant"),
    )


#: Digits that every double holds.
DOUBLE_DIGITS = 15
MAX_DIGITS = 38


def decided_type(threshold: float = 0.9) -> Column:
    """Boolean, then date, then timestamp, then number; else text.

    A number type holds every digit that was seen. Wide or finely divided values widen the decimal, an exponent beside
    plain numbers counts as the digits it stands for, exponents alone make a double if it holds their digits, and what
    no number type holds stays text. A zero before other digits is part of a name, not of a number, so such a
    column is text. Words that are also numbers make a boolean only if no other number was seen.
    """
    scale = F.when(F.col("any_decimal") | (F.col("scale") > 0), F.greatest(F.col("scale"), F.lit(2))).otherwise(F.lit(0))
    digits = F.greatest(F.col("whole_digits") + scale, F.lit(18))
    fits_double = (F.col("significant") <= DOUBLE_DIGITS) & (F.col("whole_digits") < 300) & (F.col("scale") < 300)
    wide = F.when(F.col("any_exponent") & fits_double, F.lit("double")).otherwise(F.lit("string"))
    exact = F.when(digits > MAX_DIGITS, wide).otherwise(F.format_string("decimal(%d,%d)", digits, scale))
    number = (
        F.when(F.col("any_leading_zero"), F.lit("string"))
        .when(F.col("any_exponent") & ~F.col("any_plain"), wide)
        .when(F.col("any_exponent") | F.col("any_decimal") | (F.col("whole_digits") > 18), exact)
        .when(F.col("max_abs") > MAX_INT, F.lit("bigint"))
        .otherwise(F.lit("int"))
    )
    return (
        F.when(F.col("filled") == 0, F.lit("string"))
        .when((F.col("boolean") >= threshold) & ~F.col("any_other_number"), F.lit("boolean"))
        .when(F.col("date") >= threshold, F.lit("date"))
        .when(F.col("timestamp") >= threshold, F.lit("timestamp"))
        .when(F.col("number") >= threshold, number)
        .otherwise(F.lit("string"))
    )


def infer_types(
    df: DataFrame, threshold: float = 0.9, exclude: tuple[str, ...] = (), ints_as_bool: bool = True
) -> dict[str, str]:
    """Column to target type. Runs one aggregate; the result has one row per column.

    At the default threshold up to a tenth of a column may not fit its type; take ``misfits`` along, or infer at 1.0.
    """
    profile = inference_profile(df, exclude, ints_as_bool)
    rows = profile.select("column", decided_type(threshold).alias("type")).collect()
    return {r["column"]: r["type"] for r in rows if r["type"] != "string"}


def _to_inferred(c: Column, target: str) -> Column:
    """Decides and converts: a value fits a type exactly if this is not null. Blanks around it do not matter."""
    value = F.trim(c)
    if target == "boolean":
        return parse.bool_text(value)
    if target == "date":
        return parse.date_text(value)
    if target == "timestamp":
        return parse.timestamp_text(value)
    if target == "string":
        return c
    return F.when(value.rlike(parse.NUMBER_SHAPE), value.try_cast(target))


def apply_types(df: DataFrame, plan: dict[str, str]) -> DataFrame:
    """Convert the planned text columns.

    Dates and times take two steps, shapes first, so that the conversion names a column instead of repeating the
    expression that makes it: methods that long are not compiled by the JVM.
    """
    planned = {c: plan[c] for c in text_columns(df) if c in plan}
    timed = [c for c, t in planned.items() if t in ("date", "timestamp")]
    readers = {"date": parse.date_text, "timestamp": parse.timestamp_text}
    trimmed = df.withColumns({f"_text_{c}": F.trim(f"`{c}`") for c in timed}) if timed else df
    shaped = trimmed.withColumns({f"_shape_{c}": parse.shape_of(F.col(f"`_text_{c}`")) for c in timed}) if timed else df
    return shaped.select(
        *[
            readers[planned[c]](F.col(f"`_text_{c}`"), shape=F.col(f"`_shape_{c}`")).alias(c)
            if c in timed
            else _to_inferred(F.col(f"`{c}`"), planned[c]).alias(c)
            if c in planned
            else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def misfits(df: DataFrame, plan: dict[str, str], keys: list[str]) -> DataFrame:
    """Issue rows (keys, column, value, type): the values that ``apply_types`` turns into nulls, with their texts."""
    planned = [f.name for f in df.schema.fields if f.name in plan and isinstance(f.dataType, T.StringType)]
    found = [
        F.when(
            F.col(f"`{n}`").isNotNull() & _to_inferred(F.col(f"`{n}`"), plan[n]).isNull(),
            F.struct(F.lit(n).alias("column"), F.col(f"`{n}`").alias("value"), F.lit(plan[n]).alias("type")),
        )
        for n in planned
    ]
    entry = "struct<column:string,value:string,type:string>"
    issues = F.array_compact(F.array(*found)) if found else F.array().cast(f"array<{entry}>")
    return df.select(*[F.col(f"`{k}`") for k in keys], F.explode(issues).alias("_issue")).select(
        *[F.col(f"`{k}`") for k in keys], "_issue.column", "_issue.value", "_issue.type"
    )


def _epoch(c: Column, unit: str = "s", strict: bool = False) -> Column:
    seconds = clock.epoch_seconds(c, unit)
    value = clock.epoch_to_utc(c, unit)
    if not strict:
        return value
    problem = F.concat(F.lit("epoch out of range: "), seconds.cast("string"))
    return F.when(clock.epoch_in_range(seconds), value).otherwise(F.raise_error(problem))


def _decimal(c: Column, precision: int = 15, scale: int = 5, strict: bool = False) -> Column:
    value = parse.decimal_of(c, precision, scale)
    if not strict:
        return value
    problem = F.concat(F.lit(f"does not fit decimal({precision},{scale}): "), c.cast("string"))
    return F.when(parse.decimal_overflows(c, precision, scale), F.raise_error(problem)).otherwise(value)


CONVERSIONS = {
    "bigint_to_timestamp": _epoch,
    "unix_timestamp_to_iso8601": _epoch,
    "tinyint_to_boolean": lambda c, nonzero=False: parse.flag_nonzero(c) if nonzero else parse.flag_01(c),
    "decimal": _decimal,
    "decimal_to_numeric": lambda c, precision=12, scale=9: parse.decimal_of(c, precision, scale),
    "int_to_bigint": lambda c: c.cast("bigint"),
    "number_to_string": lambda c: c.cast("string"),
    "varchar": lambda c, max_length=text.MAX_VARCHAR: text.truncate(c, max_length),
    "text_to_varchar": lambda c: text.truncate(c),
    "json_to_varchar": lambda c: text.valid_json(c),
    "datetime_to_timestamp": lambda c: F.date_format(c.try_cast("timestamp"), "yyyy-MM-dd HH:mm:ss"),
    "bool_text": parse.bool_text,
    "date_text": parse.date_text,
    "timestamp_text": parse.timestamp_text,
}


def convert(df: DataFrame, rules: dict[str, dict]) -> DataFrame:
    """Apply ``{column: {"type": ..., "params": {...}}}``; unknown types are errors."""
    for rule in rules.values():
        if rule["type"] not in CONVERSIONS:
            raise ValueError(f"unknown conversion: {rule['type']}")
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        rule = rules.get(f.name)
        if rule:
            if rule["type"] == "json_to_varchar" and isinstance(
                f.dataType, (T.StructType, T.ArrayType, T.MapType)
            ):
                c = text.truncate(F.to_json(c))
            else:
                c = CONVERSIONS[rule["type"]](c, **rule.get("params", {}))
        out.append(c.alias(f.name))
    return df.select(*out)


def extract_profile_types(df: DataFrame, threshold: float = 0.95) -> dict[str, str]:
    """Second rule set, used when rows come straight from a database.

    Text that is over 95 % numeric becomes a number, ``date_`` integers above
    1e9 become timestamps, 0/1 integers with a flag-like name become booleans.
    One aggregate over all rows decides.
    """
    probes: list[Column] = []
    plan: dict[str, str] = {}
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            usable = c.isNotNull() & ~c.isin(list(EXTRACT_NULLS))
            probes.append(
                (F.avg(F.when(usable, parse.number_text(c).isNotNull().cast("int"))) > threshold).alias(f.name)
            )
        elif isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType)):
            if "date_" in f.name.lower():
                probes.append((F.min(c) > 1_000_000_000).alias(f.name))
            elif any(w in f.name.lower() for w in FLAG_WORDS):
                probes.append(((F.min(c) >= 0) & (F.max(c) <= 1)).alias(f.name))
    if not probes:
        return plan
    row = df.agg(*probes).first()
    for f in df.schema.fields:
        if f.name not in row.asDict():
            continue
        hit = bool(row[f.name])
        if isinstance(f.dataType, T.StringType):
            plan[f.name] = "double" if hit else "string"
        elif hit:
            plan[f.name] = "timestamp" if "date_" in f.name.lower() else "boolean"
    return plan


def apply_extract_types(df: DataFrame, plan: dict[str, str]) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        target = plan.get(f.name)
        if target == "string":
            c = F.when(c.isin(list(EXTRACT_NULLS)), F.lit(None)).otherwise(c)
        elif target == "double":
            c = parse.number_text(c)
        elif target == "timestamp":
            c = clock.epoch_to_utc(c)
        elif target == "boolean":
            c = parse.flag_01(c)
        out.append(c.alias(f.name))
    return df.select(*out)
