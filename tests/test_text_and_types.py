"""Cleaning, normalizing, parsing and inference on small dirty frames."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tributary.functions import clock, ddl, labels, money, parse, text
from tributary.operators import clean, typing


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).first()["r"]


def test_clean_trims_empties_and_repairs(spark, rows):
    df = spark.createDataFrame([("  a ", 1), ("   ", 2), ("x\U0001f600y", 3), (None, 4)], "s string, n int")
    assert rows(clean.clean(df)) == [(None, 2), (None, 4), ("a", 1), ("x?y", 3)]


def test_clean_keeps_column_order_and_types(spark):
    df = spark.createDataFrame([(1, " a ", 2.0)], "n int, s string, d double")
    assert clean.clean(df).schema == df.schema


def test_clean_modes(spark):
    df = spark.createDataFrame([(" NULL ",), ("a\r\nb\x07",)], "s string")
    got = [r.s for r in clean.clean(df, null_tokens=("null",), drop_controls=True).collect()]
    assert got == [None, "a\nb"]


@pytest.mark.parametrize(
    "given,want",
    [("  User@EXAMPLE.com ", "user@example.com"), ("nope", None), ("a@b", None), ("a@b.c", None), (None, None),
     ("\ta.b+c@x-y.pe\n", "a.b+c@x-y.pe"), ("a@b.com trailing", None)],
)
def test_email(spark, given, want):
    assert one(spark, text.valid_email, given) == want


@pytest.mark.parametrize(
    "given,want",
    [("(01) 234-5678", "+51012345678"), ("987654321", "+51987654321"), ("+51 987 654 321", "+51987654321"),
     ("none", None), ("", None), (None, None)],
)
def test_phone(spark, given, want):
    assert one(spark, text.phone_international, given) == want


@pytest.mark.parametrize("given", ["hello world", "o'neil  x2y", "ÉCOLE élan", "a-b_c", ""])
def test_title_case_matches_python(spark, given):
    assert one(spark, text.title_case, given) == given.title()


@pytest.mark.parametrize(
    "given,want",
    [("2021-01-01T12:00:00-05:00", "2021-01-01T17:00:00+00:00"), ("2021-01-01T12:00:00", "2021-01-01T12:00:00+00:00"),
     ("2021-01-01T12:00:00Z", "2021-01-01T12:00:00+00:00"), ("2021-01-01T00:30:00+05:30", "2020-12-31T19:00:00+00:00"),
     ("soon", None), (None, None)],
)
def test_iso_to_utc(spark, given, want):
    assert one(spark, clock.iso_to_utc, given) == want


def test_unknown_rules_are_errors(spark):
    df = spark.createDataFrame([("a",)], "s string")
    with pytest.raises(ValueError):
        clean.normalize(df, {"s": {"type": "nope"}})
    with pytest.raises(ValueError):
        typing.convert(df, {"s": {"type": "nope"}})
    with pytest.raises(ValueError):
        text.change_case(F.lit("a"), "nope")


def test_normalize_skips_absent_and_typed_columns(spark):
    df = spark.createDataFrame([(5, "X@Y.PE")], "created bigint, mail string")
    rules = {"created": {"type": "date"}, "mail": {"type": "email_lower"}, "other": {"type": "trim"}}
    assert clean.normalize(df, rules).first() == (5, "x@y.pe")


@pytest.mark.parametrize(
    "given,want",
    [("2024-02-29", date(2024, 2, 29)), ("31/12/2024", date(2024, 12, 31)), ("12/31/2024", date(2024, 12, 31)),
     ("2024/01/05", date(2024, 1, 5)), ("2023-02-29", None), ("2024-1-5", None), ("2024-01-05 x", None), (None, None)],
)
def test_dates(spark, given, want):
    assert one(spark, parse.date_text, given) == want


@pytest.mark.parametrize(
    "given,want",
    [("2024-01-02 03:04:05", datetime(2024, 1, 2, 3, 4, 5)), ("2024-01-02T03:04:05", datetime(2024, 1, 2, 3, 4, 5)),
     ("13/02/2024 00:00:01", datetime(2024, 2, 13, 0, 0, 1)), ("02/13/2024 00:00:01", datetime(2024, 2, 13, 0, 0, 1)),
     ("2024-01-02", None)],
)
def test_timestamps(spark, given, want):
    text_form = one(spark, lambda c: F.date_format(parse.timestamp_text(c), "yyyy-MM-dd HH:mm:ss"), given)
    assert text_form == (want.strftime("%Y-%m-%d %H:%M:%S") if want else None)


def test_booleans(spark):
    for word in ("true", "1", "YES", "y", "T"):
        assert one(spark, parse.bool_text, word) is True
    for word in ("false", "0", "No", "n", "f"):
        assert one(spark, parse.bool_text, word) is False
    assert one(spark, parse.bool_text, "maybe") is None
    assert [one(spark, parse.flag_01, n, "int") for n in (1, 0, 7, None)] == [True, False, None, None]
    assert [one(spark, parse.flag_nonzero, n, "int") for n in (1, 0, 7, None)] == [True, False, True, None]


def test_epochs(spark):
    shown = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    assert one(spark, lambda c: shown(clock.epoch_to_utc(c)), 1706025600, "bigint") == "2024-01-23 16:00:00"
    assert one(spark, lambda c: shown(clock.epoch_to_utc(c, "auto")), 1706025600123, "bigint") == "2024-01-23 16:00:00"
    assert one(spark, lambda c: shown(clock.epoch_to_local(c)), 1706025600, "bigint") == "2024-01-23 11:00:00"
    assert one(spark, clock.epoch_in_range, 4102444801, "bigint") is False


def test_local_bounds_match_local_days(spark):
    lo, hi = clock.local_bounds("2024-01-23", "2024-01-23")
    days = [one(spark, lambda c: clock.day_key(clock.epoch_to_local(c)), s, "bigint") for s in (lo - 1, lo, hi - 1, hi)]
    assert days == [20240122, 20240123, 20240123, 20240124]


def test_minute_boundaries_count_marks(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:59' a, timestamp_ntz'2024-01-01 00:01:01' b")
    row = df.select(clock.minute_boundaries(F.col("a"), F.col("b")), clock.minute_boundaries(F.col("b"), F.col("a"))).first()
    assert tuple(row) == (1, -1)
    assert one(spark, clock.hours_dot_minutes, 125, "int") == "2.05"


def test_strict_conversions_raise(spark):
    df = spark.createDataFrame([(4102444801, 123456.789)], "e bigint, d double")
    with pytest.raises(Exception, match="epoch out of range"):
        typing.convert(df, {"e": {"type": "bigint_to_timestamp", "params": {"strict": True}}}).collect()
    with pytest.raises(Exception, match="does not fit"):
        typing.convert(df, {"d": {"type": "decimal", "params": {"precision": 5, "scale": 2, "strict": True}}}).collect()


def test_convert_rules(spark):
    df = spark.createDataFrame([(1, 1, -12.046374, "x" * 10, '{"a":1}', "{bad")], "i int, b int, d double, s string, j string, k string")
    out = typing.convert(
        df,
        {
            "i": {"type": "int_to_bigint"}, "b": {"type": "tinyint_to_boolean"}, "d": {"type": "decimal_to_numeric"},
            "s": {"type": "varchar", "params": {"max_length": 4}}, "j": {"type": "json_to_varchar"}, "k": {"type": "json_to_varchar"},
        },
    )
    assert out.first() == (1, True, Decimal("-12.046374000"), "xxxx", '{"a":1}', None)
    assert [f.dataType.simpleString() for f in out.schema][:3] == ["bigint", "boolean", "decimal(12,9)"]


def test_inference(spark):
    df = spark.createDataFrame(
        [("yes", "2024-01-01", "2024-01-01 10:00:00", "1.5", "7", "5000000000", "abc", None, "1", "009")] * 9
        + [("?", "?", "?", "?", "?", "?", "?", None, "0", "12")],
        "b string, d string, t string, dec string, i string, l string, s string, n string, f string, phone string",
    )
    plan = typing.infer_types(df, exclude=("phone",))
    assert plan == {
        "b": "boolean", "d": "date", "t": "timestamp", "dec": "decimal(18,2)", "i": "int", "l": "bigint", "f": "boolean",
    }
    assert typing.infer_types(df, exclude=("phone",), ints_as_bool=False)["f"] == "int"
    typed = typing.apply_types(df, plan)
    assert typed.filter("b is null").count() == 1 and dict(typed.dtypes)["dec"] == "decimal(18,2)"


def test_inference_loses_no_value(spark):
    texts = {
        "millis": "2024-01-01 10:00:00.123", "zone": "2024-01-01T10:00:00Z", "power": "1e3", "word": " yes ",
        "day": " 2024-01-02 ", "wide": "99999999999999999999", "fine": "1.2345", "long": "12345678901234567.25",
        "huge": "9" * 39,
    }
    df = spark.createDataFrame([tuple(texts.values())] * 10, ", ".join(f"{c} string" for c in texts))
    plan = typing.infer_types(df)
    assert plan == {
        "power": "double", "word": "boolean", "day": "date", "wide": "decimal(20,0)", "fine": "decimal(18,4)",
        "long": "decimal(19,2)",
    }
    row = typing.apply_types(df, plan).first()
    assert row.millis == texts["millis"] and row.zone == texts["zone"] and row.huge == texts["huge"]
    assert row.power == 1000.0 and row.word is True and row.day == date(2024, 1, 2)
    assert row.wide == Decimal(texts["wide"]) and row.fine == Decimal("1.2345") and row.long == Decimal(texts["long"])
    assert typing.misfits(df, plan, []).count() == 0


def test_misfits_are_issue_rows(spark):
    df = spark.createDataFrame([(i, "x" if i == 3 else str(i), None) for i in range(20)], "id int, n string, e string")
    plan = typing.infer_types(df)
    assert [tuple(r) for r in typing.misfits(df, plan, ["id"]).collect()] == [(3, "n", "x", "int")]
    assert typing.misfits(df, {}, ["id"]).count() == 0


def test_extract_profile(spark):
    df = spark.createDataFrame(
        [("1", "a", 1700000000, 1, 1), ("2", "nan", 1700000001, 0, 5), ("", "", 1700000002, None, 2)],
        "num string, txt string, date_created bigint, is_gift int, pages int",
    )
    plan = typing.extract_profile_types(df)
    assert plan == {"num": "double", "txt": "string", "date_created": "timestamp", "is_gift": "boolean"}
    out = typing.apply_extract_types(df, plan)
    assert [r.txt for r in out.collect()] == ["a", None, None]
    assert [r.is_gift for r in out.collect()] == [True, False, None]


def test_warehouse_types():
    assert ddl.spark_type("BIGINT") == "bigint" and ddl.spark_type("int") == "int"
    assert ddl.spark_type("DECIMAL(12,9)") == "decimal(12,9)" and ddl.spark_type("NUMERIC") == "decimal(18,2)"
    assert ddl.spark_type("VARCHAR(50)") == "string" and ddl.text_length("VARCHAR(50)") == 50


def test_labels_and_money(spark):
    df = spark.createDataFrame([(90, 100.0, 3), (40, 118.0, 1), (7, 1.0, 2), (None, None, None)], "s int, g double, t int")
    out = df.select(
        labels.code_label(F.col("s")).alias("l"),
        labels.label_in(labels.code_label(F.col("s")), labels.DELIVERED).alias("d"),
        money.net_of_tax(F.col("g"), F.col("t")).alias("n"),
    ).collect()
    assert [tuple(r) for r in out] == [("ENTREGADO", 1, 100.0), ("FACTURADO", 0, 100.0), (None, 0, 1.0 / 1.18), (None, 0, None)]
    groups = spark.createDataFrame([("ANULADO",), (None,), ("ENTREGADO",)], "g string")
    assert [r[0] for r in groups.select(labels.grouped_status(F.col("g"))).collect()] == [
        "ANULADO Y DEVOLUCIONES", "POR IDENTIFICAR", "ENTREGADO",
    ]


def test_ratio_of_zero_is_null(spark):
    assert spark.range(1).select(money.ratio(F.lit(1), F.lit(0))).first()[0] is None


@pytest.mark.parametrize(
    "as_of, months, want",
    [
        (date(2025, 7, 15), 3, (date(2025, 4, 1), date(2025, 7, 1))),
        (date(2025, 2, 1), 3, (date(2024, 11, 1), date(2025, 2, 1))),
        (date(2024, 1, 31), 1, (date(2023, 12, 1), date(2024, 1, 1))),
        (date(2024, 12, 31), 12, (date(2023, 12, 1), date(2024, 12, 1))),
    ],
)
def test_closed_months(as_of, months, want):
    assert clock.closed_months(as_of, months) == want


def test_profile_counts_rows_not_distinct_values(spark):
    rows = [("1.5", None)] * 94 + [("9" * 50, None), ("a", None), ("1 " * 50, None), ("1" * 50 + "x", None), ("d", None), (None, None)]
    got = {r.column: r for r in typing.inference_profile(spark.createDataFrame(rows, "v string, empty string")).collect()}
    assert got["v"].filled == 99 and got["v"].number == 95 / 99 and got["v"].whole_digits == 50 and got["empty"].filled == 0 and got["empty"].number is None
