"""Aggregation, quality, lineage, tables, validation and reports on small frames."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tributary.config import AggSpec, ColumnSpec, GoldSpec, Metric, RuleSet, SilverSpec, TableSpec, When
from tributary.operators import aggregate, errors, incremental, joins, lineage, quality, tables, validate
from tributary.plans import layers
from tributary.plans.reports import kpi, operations, picking, promotions, sales, wholesale

AT = lambda: F.lit("2026-01-01").cast("timestamp")


@pytest.fixture()
def sold(spark):
    """Ten sales in three branches."""
    data = [
        ("Centro", "completado", 2500.80), ("Norte", "completado", 850.50), ("Centro", "pendiente", 350.0),
        ("Sur", "completado", 3200.0), ("Norte", "cancelado", 450.0), ("Centro", "completado", 280.0),
        ("Sur", "completado", 5600.0), ("Norte", "pendiente", 1200.0), ("Centro", "completado", 12500.99),
        ("Sur", "rechazado", 890.0),
    ]
    return spark.createDataFrame(
        [(str(n), *r, datetime(2026, 2, 15 + n // 3, 10, 0)) for n, r in enumerate(data)],
        "id string, branch string, state string, monto double, sold timestamp",
    )


GOLDEN = {
    ("Centro", "completado"): (15281.79, 5093.93, 280.0, 12500.99, 3),
    ("Centro", "pendiente"): (350.0, 350.0, 350.0, 350.0, 1),
    ("Norte", "cancelado"): (450.0, 450.0, 450.0, 450.0, 1),
    ("Norte", "completado"): (850.5, 850.5, 850.5, 850.5, 1),
    ("Norte", "pendiente"): (1200.0, 1200.0, 1200.0, 1200.0, 1),
    ("Sur", "completado"): (8800.0, 4400.0, 3200.0, 5600.0, 2),
    ("Sur", "rechazado"): (890.0, 890.0, 890.0, 890.0, 1),
}
SALES_AGG = AggSpec(("branch", "state"), (Metric("monto", ("sum", "avg", "min", "max")), Metric("*", ("count",))), "sold")
SALES_RULES = RuleSet(
    critical=("state", "branch"),
    valid_values={"state": ("completado", "pendiente", "cancelado", "rechazado")},
    ranges={"monto": (0, 99999999)},
    consistency=(When("state", "completado", "monto"),),
)


def test_branch_and_state_golden(sold):
    spec = GoldSpec("sales", timestamp_column="sold", aggregate=SALES_AGG, rules=SALES_RULES)
    out = layers.to_gold(sold, spec, AT()).rows
    got = {(r.branch, r.state): r for r in out.collect()}
    assert set(got) == set(GOLDEN)
    for key, want in GOLDEN.items():
        r = got[key]
        values = (r.total_monto, r.promedio_monto, r.min_monto, r.max_monto, r.num_registros)
        assert values == pytest.approx(want)
        assert (r._quality_valid, r._quality_issues, r._error_handled) == (True, "", False)


def test_incremental_run(sold):
    spec = GoldSpec("sales", timestamp_column="sold")
    assert layers.to_gold(sold, spec, AT()).rows.count() == 10
    assert layers.to_gold(sold, spec, AT(), datetime(2026, 2, 16, 10, 0)).rows.count() == 4
    newest = incremental.next_watermark(sold, ["sold"])
    assert newest.first().watermark == datetime(2026, 2, 18, 10, 0)
    state = sold.sparkSession.createDataFrame([("sales", datetime(2027, 1, 1))], "entity string, watermark timestamp")
    assert incremental.advance(state, "sales", newest).first().watermark == datetime(2027, 1, 1)


def test_aggregate_passes_through(sold):
    assert aggregate.aggregate(sold, AggSpec((), ())).columns == sold.columns
    assert aggregate.aggregate(sold, AggSpec(("branch",), (Metric("nope", ("sum",)),))).columns == sold.columns
    assert "week" in aggregate.time_dims(sold, "sold").columns


def test_quality_flags_never_null(spark):
    df = spark.createDataFrame([(None, None, 1.0, "x@y.pe"), ("a", 5, -1.0, "bad"), ("c", None, None, None)], "state string, v int, amount double, email string")
    rules = RuleSet(
        critical=("state",), valid_values={"state": ("a", "c")}, ranges={"amount": (0, None)},
        consistency=(When("state", "c", "v"),), formats={"email": r"^\S+@\S+\.\S+$"},
    )
    out = quality.check(df, rules).collect()
    assert [r._quality_issues for r in out] == ["COMPLETENESS_FAIL;", "RANGE_FAIL;FORMAT_FAIL;", "CONSISTENCY_FAIL;"]
    assert not any(r._quality_valid for r in out)
    assert quality.check(df, None).filter("_quality_valid and _quality_issues = ''").count() == 3


def test_gate(spark):
    df = spark.createDataFrame([(True,), (True,), (False,)], "_quality_valid boolean")
    assert quality.gate(df, 0.6).count() == 3
    with pytest.raises(ValueError, match="1 of 3"):
        quality.gate(df, 0.8)
    with pytest.raises(ValueError, match="no rows"):
        quality.gate(df.limit(0), 0.8)


def test_rules_from_table():
    spec = TableSpec(
        "t",
        {
            "id": ColumnSpec("BIGINT", nullable=False, primary_key=True), "n": ColumnSpec("INT"), "k": ColumnSpec("SMALLINT"),
            "unit_price": ColumnSpec("DECIMAL(12,2)"), "lat": ColumnSpec("DECIMAL(12,9)"), "lng": ColumnSpec("DECIMAL(12,9)"),
            "email": ColumnSpec("VARCHAR(99)"), "phone": ColumnSpec("VARCHAR(20)"), "stock": ColumnSpec("BIGINT"),
        },
    )
    rules = quality.rules_from_table(spec)
    assert rules.critical == ("id",) and spec.primary_key == ("id",)
    assert rules.ranges == {
        "n": (0, 2147483647), "k": (0, 32767), "unit_price": (0, None), "lat": (-90, 90), "lng": (-180, 180), "stock": (0, None),
    }
    assert set(rules.formats) == {"email", "phone"}


def test_unknown_validity_is_never_lost(spark):
    df = spark.createDataFrame([(1, True, ""), (2, False, "X;"), (3, None, "Y;")], "id int, _quality_valid boolean, _quality_issues string")
    assert errors.good(df).count() + errors.bad(df).count() == 3
    letters = errors.dead_letters(df, AT())
    assert sorted(r._dlq_reason for r in letters.collect()) == ["X;", "Y;"]
    assert errors.split_bad(df, "exclude").count() == 1
    assert errors.split_bad(df, "flag").filter("_error_handled").count() == 2
    assert errors.split_bad(df.select("id")).filter("not _error_handled").count() == 3
    with pytest.raises(ValueError):
        errors.split_bad(df, "nope")


def test_row_hash_skips_underscored_columns(spark):
    import hashlib

    df = spark.createDataFrame([(1, None, "z", "meta")], "a int, b string, c string, _x string")
    assert df.select(lineage.row_hash(df)).first()[0] == hashlib.md5(b"1|z").hexdigest()
    assert df.select(lineage.row_hash(df, "~")).first()[0] == hashlib.md5(b"1|~|z").hexdigest()


def test_stage_meter_counts_without_extra_jobs(spark, tmp_path):
    meter = lineage.StageMeter("p")
    df = meter.watch(spark.range(10).toDF("id"), "read")
    df = meter.watch(df.filter("id < 4"), "filter")
    df.write.parquet(str(tmp_path / "out"))
    report = {r.stage: r for r in meter.report(spark, AT()).collect()}
    assert (report["filter"].records_in, report["filter"].records_out, report["filter"].drop_rate) == (10, 4, 0.6)


def test_enrich_overwrites_only_matches(spark, rows):
    df = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    look = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (3, "c", 1)], "k int, v string, n int")
    assert rows(joins.enrich(df, look, ["k"], ["v"], [F.col("n").asc()])) == [(1, "a"), (2, "old")]


def test_range_join_against_brute_force(spark):
    import random

    rnd = random.Random(5)
    pts = [(n, rnd.choice("ab"), rnd.randint(0, 5000)) for n in range(300)]
    rgs = [(n, rnd.choice("ab"), lo, lo + rnd.randint(-5, 900)) for n, lo in enumerate(rnd.randint(0, 5000) for _ in range(80))]
    ts = lambda c: F.timestamp_add("SECOND", F.col(c), F.expr("timestamp_ntz'2024-01-01'"))
    left = spark.createDataFrame(pts, "p int, k string, s int").withColumn("t", ts("s"))
    right = spark.createDataFrame(rgs, "r int, k string, a int, b int").withColumns({"lo": ts("a"), "hi": ts("b")})
    want = {(p, r) for p, k, s in pts for r, j, a, b in rgs if k == j and a <= s < b}
    for width in (60, 600, 10000):
        got = joins.range_join(left, right, ["k"], "t", "lo", "hi", width).select("p", "r").collect()
        assert len(got) == len(want) and {tuple(x) for x in got} == want
    outer = joins.range_join(left, right, ["k"], "t", "lo", "hi", 600, how="left")
    assert outer.filter("r is null").count() == len({p for p, _, _ in pts} - {p for p, _ in want})


def test_open_ranges_against_brute_force(spark):
    import random

    rnd = random.Random(7)
    pts = [(n, rnd.choice(["a", "b", None]), rnd.choice([None, rnd.randint(-9000, 9000), rnd.randint(-10**9, 10**9)])) for n in range(400)]
    rgs = []
    for n in range(90):
        lo = rnd.choice([None, rnd.randint(-9000, 9000), rnd.randint(-10**9, 10**9)])
        rgs.append((n, rnd.choice(["a", "b", None]), lo, rnd.choice([None, (lo or 0) + rnd.randint(-5, 10 ** rnd.randint(1, 9))])))
    ts = lambda c: F.timestamp_add("SECOND", F.col(c), F.expr("timestamp_ntz'2024-01-01'"))
    left = spark.createDataFrame(pts, "p int, k string, s int").withColumn("t", ts("s"))
    right = spark.createDataFrame(rgs, "r int, k string, a int, b int").withColumns({"lo": ts("a"), "hi": ts("b")})
    want = sorted(
        (p, r) for p, k, s in pts for r, j, a, b in rgs
        if k is not None and k == j and s is not None and (a is None or a <= s) and (b is None or s < b) and (a is None or b is None or a < b)
    )
    for width in (1, 60, 86400):
        got = joins.range_join_open(left, right, ["k"], "t", "lo", "hi", width).select("p", "r").collect()
        assert sorted(tuple(x) for x in got) == want
    outer = joins.range_join_open(left, right, ["k"], "t", "lo", "hi", 60, how="left")
    assert outer.count() == len(want) + len({p for p, _, _ in pts} - {p for p, _ in want})
    assert joins.range_join_open(left, right.limit(0), ["k"], "t", "lo", "hi", how="left").count() == 400


def test_a_range_costs_few_rows_whatever_its_length(spark):
    levels = joins._levels(60)
    top = (1 << (joins.FAN_BITS * levels)) - 1
    sizes = spark.createDataFrame([(17, top), (0, top - 5), (0, top), (12345, 12345), (777, 10**9 + 3)], "a bigint, b bigint")
    rows = sizes.select("a", "b", joins.cover(F.col("a"), F.col("b"), levels).alias("c")).collect()
    assert [len(r.c) < 64 for r in rows] == [True] * 5 and len(rows[2].c) == 1 and len(rows[3].c) == 1
    for r in rows:
        spans = sorted((n.place << (2 * n.level), (n.place + 1) << (2 * n.level)) for n in r.c)
        assert spans[0][0] == r.a and spans[-1][1] == r.b + 1 and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))


def test_history_reads_as_of_any_moment(spark, rows):
    history = spark.createDataFrame([("a", 1, 10), ("b", 1, 10), ("b", 2, 20), ("c", 3, 20), ("a", 9, 30)], "id string, counter int, at int")
    assert rows(tables.as_of(history, ["id"], "at", 10), "id", "counter") == [("a", 1), ("b", 1)]
    assert rows(tables.as_of(history, ["id"], "at", 25), "id", "counter") == [("a", 1), ("b", 2), ("c", 3)]
    assert rows(tables.as_of(history, ["id"], "at", 5)) == []


def test_range_replace_removes_days_without_rows(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(n, d) for n, d in enumerate([1, 2, 3, 4, 4])], "n int, day int")
    old.write.partitionBy("day").parquet(path)
    new = spark.createDataFrame([(9, 2), (10, 4)], "n int, day int")
    gone = tables.replace_range_path(spark, path, new, ["day"], F.col("day").between(2, 4))
    assert [g.rsplit("/", 1)[1] for g in gone] == ["day=3"] and not (tmp_path / "t" / "day=3").exists()
    assert rows(spark.read.parquet(path)) == [(0, 1), (10, 4), (9, 2)]
    before = rows(spark.read.parquet(path))
    with pytest.raises(ValueError, match="outside the range"):
        tables.replace_range_path(spark, path, new, ["day"], F.col("day") == 2)
    assert rows(spark.read.parquet(path)) == before
    # No rows at all empty the range.
    tables.replace_range_path(spark, path, new.limit(0), ["day"], F.col("day") >= 2)
    assert rows(spark.read.parquet(path)) == [(0, 1)]
    assert tables.replace_range_path(spark, path, new, ["day"]) == []


def test_a_record_that_changes_its_partition_is_not_kept_twice(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "x", "a"), (2, "x", "b"), (3, "x", "b")], "k int, v string, p string").write.partitionBy("p").parquet(path)
    moved = spark.createDataFrame([(1, "y", "b"), (4, "n", "c")], "k int, v string, p string")
    tables.upsert_path(spark, path, moved, ["k"], ["p"], moving=True)
    assert rows(spark.read.parquet(path)) == [(1, "y", "b"), (2, "x", "b"), (3, "x", "b"), (4, "n", "c")]
    assert not (tmp_path / "t" / "p=a").exists()


def test_upsert_path_rewrites_only_touched_partitions(spark, tmp_path, rows):
    import os

    path = str(tmp_path / "p")
    spark.createDataFrame([("a", 1, 1), ("b", 1, 2)], "id string, v int, day int").write.partitionBy("day").parquet(path)
    before = set(os.listdir(f"{path}/day=2"))
    tables.upsert_path(spark, path, spark.createDataFrame([("a", 9, 1), ("n", 9, 3)], "id string, v int, day int"), ["id"], ["day"])
    assert rows(spark.read.parquet(path)) == [("a", 9, 1), ("b", 1, 2), ("n", 9, 3)]
    assert set(os.listdir(f"{path}/day=2")) == before


def test_merge_into_reports_unsupported_tables(spark):
    spark.sql("create or replace temp view not_a_table as select 1 id")
    with pytest.raises(Exception):
        tables.merge_into(spark, "not_a_table", spark.range(1).toDF("id"), ["id"])


def test_replace_and_as_of(spark, rows):
    t = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "day int, v int")
    new = spark.createDataFrame([(2, 21)], t.schema)
    assert rows(tables.replace_range(t, new, "day", 2, 3)) == [(None, 30), (1, 10), (2, 21)]
    assert rows(tables.replace_keys(t, new, ["day"])) == [(None, 30), (1, 10), (2, 21)]
    h = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 4, "z")], "id string, at int, v string")
    assert rows(tables.as_of(h, ["id"], "at", 3), "id", "v") == [("a", "y")]


def test_compaction(spark, tmp_path):
    spark.range(100).repartition(10).write.parquet(str(tmp_path / "small"))
    assert tables.compact(spark, str(tmp_path / "small"), str(tmp_path / "big")) == 1
    assert spark.read.parquet(str(tmp_path / "big")).count() == 100


def test_schema_diff_and_log(spark, rows):
    from tributary.operators.sets import column_catalog

    old = column_catalog(spark.sql("select 1 a, 'x' b"), "t")
    new = column_catalog(spark.sql("select 1L a, 2 c"), "t")
    diff = tables.schema_diff(old, new)
    assert rows(diff, "column_name", "change_type", "old_type", "new_type") == [
        ("a", "TYPE", "int", "bigint"), ("b", "DROP", "string", None), ("c", "ADD", None, "int"),
    ]
    assert tables.schema_change_log(diff, AT()).select("change_id").distinct().count() == 3


def test_validation_and_reconciliation(spark):
    spec = TableSpec("t", {"id": ColumnSpec("INT", nullable=False, primary_key=True), "c": ColumnSpec("INT", calculated=True)})
    good = spark.createDataFrame([(1, 2)], "id int, c int")
    assert validate.overall(validate.validate(good, spec)).first().status == "PASS"
    bad = spark.createDataFrame([(None, None)], "id int, c int")
    assert validate.overall(validate.validate(bad, spec)).first().failures == 2
    assert validate.overall(validate.validate(good.limit(0), spec)).first().status == "FAIL"
    assert validate.quality_score(3, 1, 4) == 0.5
    layers_ = {r.layer: r for r in validate.reconcile({"bronze": spark.range(4), "silver": spark.range(2)}).collect()}
    assert layers_["silver"].kept_share == 0.5 and layers_["bronze"].rows_before is None


def test_silver_pipeline(spark):
    raw = spark.createDataFrame(
        [
            (" 1 ", "1706025600", "  pending  ", (" Me@X.PE ", "(01) 234"), "10.5", "2024-01-01", "1"),
            ("1", "1706025700", "done", ("me@x.pe", "01234"), "11.5", "2024-01-01", "0"),
            ("2", "1706025600", "   ", (None, None), "12", "2024-01-02", "1"),
        ],
        "id string, modified string, status string, customer struct<email:string,phone:string>, amount string, day string, gift string",
    )
    spec = SilverSpec(
        keys=("id",), order_column="modified", normalize={"customer_email": {"type": "email"}, "customer_phone": {"type": "phone"}},
        convert={"modified": {"type": "bigint_to_timestamp"}}, critical=("status",), defaults={"status": "UNKNOWN"},
    )
    meter = lineage.StageMeter("silver")
    out = layers.to_silver(raw, spec, meter)
    got = {r.id: r for r in out.collect()}
    assert set(got) == {"1", "2"} and dict(out.dtypes)["amount"] == "decimal(18,2)" and dict(out.dtypes)["gift"] == "boolean"
    assert (got["1"].status, got["1"].customer_email, got["1"].customer_phone) == ("done", "me@x.pe", "+5101234")
    assert (got["2"].status, got["2"].has_critical_gaps) == ("UNKNOWN", True)
    stages = {r.stage: r.records_out for r in meter.report(spark, AT()).collect()}
    assert stages["types"] == 3 and stages["resolve"] == 2


def test_daily_sales_small(spark):
    lines = spark.createDataFrame([(1, "m1", 11800), (1, "m2", 500), (2, "m1", 100)], "order_id int, material_id string, gross bigint")
    mats = spark.createDataFrame([("m1", 1), ("m2", 3)], "material_id string, tax_type int")
    orders = spark.createDataFrame(
        [(1, "A", "APP", datetime(2024, 7, 1), True, None), (2, "A", "APP", datetime(2024, 7, 1), None, "ANULADO")],
        "order_id int, chain string, channel string, created timestamp, prime boolean, status_group string",
    )
    got = {r.status_group: r for r in sales.daily_sales(lines, orders, mats).collect()}
    assert set(got) == {"POR IDENTIFICAR", "ANULADO Y DEVOLUCIONES"}
    r = got["POR IDENTIFICAR"]
    assert (r.gross, r.net, r.orders, r.prime, r.day, r.month) == (123.0, 105.0, 1, "SI", 20240701, 202407)


def test_kpis_small(spark):
    orders = spark.createDataFrame(
        [(1, 7, 1000, 0, 2, 100, "PRIME"), (2, 7, 3000, 0, 4, 200, "NO PRIME"), (3, 8, 2000, 1180, 2, 0, "PRIME")],
        "order_id int, customer_id int, gross bigint, taxed bigint, units bigint, margin bigint, segment string",
    ).withColumn("created", F.lit("2024-01-01").cast("timestamp"))
    got = {r.segment: r for r in kpi.customer_kpis_with_total(orders, F.lit(1)).collect()}
    assert (got["TOTAL"].customers, got["TOTAL"].orders, got["TOTAL"].gross) == (2, 3, 60.0)
    assert (got["PRIME"].customers, got["PRIME"].net) == (2, pytest.approx(28.2))
    assert got["NO PRIME"].frequency == 1.0 and got["TOTAL"].frequency == 1.5


def test_prime_by_promotion_first(spark):
    df = spark.createDataFrame([(True, False), (None, True), (None, None), (False, True)], "p boolean, o boolean")
    assert [r[0] for r in df.select(kpi.prime_group(F.col("p"), F.col("o"))).collect()] == ["PRIME", "PRIME", "NO PRIME", "NO PRIME"]


def test_allocation_conserves_margins(spark):
    items = spark.createDataFrame(
        [("o1", "m1", 10, 900, 1000), ("o1", "m2", 2, 900, 100), ("o2", "m1", 4, 50, 999), ("o3", "m", 5, 9, -70), ("o4", "none", 1, 1, 5)],
        "order_id string, material_id string, quantity bigint, net bigint, margin bigint",
    )
    lines = spark.createDataFrame(
        [("o1", "m1", "a", 10, -30, 900), ("o1", "m1", "b", 10, -30, 900), ("o1", "m1", "c", 10, -30, 900), ("o1", "m2", "a", 2, 0, 900),
         ("o1", "m2", "b", 2, None, 900), ("o2", "m1", "a", 1, -5, 50), ("o3", "m", "a", 5, -1, 9), ("o3", "m", "b", 5, -2, 9), ("o9", "m", "a", 1, -1, 1)],
        "order_id string, material_id string, promotion string, quantity bigint, discount bigint, net bigint",
    )
    got = promotions.allocate(items, lines).collect()
    by_item = {}
    for r in got:
        by_item.setdefault((r.order_id, r.material_id), []).append(r)
    assert set(by_item) == {("o1", "m1"), ("o1", "m2"), ("o2", "m1"), ("o3", "m")}
    margins = {(r.order_id, r.material_id): r.margin for r in items.collect()}
    for key, mine in by_item.items():
        assert round(sum(r.share for r in mine), 9) == 1.0
        assert sum(r.promo_margin + r.rest_margin for r in mine) == margins[key]
    assert sorted(r.promo_margin for r in by_item["o1", "m1"]) == [333, 333, 334]
    assert [r.share for r in by_item["o1", "m2"]] == [0.5, 0.5]
    # Four were sold, one with the promotion, and 999 is over its net of 50: a quarter stays, the rest is the others'.
    assert [(r.promo_margin, r.rest_margin) for r in by_item["o2", "m1"]] == [(250, 749)]


def test_discount_share_small(spark):
    lines = spark.createDataFrame(
        [("o", "m", "p1", 1.0, -300, 100, 500), ("o", "m", "p2", 1.0, -100, 100, 500), ("o", "n", "p1", 2.0, 0, 100, 10)],
        "order_id string, material_id string, promotion string, quantity double, discount bigint, net bigint, margin bigint",
    )
    got = {(r.material_id, r.promotion): r for r in promotions.discount_share(lines).collect()}
    assert got["m", "p1"].share == 0.75 and got["m", "p1"].promo_margin == pytest.approx(3.75)
    assert got["n", "p1"].share == 1.0 and got["n", "p1"].promo_margin == pytest.approx(0.1)


def test_split_delivery_keeps_nameless_lines(spark):
    df = spark.createDataFrame([("Free DELIVERY",), ("x",), (None,)], "promotion string")
    a, b = promotions.split_delivery(df)
    assert (a.count(), b.count()) == (1, 2)


def test_bulk_buyers_small(spark):
    row = lambda c, u, m, area: (c, "m", "A", 1, u, 100, m, area)
    df = spark.createDataFrame(
        [row(1, 12, -5, "FOOD"), row(2, 11, -5, "FOOD"), row(3, 12, 5, "FOOD"), row(4, 3, -1, "ELECTRO"), row(5, 90, -1, "OTHER")],
        "customer_id int, material_id string, chain string, order_id int, units int, net int, margin int, area string",
    )
    assert sorted(r.customer_id for r in wholesale.bulk_buyers(df).collect()) == [1, 4]


def test_stockouts_tolerance(spark):
    df = spark.createDataFrame(
        [
            (1, "m", "H1", 100, "NO", "KG", 10.0, 9.5), (2, "m", "S1", 100, "NO", "KG", 10.0, 9.0), (3, "m", "X1", 100, "NO", "UN", 10.0, 12.0),
            (4, "m", "T1", 100, "NO", "UN", 10.0, 4.0), (5, "m", "W1", 100, "SI", "UN", 10.0, 0.0), (6, "m", "S1", 100, "NO", "UN", 3.0, None),
        ],
        "order_id int, material_id string, store string, price bigint, substitute string, unit string, requested double, picked double",
    )
    mats = spark.createDataFrame([("m", 0)], "material_id string, tax_type int")
    got = {r.order_id: (r.missing, r.gross, r.format) for r in picking.stockouts(df, mats).collect()}
    assert got == {2: (10.0, 10.0, "Super"), 4: (6.0, 6.0, "Super"), 6: (3.0, 3.0, "Super")}


def test_window_states(spark):
    df = spark.sql(
        "select * from values (null, timestamp_ntz'2024-01-01 10:00:00'), "
        "(timestamp_ntz'2024-01-01 09:58:59', timestamp_ntz'2024-01-01 10:00:00'), "
        "(timestamp_ntz'2024-01-01 09:59:00', timestamp_ntz'2024-01-01 10:00:00') t(b, p)"
    )
    got = [r[0] for r in df.select(operations.window_state(F.col("b"), F.col("p"))).collect()]
    assert got == ["Abierta", "Cierre Capacidad", "Cierre Programado"]


def test_ops_flags_pickup(spark):
    orders = spark.sql(
        "select 1 order_id, 'S1' store, 90 status, timestamp_ntz'2024-01-01 10:00:00' window_start, timestamp_ntz'2024-01-01 09:29:59' delivered "
        "union all select 2, 'S2', 10, timestamp_ntz'2024-01-01 10:00:00', null"
    )
    providers = spark.createDataFrame([("S1", "fast")], "store string, provider string")
    got = {r.order_id: r for r in operations.ops_flags(orders, providers, "own", pickup=True).collect()}
    assert (got[1].provider, got[1].minutes_from_window, got[1].early_over_30, got[1].collected) == ("fast", -31, 1, 1)
    assert (got[2].provider, got[2].minutes_from_window, got[2].picked, got[2].collected) == ("own", None, 0, 0)


def test_compact_keeps_partitions(spark, tmp_path, rows):
    source, target = (str(tmp_path / n) for n in ("many", "few"))
    df = spark.range(100).select(F.col("id"), (F.col("id") % 3).alias("day"))
    df.repartition(8).write.partitionBy("day").parquet(source)
    tables.compact(spark, source, target, by=["day"])
    assert sorted(p.name for p in (tmp_path / "few").glob("day=*")) == ["day=0", "day=1", "day=2"]
    assert rows(spark.read.parquet(target).select("id", "day")) == rows(df)


def test_small_files_are_packed_and_large_ones_left(spark, rows):
    files = [("d1", f"f{n}", 30) for n in range(5)] + [("d1", "big", 64), ("d2", "alone", 10), (None, "n1", 1), (None, "n2", 63)]
    df = spark.createDataFrame(files, "day string, file string, bytes bigint")
    plan = tables.compaction_plan(df, ["day"], 128, 64)
    bins = {}
    for r in plan.collect():
        bins.setdefault(r.bin, set()).add(r.file)
    sizes = {f: b for _, f, b in files}
    assert sorted(len(b) for b in bins.values()) == [2, 2, 3]
    assert all(sum(sizes[f] for f in b) <= 128 for b in bins.values())
    assert not any({"big", "alone"} & b for b in bins.values()) and {"n1", "n2"} in bins.values()
    assert tables.compaction_plan(df.limit(0), ["day"]).count() == 0
