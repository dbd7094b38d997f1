"""Totals over runs, write-audit-publish and rules over groups."""

import re

import pytest
from pyspark.sql import functions as F

from tributary.config import AggSpec, ColumnSpec, FieldMap, GoldSpec, Metric, RuleSet, SilverSpec, TableSpec
from tributary.operators import aggregate, lineage, partials, quality, type_plan, typing
from tributary.plans import layers
from tributary.plans import queries as _registered  # noqa: F401
from tributary.plans.registry import QUERIES
from tributary.sources import readers

SPEC = AggSpec(
    ("k",), (Metric("v", ("sum", "avg", "min", "max")), Metric("who", ("count_distinct",)), Metric("day", ("count_distinct",)), Metric("*", ("count",)))
)
AT = lambda: F.lit("2026-01-01").cast("timestamp_ntz")


@pytest.fixture(scope="module")
def sales(spark):
    rows = [(i % 5 if i % 11 else None, i if i % 7 else None, f"w{i % 13}" if i % 17 else None, i % 3) for i in range(400)]
    return spark.createDataFrame(rows, "k int, v bigint, who string, day int").withColumn("n", F.monotonically_increasing_id()).cache()


def test_runs_add_up_to_one(spark, sales, rows, tmp_path):
    path, names = str(tmp_path / "t"), aggregate.aggregate(sales, SPEC).columns
    want = rows(aggregate.aggregate(sales, SPEC))
    cut = sales.select(F.expr("percentile(n, 0.5)")).first()[0]
    parts = {"a": sales.filter(F.col("n") < cut / 2), "b": sales.filter(F.col("n").between(cut / 2, cut)), "c": sales.filter(F.col("n") > cut)}
    for run in ("c", "a", "b", "a"):
        got = partials.update(parts[run], SPEC, path, run)
    assert got.columns == names and rows(got) == want
    # An empty run changes nothing; a repeated run that lost its rows takes them back out.
    assert rows(partials.update(sales.limit(0), SPEC, path, "d")) == want
    less = rows(partials.update(parts["b"].limit(0), SPEC, path, "b"))
    assert less == rows(aggregate.aggregate(parts["a"].unionByName(parts["c"]), SPEC))


def test_keys_are_stored_once(spark, sales, tmp_path):
    path = str(tmp_path / "t")
    for run in ("a", "b"):
        partials.record(sales, SPEC, path, run)
    kept = spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/keys")
    assert kept.filter("_run = 'b'").count() == 0 and kept.count() == kept.drop("_run").distinct().count() > 0
    assert kept.filter("_value IS NULL").count() == 0
    with pytest.raises(ValueError, match="nothing recorded"):
        partials.totals(spark, SPEC, str(tmp_path / "none"))
    with pytest.raises(ValueError, match="dimensions not found"):
        partials.record(sales.drop("k"), SPEC, path, "c")


def spec(threshold, **more):
    return GoldSpec("t", (FieldMap("id", "id"), FieldMap("v", "v")), rules=RuleSet(critical=("v",), threshold=threshold, **more), recovery="exclude")


def test_a_run_that_fails_its_gate_leaves_gold_alone(spark, rows, tmp_path):
    gold, letters, evidence = (str(tmp_path / n) for n in ("gold", "letters", "evidence"))
    good = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    bad = spark.createDataFrame([(3, None), (4, None), (5, "e")], "id int, v string")
    for _ in range(2):
        layers.publish(layers.to_gold(good, spec(0.5), AT()), gold, letters, "r1")
    before = rows(readers.read_parquet(spark, gold))
    assert rows(readers.read_parquet(spark, gold), "id") == [(1,)]
    with pytest.raises(quality.GateError, match="33.3% valid, 50.0% wanted, 2 of 3") as held:
        layers.publish(layers.to_gold(bad, spec(0.5), AT()), gold, letters, "r2", audit=evidence)
    assert (held.value.total, held.value.valid, held.value.evidence) == (3, 1, evidence)
    assert rows(readers.read_parquet(spark, gold)) == before
    kept = readers.read_parquet(spark, evidence)
    assert rows(kept, "id", "_quality_issues") == [(3, "COMPLETENESS_FAIL;"), (4, "COMPLETENESS_FAIL;"), (5, "")]
    # A repeated run keeps one set of letters; a held one writes none.
    back = readers.read_dead_letters(spark, letters, "id int, v string, _dlq_reason string")
    assert rows(back) == [(2, None, "COMPLETENESS_FAIL;", "r1")]
    with pytest.raises(quality.GateError, match="no rows"):
        layers.publish(layers.to_gold(good.limit(0), spec(0.0), AT()), gold, letters, "r3")


def test_publish_replaces_only_filled_partitions(spark, rows, tmp_path):
    gold, letters = str(tmp_path / "gold"), str(tmp_path / "letters")
    for data in ([(1, "a"), (2, "b")], [(3, "b")]):
        df = spark.createDataFrame(data, "id int, v string")
        layers.publish(layers.to_gold(df, spec(0.5), AT()), gold, letters, "r", by=["v"])
    assert rows(readers.read_parquet(spark, gold), "id", "v") == [(1, "a"), (3, "b")]


def test_every_row_of_a_repeated_key_is_marked(spark, rows):
    df = spark.createDataFrame(
        [("c1", 1, "x"), ("c1", 1, "y"), ("c2", 1, "z"), (None, 1, "p"), (None, 1, "q"), ("c1", None, "r"), ("c1", None, "s")],
        "client_id string, id int, note string",
    )
    rules = RuleSet(unique=(quality.unique_per_client("id"), ("note",), ("absent",)))
    checked = quality.check(df, rules)
    assert checked.columns == [*df.columns, "_quality_valid", "_quality_issues"]
    assert rows(checked.filter("not _quality_valid"), "note", "_quality_issues") == [("x", "UNIQUENESS_FAIL;"), ("y", "UNIQUENESS_FAIL;")]
    found = quality.issue_rows(df, rules, "t", "note", AT())
    assert rows(found, "record_id", "validation_rule") == [("x", "uniqueness:client_id,id"), ("y", "uniqueness:client_id,id")]


def test_primary_key_rule_follows_from_the_schema(spark):
    table = TableSpec("t", {"a": ColumnSpec("BIGINT", False, True, source_field="a"), "b": ColumnSpec("INT", False, True, source_field="b")})
    assert quality.rules_from_table(table).unique == (("a", "b"),)
    assert quality.rules_from_table(table, RuleSet(unique=(("b",),))).unique == (("b",),)
    assert quality.rules_from_table(TableSpec("t", {"a": ColumnSpec("INT")})).unique == ()


TYPES = [None, "int", "bigint", "decimal(18,2)", "decimal(20,0)", "decimal(38,4)", "double", "boolean", "date", "timestamp", "string"]


def test_types_form_a_lattice():
    for a in TYPES:
        assert type_plan.join(a, a) == a and type_plan.join(a, None) == a
        for b in TYPES:
            assert type_plan.join(a, b) == type_plan.join(b, a)
            for c in TYPES:
                assert type_plan.join(type_plan.join(a, b), c) == type_plan.join(a, type_plan.join(b, c)), (a, b, c)
    assert type_plan.join("bigint", "double") == "string" and type_plan.join("int", "decimal(18,2)") == "decimal(18,2)"
    assert type_plan.join("bigint", "decimal(18,2)") == "decimal(21,2)" and type_plan.join("decimal(38,0)", "decimal(18,2)") == "string"


def test_no_value_is_lost_over_runs(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "plan")
    loads = [
        [("1", "0007", "1.5", None, "yes"), ("2", "12", "2.25", None, "no")],
        [("3000000000", "8", "1e3", "2024-01-01", "perhaps"), ("x", None, "12345678901234567890.125", None, "no")],
        [("4", "x", "7", "2024-02-30", "yes")],
    ]
    schema = "a string, b string, c string, d string, e string"
    profiled = []
    full = typing.inference_profile
    monkeypatch.setattr(typing, "inference_profile", lambda df, *a: profiled.append(df.columns) or full(df, *a))
    plans = []
    for n, data in enumerate(loads):
        df = spark.createDataFrame(data, schema)
        typed = type_plan.typed(df, path, f"r{n}")
        kept = spark.createDataFrame(typed.collect(), typed.schema)
        plans.append(type_plan.learn(kept, path, f"r{n}"))
        # Every value is in its column or, as it was, beside it.
        back = typed.select(*[F.coalesce(F.get_json_object("_untyped", f"$.{c}"), F.col(c).cast("string")).alias(c) for c in df.columns])
        for got, was in zip(rows(back), sorted(data, key=lambda r: [(v is not None, str(v)) for v in r])):
            for g, w in zip(got, was):
                same = g == w or (w in ("yes", "no") and g == {"yes": "true", "no": "false"}[w]) or float(g) == float(w)
                assert same, (got, was)
    assert profiled == [list("abcde"), ["d"]]
    assert plans[0] == {"a": "int", "b": "string", "c": "decimal(18,2)", "e": "boolean"}
    assert plans[1]["a"] == "string" and plans[1]["c"] == "decimal(23,3)" and plans[1]["e"] == "string"
    assert plans[1]["d"] == "date" and plans[2]["d"] == "string"
    assert type_plan.load(spark, str(tmp_path / "none")) is None


def test_silver_infers_without_loss_and_keeps_its_plan(spark, rows, tmp_path):
    data = [(i, "0007" if i == 3 else "7", "7" if i % 20 == 3 else "1") for i in range(100)]
    bronze = spark.createDataFrame(data, "id int, code string, quantity string")
    spec = SilverSpec(keys=("id",))
    silver = layers.to_silver(bronze, spec)
    assert dict(silver.dtypes)["code"] == "string" and dict(silver.dtypes)["quantity"] == "int"
    assert silver.filter("quantity is null or code is null").count() == 0
    found = []
    layers.to_silver(bronze.withColumn("quantity", F.when(F.col("id") == 5, "?").otherwise(F.col("quantity"))), spec, issues=found.append)
    assert rows(found[0]) == [(5, "quantity", "?", "int")]
    path = str(tmp_path / "plan")
    first = layers.to_silver(bronze, spec, types=path, run="a")
    again = layers.to_silver(bronze.withColumn("quantity", F.lit("9.5")), spec, types=path, run="b")
    assert first.filter("_untyped is not null").count() == 0 and again.filter("quantity is null").count() == 100
    type_plan.learn(again, path, "b")
    assert dict(layers.to_silver(bronze, spec, types=path, run="c").dtypes)["quantity"] == "decimal(18,2)"


def test_durations_are_measured_and_ranked(spark, rows, tmp_path):
    meter = lineage.StageMeter("p")
    one = meter.timed(spark.range(50), "read", str(tmp_path / "copy"))
    two = meter.watch(one.filter("id < 20"), "filter")
    meter.timed(two, "keep")
    for _ in range(2):
        lineage.write_report(meter.report(spark, AT()), str(tmp_path / "r"), "run1")
    back = lineage.read_reports(spark, str(tmp_path / "r"))
    assert rows(back, "stage", "records_in", "records_out", "run") == [("filter", 50, 20, "run1"), ("keep", 20, 20, "run1"), ("read", 50, 50, "run1")]
    seconds = {r.stage: r.duration_seconds for r in back.collect()}
    assert seconds["filter"] is None and seconds["read"] > 0 and seconds["keep"] > 0
    first = lineage.slowest(back, 1).first()
    assert first.duration_seconds == max(seconds["read"], seconds["keep"])
    assert spark.read.parquet(str(tmp_path / "copy")).count() == 50


def test_silver_cleans_once_and_its_code_is_compiled(spark, capsys):
    """The profile and the typed rows read one cleaned copy; no generated method is over the JVM's 8000 bytes."""
    silver = QUERIES["bronze_to_silver"](spark, "/root/testdata/sf0.001")
    assert all("silver-clean" in f for f in silver.inputFiles())
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        silver.select("*").explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) <= 8000


def test_silver_keeps_columns_that_cannot_be_stored(spark):
    bronze = spark.sql("select ' 1 ' as id, 1L as modified, '2.5' as amount, null as nothing, array() as list")
    spec = SilverSpec(keys=("id",), order_column="modified", normalize={}, convert={}, critical=(), defaults={})
    out = layers.to_silver(bronze, spec)
    assert dict(out.dtypes)["nothing"] == "void" and dict(out.dtypes)["amount"] == "decimal(18,2)"
    assert [r.id for r in out.collect()] == ["1"]
