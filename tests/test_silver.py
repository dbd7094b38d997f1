"""Nesting, duplicates and gaps on rebuilt fixtures."""

import pytest
from pyspark.sql import functions as F

from tributary.config import ColumnSpec, Relation, TableSpec
from tributary.functions.paths import path_column
from tributary.operators import dedup, gaps, mapping, nested, skew
from tributary.operators.windows import dense_group_id, surrogate_key, top_per_key

ORDER = (
    "id string, dateCreated bigint, dateModified bigint, status string, totalAmount double, "
    "totals struct<items:struct<amount:double,originalAmount:double>>, "
    "items array<struct<id:string,sku:string,quantity:bigint,price:double,substitute_type:string>>, "
    "shipping struct<addresses:array<struct<city:string,lat:double>>>, customer struct<id:string,email:string>, "
    "customData struct<delivery_notes:string,gift_wrap:string>"
)


@pytest.fixture()
def orders(spark):
    """Three arrivals of two orders: one updated later with fewer items, one almost empty."""
    item = lambda n: (f"i{n}", f"k{n}", n, 1.5 * n, "substitute" if n == 2 else None)
    return spark.createDataFrame(
        [
            ("o1", 100, 100, "new", 10.0, ((9.0, 8.0),), [item(1), item(2)], ([("Lima", -12.0), ("Ica", -14.0)],), ("c1", "A@X.PE"), ("door", "yes")),
            ("o2", 100, None, "new", 5.0, None, [], ([],), None, (None, None)),
            ("o1", 100, 200, "done", 11.0, ((10.0, 8.0),), [item(1)], ([("Lima", -12.0)],), ("c1", "A@X.PE"), ("door", "no")),
        ],
        ORDER,
    )


def test_flatten_leaves_no_struct(orders):
    out = nested.flatten(orders)
    assert not [t for _, t in out.dtypes if t.startswith("struct")]
    assert "totals_items_amount" in out.columns and "shipping_addresses" in out.columns


def test_flatten_collisions_get_suffixes(spark):
    df = spark.sql("select 1 as a_b, named_struct('b', 2) as a, named_struct('b_1', 3) as c, 4 as a_b_1")
    assert nested.flatten(df).columns == ["a_b", "a_b_2", "c_b_1", "a_b_1"]


def test_flatten_is_idempotent(spark, rows):
    df = spark.createDataFrame([(1, "n", 3)], "id int, name string, age int")
    assert nested.flatten(df).schema == df.schema and rows(nested.flatten(df)) == rows(df)


def test_flatten_depth_and_modes(orders):
    assert [t for _, t in nested.flatten(orders, max_depth=1).dtypes if t.startswith("struct")]
    assert dict(nested.flatten(orders, arrays="json").dtypes)["items"] == "string"
    exploded = nested.flatten(orders.select("id", "items"), arrays="explode")
    assert exploded.count() == 4 and "items_sku" in exploded.columns
    with pytest.raises(ValueError):
        nested.flatten(orders, arrays="nope")


def test_exploding_two_arrays_multiplies(spark):
    df = spark.createDataFrame([(1, [1, 2], [3, 4, 5])], "id int, a array<int>, b array<int>")
    assert nested.explode_arrays(df).count() == 6


def test_child_table_keeps_empty_parents(orders):
    child = nested.child_table(orders, "items", "id", "order_id")
    assert child.columns == ["order_id", "id", "sku", "quantity", "price", "substitute_type"]
    assert child.count() == 4 and child.filter("sku is null").count() == 1
    assert nested.child_table(orders, "items", "id", "order_id", keep_empty=False).count() == 3


def test_child_field_named_like_the_key(spark):
    df = spark.createDataFrame([("p", [("x",)])], "id string, items array<struct<id:string>>")
    assert nested.child_table(df, "items", "id").columns == ["id", "id_1"]


def test_key_value_tables(spark, orders):
    kv = nested.key_value_table(orders, "customData", "id", "order_id")
    assert kv.columns == ["order_id", "field", "value"] and kv.count() == 6
    empty = nested.key_value_table(orders, "status", "id", "order_id")
    assert empty.count() == 0 and empty.columns == kv.columns
    maps = spark.createDataFrame([(1, {"a": 1}), (2, None)], "id int, m map<string,int>")
    assert nested.key_value_table(maps, "m").count() == 2


def test_split_entity(orders):
    parts = nested.split_entity(
        orders,
        [
            Relation("items", "order_items", "order_id"),
            Relation("customData", "order_fields", "order_id", "key_value"),
            Relation("customer", "order_customer", "order_id", "one_to_one"),
            Relation("absent", "nothing", "order_id"),
        ],
    )
    assert set(parts) == {"order_items", "order_fields", "order_customer", ""}
    assert "items" not in parts[""].columns and parts["order_customer"].columns == ["order_id", "id", "email"]


def test_paths(orders):
    out = orders.filter("dateModified = 100 or dateModified is null").select(
        "id",
        path_column(orders, "shipping.addresses[0].city").alias("c"),
        path_column(orders, "shipping.addresses[1].city").alias("d"),
        path_column(orders, "items.sku").alias("s"),
        path_column(orders, "nope.x").alias("n"),
    )
    assert sorted(tuple(r) for r in out.collect()) == [("o1", "Lima", "Ica", "k1", None), ("o2", None, None, None, None)]


def test_array_counts(orders):
    out = orders.select(
        "id", nested.count_where(F.col("items"), lambda e: e["substitute_type"] == "substitute").alias("n")
    )
    assert sorted(tuple(r) for r in out.collect()) == [("o1", 0), ("o1", 1), ("o2", 0)]


def test_latest_version_wins(orders, rows):
    best = dedup.resolve_conflicts(orders, ["id"], "dateModified")
    assert rows(best, "id", "status") == [("o1", "done"), ("o2", "new")]


@pytest.mark.parametrize(
    "entity,arrivals,unique",
    [("orders", [("a", 1), ("b", None), ("a", 2)], 2), ("items", [("a", 1), ("b", 1), ("c", None), ("a", 2)], 3),
     ("products", [("a", 1), ("b", 1), ("c", 1), ("c", 2)], 3), ("skus", [("a", 1), ("b", 1), ("c", 1), ("a", 3)], 3),
     ("stock", [("a", 1), ("b", 1), ("c", 1), ("d", None), ("a", 2)], 4)],
)
def test_expected_unique_counts(spark, entity, arrivals, unique):
    df = spark.createDataFrame(arrivals, "id string, modified int")
    out = dedup.resolve_conflicts(df, ["id"], "modified")
    assert out.count() == unique
    newest = {k: max((m for i, m in arrivals if i == k and m is not None), default=None) for k, _ in arrivals}
    assert {r.id: r.modified for r in out.collect()} == newest


def test_resolve_prefers_fewer_nulls_then_is_stable(spark):
    df = spark.createDataFrame([("k", 1, None), ("k", 1, "x"), ("k", 1, "y")], "id string, ts int, v string")
    first = dedup.resolve_conflicts(df, ["id"], "ts").first()
    assert first.v in ("x", "y")
    for n in (1, 2, 3):
        assert dedup.resolve_conflicts(df.repartition(n), ["id"], "ts").first() == first


def test_resolve_without_timestamp_column(spark):
    df = spark.createDataFrame([("k", None), ("k", "x")], "id string, v string")
    assert dedup.resolve_conflicts(df, ["id"], "absent").first().v == "x"
    with pytest.raises(ValueError):
        dedup.resolve_conflicts(df, ["id"], strategy="nope")


def test_mark_duplicates_groups_null_keys(spark, rows):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (None, None)], "a int, b string")
    marked = dedup.mark_duplicates(df, ["a", "b"])
    assert rows(marked, "a", "b", "is_duplicate") == [(None, None, False), (1, None, True), (1, None, True), (2, "a", False)]
    assert marked.select("duplicate_group_id").distinct().count() == 3
    for bad in ([], ["nope"]):
        with pytest.raises(ValueError):
            dedup.mark_duplicates(df, bad)


def test_hot_keys_are_spread_and_results_whole(spark):
    """One key holds a third of all rows; the summary names it, and no row of it is shuffled or lost."""
    df = spark.range(9000).select(F.when(F.col("id") < 3000, 0).otherwise(F.col("id")).alias("k"), "id")
    staged, hot, total = skew.staged_with_hot(df, ["k"])
    key = spark.range(1).select(F.xxhash64(F.lit(0).cast("bigint"))).first()[0]
    assert total == 9000 == staged.count() and hot == [key]
    for least in (None, 1000):
        out = skew.with_group_stats(df, ["k"], least, n=F.count(F.lit(1)), top=F.max("id"))
        assert out.count() == 9000
        assert out.filter("k = 0").select("n", "top").distinct().collect() == [(3000, 2999)]
        assert out.filter("k <> 0 and (n <> 1 or top <> id)").count() == 0


def test_group_facts_evaluate_their_input_once(spark, capsys):
    """The input is written once; what remains reads that copy, with one shuffle for the window and none for hot rows."""
    runs = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def counted(v):
        runs.add(1)
        return v

    df = spark.range(2000).select(F.when(F.col("id") < 1000, 0).otherwise(counted("id")).alias("k"), counted("id").alias("v"))
    for build in (lambda: dedup.mark_duplicates(df, ["k"]), lambda: dense_group_id(df, ["k"])):
        before = runs.value
        out = build()
        out.write.format("noop").mode("overwrite").save()
        assert runs.value - before <= 2 * 2000
    out = dedup.mark_duplicates(df, ["k"])
    capsys.readouterr()
    out.explain("simple")
    plan = capsys.readouterr().out
    # The window's shuffle, and the one of the aggregate over hot keys, whose rows are partial results.
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Window") == 1 and "BroadcastExchange" in plan
    rows = [tuple(r) for r in out.select("k", "is_duplicate").distinct().collect()]
    assert len(rows) == 1001 and sorted(rows)[0] == (0, True)


def test_fills_split_a_hot_key_hour_and_keep_fractions_of_a_second(spark, capsys):
    """A third of all rows in one key and one hour lie in many ranges; both fills move the rows twice."""
    hot = spark.range(3000).select(F.lit("hot").alias("k"), F.expr("timestamp_micros(1704067200000000 + id * 1000)").alias("ts"),
                                   F.when(F.col("id") % 700 == 5, F.col("id") * 1.0).alias("v"), "id")
    cold = spark.range(6000).select(F.concat(F.lit("k"), (F.col("id") % 600).cast("string")).alias("k"),
                                    F.expr("timestamp_micros(1704067200000000 + id * 1500000)").alias("ts"),
                                    F.when(F.col("id") % 13 == 0, F.col("id") * 2.0).alias("v"), (F.col("id") + 3000).alias("id"))
    nulls = spark.range(3).select(F.lit(None).cast("string").alias("k"), F.expr("timestamp_micros(id)").alias("ts"),
                                  F.when(F.col("id") != 1, F.col("id") * 1.0).alias("v"), (F.col("id") + 9000).alias("id"))
    df = hot.unionByName(cold).unionByName(nulls)
    data = {}
    for r in df.withColumn("us", F.unix_micros("ts")).collect():
        data.setdefault(r.k, []).append((r.us, r.id, r.v))
    fill, line = {}, {}
    for rows in data.values():
        rows.sort()
        for i, (at, ident, v) in enumerate(rows):
            prev = next(((t, x) for t, _, x in reversed(rows[: i + 1]) if x is not None), None)
            nxt = next(((t, x) for t, _, x in rows[i + 1 :] if x is not None), None)
            fill[ident] = prev and prev[1]
            line[ident] = v if v is not None or not (prev and nxt) else prev[1] + (nxt[1] - prev[1]) * ((at - prev[0]) / (nxt[0] - prev[0]))
    assert {r.id: r.v for r in gaps.forward_fill(df, ["k"], "ts", "v", ["id"]).collect()} == fill
    both = gaps.interpolate(df, ["k"], "ts", "v", ["id"])
    assert {r.id: r.v for r in both.collect()} == line
    capsys.readouterr()
    both.explain("simple")
    plan = capsys.readouterr().out.split("== Initial Plan ==")[0]
    # One exchange of the staged rows for both windows; edges move as one row per key and range, or per range.
    assert plan.count("Exchange hashpartitioning(_range#") <= 3 and "SortMergeJoin" not in plan and plan.count("BroadcastExchange") <= 2


def test_dense_group_id_and_surrogate_key(spark, rows):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), (None,)], "k string")
    assert rows(dense_group_id(df, ["k"], "g")) == [(None, 1), ("a", 2), ("b", 3), ("b", 3), ("c", 5)]
    big = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    assert surrogate_key(big, ["v"]).filter("sk <> v + 1").count() == 0


def test_top_per_key(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 1)], "k string, v int")
    assert rows(top_per_key(df, ["k"], [F.col("v").desc()], 2)) == [("a", 2), ("a", 3), ("b", 1)]


def test_source_priority_breaks_ties(spark):
    df = spark.createDataFrame([("k", 5, "polling"), ("k", 5, "webhook"), ("k", 4, "webhook")], "id string, at int, source string")
    best = dedup.resolve_conflicts(df, ["id"], "at", dedup.source_rank(F.col("source"))).first()
    assert (best.at, best.source) == (5, "webhook")


def test_merge_versions_keeps_newest_known_values(spark):
    df = spark.createDataFrame([("k", 1, "a", None), ("k", 2, None, "b"), ("k", 3, None, None)], "id string, v int, x string, y string")
    assert dedup.merge_versions(df, ["id"], "v").first() == ("k", 3, "a", "b")


def test_gap_order_matters(spark, rows):
    df = spark.createDataFrame([(1, None), (2, 5)], "id int, v int")
    assert rows(gaps.handle_gaps(df, ["v"], {"v": 0})) == [(1, 0, True), (2, 5, False)]
    assert rows(gaps.handle_gaps(df, ["v"], {"v": 0}, fill_first=True)) == [(1, 0, False), (2, 5, False)]
    assert gaps.handle_gaps(df, ["v"], reject=True).count() == 1
    with pytest.raises(ValueError):
        gaps.mark_gaps(df, ["nope"])
    assert gaps.mark_gaps(df, ["nope"], ignore_missing=True).filter("has_critical_gaps").count() == 0
    assert "_v_imputed" in gaps.fill_defaults(df, {"v": 0}, flag_imputed=True).columns


def test_gap_columns(spark):
    spec = TableSpec("t", {"id": ColumnSpec("INT", source_field="id"), "w": ColumnSpec("BIGINT"), "c": ColumnSpec("INT", calculated=True)})
    out = gaps.add_gap_columns(spark.range(2).select(F.col("id").cast("int")), spec)
    assert out.dtypes == [("id", "int"), ("w", "bigint")]


def test_missing_quantity_fallbacks(spark):
    full = spark.createDataFrame([(5, 3), (5, None)], "quantity int, quantity_picked int")
    assert [r[0] for r in full.select(gaps.missing_quantity(full)).collect()] == [2, 5]
    part = full.select("quantity")
    assert part.select(gaps.missing_quantity(part)).first()[0] == 5
    assert spark.range(1).select(gaps.missing_quantity(spark.range(1))).first()[0] == 0


def test_fill_and_interpolate_against_brute_force(spark):
    import random

    rnd = random.Random(3)
    data = [(rnd.choice("abc"), n * 20000 + rnd.randint(0, 9), rnd.choice([None, None, float(n)])) for n in range(200)]
    df = spark.createDataFrame(data, "k string, s bigint, v double").select(
        "k", "s", F.timestamp_add("SECOND", F.col("s"), F.expr("timestamp_ntz'2024-01-01'")).alias("ts"), "v"
    )
    filled = {(r.k, r.s): r.v for r in gaps.forward_fill(df, ["k"], "ts", "v").collect()}
    lines = {(r.k, r.s): r.v for r in gaps.interpolate(df, ["k"], "ts", "v").collect()}
    for key in "abc":
        line = sorted((s, v) for k, s, v in data if k == key)
        for s, v in line:
            before = [p for p in line if p[0] <= s and p[1] is not None]
            after = [p for p in line if p[0] > s and p[1] is not None]
            assert filled[key, s] == (before[-1][1] if before else None)
            want = v
            if v is None and before and after:
                (s0, v0), (s1, v1) = before[-1], after[0]
                want = v0 + (v1 - v0) * ((s - s0) / (s1 - s0))
            assert lines[key, s] == want


def test_order_maps(spark):
    raw = spark.createDataFrame(
        [
            (
                "o1", "77", ("acc",), {"S1": "x"}, [("a1", "Lima", "N", "C", [-77.0, -12.0]), ("a2", "Ica", "N", "C", [-75.0, -14.0])],
                [("s1", "car", (10, 20), 30)], [("i1", "k1", 2.0)],
            )
        ],
        "id string, commerceSequentialId string, account struct<id:string>, statusPerLocation map<string,string>, "
        "addresses array<struct<id:string,city:string,neighborhood:string,complement:string,geolocation:array<double>>>, "
        "shippings array<struct<id:string,carrierId:string,deliveryWindow:struct<initialDate:bigint,finalDate:bigint>,dateModified:bigint>>, "
        "items array<struct<id:string,skuId:string,purchasedQuantity:double>>",
    )
    order = mapping.order_fields(raw).first()
    assert len(mapping.ORDER_FIELDS) == 26 and len(order) == 26
    assert (order.id, order.seq_id, order.store, order.customer_address, order.total) == ("o1", "77", "S1", "a1", None)
    item = mapping.item_fields(raw).first()
    assert len(item) == 11 and (item.id, item.order_id, item.sku, item.quantity) == ("i1", "o1", "k1", 2.0)
    ships = mapping.shipping_fields(raw).collect()
    assert len(ships) == 1 and len(ships[0]) == 12
    assert (ships[0].lat, ships[0].lng, ships[0].shipping_window_end, ships[0].shipped_date_start) == (-12.0, -77.0, 20, 30)


def test_formula_allow_list(spark):
    with pytest.raises(ValueError):
        mapping.calculate(spark.range(1), {"x": 'java_method("a", "b")'})


def test_every_heavy_key_is_hot_whatever_their_number(spark):
    """The list of candidates grows with the number of keys that can be heavy, so none is cut off."""
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1000")
        df = spark.range(24000).select((F.col("id") % 1200).alias("k"), "id")
        _, hot, _ = skew.staged_with_hot(df, ["k"])
        assert len(set(hot)) == 1200
        out = skew.with_group_stats(df, ["k"], n=F.count(F.lit(1)))
        assert out.count() == 24000 and out.filter("n <> 20").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)


def test_group_stats_of_an_empty_table(spark):
    df = spark.range(0).select(F.col("id").alias("k"), "id")
    assert skew.with_group_stats(df, ["k"], n=F.count(F.lit(1))).count() == 0


def test_deep_structs_and_long_json_stay_whole(spark):
    deep = "1 as v"
    for _ in range(14):
        deep = f"named_struct('s', struct({deep})) as v" if deep == "1 as v" else f"struct({deep}) as v"
    flat = nested.flatten(spark.sql(f"select {deep}"))
    assert len(flat.columns) == 1 and flat.dtypes[0][1] == "int"
    long = spark.range(1).select(F.array(F.lit("x" * 70000)).alias("a"))
    assert len(nested.complex_to_json(long).first().a) == 70004
