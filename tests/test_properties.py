"""Properties that must hold for any input."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions.money import exact_sum, minor
from tributary.operators import clean, dedup, nested, tables, typing

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

leaf = st.sampled_from([T.StringType(), T.LongType()])
names = st.sampled_from(["a", "b", "a_b", "c"])


def structs(children):
    fields = st.dictionaries(names, children, min_size=1, max_size=3)
    return fields.map(lambda d: T.StructType([T.StructField(k, v) for k, v in d.items()]))


schemas = structs(st.recursive(leaf, structs, max_leaves=6))


def leaves(dtype):
    return sum(leaves(f.dataType) for f in dtype.fields) if isinstance(dtype, T.StructType) else 1


@FEW
@given(schema=schemas)
def test_flatten_gives_unique_flat_names(spark, schema):
    df = spark.createDataFrame([], schema)
    out = nested.flatten(df)
    assert len(out.columns) == len(set(out.columns)) == leaves(schema)
    assert not any(isinstance(f.dataType, T.StructType) for f in out.schema.fields)
    assert nested.flatten(out).schema == out.schema


versions = st.lists(
    st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.integers(0, 5)), st.one_of(st.none(), st.text("xy", max_size=2))),
    min_size=1, max_size=20,
)


@FEW
@given(data=versions, parts=st.integers(1, 5), seed=st.randoms())
def test_best_record_does_not_depend_on_order(spark, data, parts, seed):
    schema = "id string, ts int, v string"
    shuffled = list(data)
    seed.shuffle(shuffled)
    one = dedup.resolve_conflicts(spark.createDataFrame(data, schema), ["id"], "ts").collect()
    two = dedup.resolve_conflicts(spark.createDataFrame(shuffled, schema).repartition(parts), ["id"], "ts").collect()
    assert sorted(map(tuple, one), key=str) == sorted(map(tuple, two), key=str)
    assert len(one) == len({d[0] for d in data})
    for row in one:
        known = [t for i, t, _ in data if i == row.id and t is not None]
        assert row.ts == (max(known) if known else None)


@FEW
@given(
    old=st.dictionaries(st.integers(0, 9), st.integers(), max_size=8),
    new=st.dictionaries(st.integers(0, 9), st.integers(), max_size=8),
)
def test_upsert_is_a_dictionary_update(spark, old, new):
    schema = "id int, v decimal(38,0)"
    frame = lambda d: spark.createDataFrame([(k, str(v)) for k, v in d.items()], "id int, v string").select(
        "id", F.col("v").cast("decimal(38,0)").alias("v")
    )
    got = {r.id: int(r.v) for r in tables.upsert(frame(old), frame(new), ["id"]).collect()}
    assert got == {**old, **new} and schema


@FEW
@given(data=st.lists(st.one_of(st.none(), st.text(max_size=6)), min_size=1, max_size=10))
def test_clean_is_idempotent(spark, data):
    df = spark.createDataFrame([(v,) for v in data], "s string")
    once = clean.clean(df)
    assert once.collect() == clean.clean(once).collect()
    assert all(r.s is None or (r.s != "" and r.s == r.s.strip(" ")) for r in once.collect())


@FEW
@given(data=st.lists(st.sampled_from(["1", "0", "yes", "2024-01-01", "3.5", "x", None]), min_size=1, max_size=30), seed=st.randoms())
def test_inference_does_not_depend_on_order(spark, data, seed):
    shuffled = list(data)
    seed.shuffle(shuffled)
    plan = [typing.infer_types(spark.createDataFrame([(v,) for v in d], "s string")) for d in (data, shuffled)]
    assert plan[0] == plan[1]


@FEW
@given(cents=st.lists(st.integers(-(10**10), 10**10), min_size=1, max_size=30), parts=st.integers(1, 5))
def test_money_sums_are_exact(spark, cents, parts):
    df = spark.createDataFrame([(c / 100,) for c in cents], "x double").repartition(parts)
    assert int(df.agg(exact_sum(minor(F.col("x")))).first()[0]) == sum(cents)
