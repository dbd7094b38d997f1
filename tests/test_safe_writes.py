"""Null and repeated keys in upserts, columns that a stream batch lacks, and null moves between versions."""

from pyspark.sql import functions as F

from tributary.operators import incremental, lineage, mapping, tables
from tributary.streaming import jobs


def test_upsert_null_and_repeated_keys(spark, rows):
    old = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, v string")
    new = spark.createDataFrame([(None, "x"), (2, "y"), (2, "z"), (3, "w")], "k int, v string")
    got = rows(tables.upsert(old, new, ["k"], [F.col("v").desc()]))
    assert got == [(None, "x"), (1, "a"), (2, "z"), (3, "w")]
    assert len(rows(tables.upsert(old, new, ["k"]))) == 4
    assert len(rows(tables.replace_keys(old, new, ["k"]))) == 5


def test_hash_changes_sees_null_moves(spark, rows):
    old = spark.createDataFrame([(1, None, "x"), (2, "a|b", "c"), (3, "s", "t")], "id int, p string, q string")
    new = spark.createDataFrame([(1, "x", None), (2, "a", "b|c"), (3, "s", "t")], "id int, p string, q string")
    assert rows(lineage.hash_changes(old, new, ["id"])) == [(1, "changed"), (2, "changed")]


def test_fixed_names():
    assert next(iter(mapping.ORDER_FIELDS.items())) == ("vtex_id", "commerceId")
    assert incremental.MODIFIED_FIELDS == ("dateModified", "date_modified", "updated_at", "modified_at")


def test_stream_upsert_keeps_columns_that_a_batch_lacks(spark, rows, tmp_path):
    target, landing = str(tmp_path / "t"), str(tmp_path / "in")
    wide = spark.createDataFrame([(1, 5, "keep", "d1"), (2, 5, "keep", "d1")], "id int, at int, extra string, day string")
    wide.write.partitionBy("day").parquet(target)
    spark.createDataFrame([(1, 9, "d1")], "id int, at int, day string").write.parquet(landing)
    stream = spark.readStream.schema("id int, at int, day string").parquet(landing)
    jobs.stream_upsert(stream, target, ["id"], "at", ["day"], str(tmp_path / "c"), trigger=None).awaitTermination()
    assert rows(spark.read.parquet(target), "id", "at", "extra") == [(1, 9, None), (2, 5, "keep")]
