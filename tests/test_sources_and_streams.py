"""Readers, writers and streaming jobs on temporary folders."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary import session
from tributary.sources import readers, writers
from tributary.streaming import jobs

AT = lambda: F.lit("2026-02-03 04:05:06").cast("timestamp")
SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])


def write_lines(path, *lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, f"{len(os.listdir(path))}.json"), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_broken_json_is_kept_apart(spark, tmp_path):
    write_lines(str(tmp_path / "in"), '{"id":"a","n":1}', "{broken", '{"id":"b"}')
    for schema in (SCHEMA, "id string, n bigint"):
        good, bad = readers.split_corrupt(readers.read_json(spark, str(tmp_path / "in"), schema))
        assert sorted((r.id, r.n) for r in good.collect()) == [("a", 1), ("b", None)]
        assert [tuple(r) for r in bad.collect()] == [("{broken", "CORRUPT_JSON")]
    assert set(readers.read_json(spark, str(tmp_path / "in")).columns) >= {"id", "n"}


def test_envelope_round_trip(spark):
    df = spark.createDataFrame([("a", 1)], SCHEMA)
    wrapped = readers.wrap_envelope(df, "shop", "orders", "webhook", AT())
    meta = wrapped.first()["_metadata"]
    assert (meta.client_id, meta.entity_type, meta.source, meta.api_version) == ("shop", "orders", "webhook", "v2")
    assert readers.unwrap_envelope(wrapped).select("id", "n").first() == ("a", 1)


def test_pages(spark):
    df = spark.createDataFrame(
        [(1, '[{"id":"a","n":1},{"id":"b","n":2}]'), (2, '{"data":[{"id":"c","n":3}],"pagination":{"page":1}}'), (3, '"x"'), (4, "{}"), (5, None)],
        "page int, payload string",
    )
    out = readers.unwrap_pages(df, "payload", "struct<id:string,n:bigint>")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", 1), (1, "b", 2), (2, "c", 3)]


def test_landing_layout(spark, tmp_path):
    path = str(tmp_path / "bronze")
    df = spark.createDataFrame([("a", 1)], SCHEMA)
    writers.land(df, path, "shop", "orders", AT())
    folder = f"{path}/client=shop/entity=orders/year=2026/month=2/day=3"
    assert os.path.isdir(folder)
    files = lambda: [f for f in os.listdir(folder) if f.endswith(".json")]
    count = len(files())
    writers.land(df.limit(0), path, "shop", "orders", AT())
    assert len(files()) == count
    writers.land(df, path, "shop", "orders", AT())
    assert spark.read.json(path).count() == 2


def test_partition_overwrite_keeps_other_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "p")
    writers.write_partitioned(spark.createDataFrame([("a", 1), ("b", 2)], SCHEMA), path, ["n"])
    writers.overwrite_partitions(spark.createDataFrame([("z", 2)], SCHEMA), path, ["n"])
    assert rows(readers.read_parquet(spark, path)) == [("a", 1), ("z", 2)]
    writers.append(spark.createDataFrame([("y", 2)], SCHEMA), path, ["n"])
    assert readers.read_parquet(spark, path).count() == 3
    writers.full_replace(spark.createDataFrame([("only", 9)], SCHEMA), path)
    assert rows(readers.read_parquet(spark, path)) == [("only", 9)]


def test_types_survive_a_round_trip(spark, tmp_path, rows):
    df = spark.sql("select 'a' id, 1 value, cast(1.50 as decimal(10,2)) amount, timestamp'2024-01-01' ts union all select 'b', null, null, null")
    path = str(tmp_path / "rt")
    df.write.parquet(path)
    assert rows(readers.read_parquet(spark, path)) == rows(df)
    writers.append(df, path)
    assert readers.read_parquet(spark, path).count() == 4


def test_json_csv_and_text(spark, tmp_path):
    df = spark.sql("select 1 id, named_struct('x', 2) s, array(1, 2) a")
    writers.write_json(df, str(tmp_path / "j"), single_file=True)
    assert len([f for f in os.listdir(tmp_path / "j") if f.endswith(".json")]) == 1
    writers.write_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first() == ("1", "2", "[1,2]")
    writers.write_text(df, str(tmp_path / "t"))
    assert json.loads(spark.read.text(str(tmp_path / "t")).first().value) == {"id": 1, "s": {"x": 2}, "a": [1, 2]}


def test_export_manifest(spark, tmp_path):
    manifest = writers.export_with_manifest(spark.range(100), str(tmp_path / "e"), 4, "id", "id >= 10").collect()
    assert sum(r.rows for r in manifest) == 90 and len(manifest) == 4
    assert all(r.bytes > 0 and r.where_clause == "id >= 10" for r in manifest)


def test_audit_tables(spark, tmp_path):
    paths = writers.create_audit_tables(spark, str(tmp_path))
    assert set(paths) == {"data_gaps_log", "data_quality_issues", "schema_changes_log"}
    row = spark.createDataFrame([("g", "orders", "t", "f", 3)], "gap_id string, entity_type string, table_name string, field_name string, record_count int")
    writers.append_audit(row.withColumn("timestamp", AT()), str(tmp_path), "data_gaps_log")
    assert spark.read.parquet(paths["data_gaps_log"]).first().record_count == 3
    assert spark.read.parquet(paths["schema_changes_log"]).count() == 0


def test_catalog_table(spark, tmp_path):
    spark.sql(f"create database if not exists lake location '{tmp_path / 'lake'}'")
    writers.create_table(spark.createDataFrame([("a", 1)], SCHEMA), "lake.orders", ["n"])
    spark.createDataFrame([("a", 1)], SCHEMA).write.insertInto("lake.orders")
    assert readers.read_table(spark, "lake.orders").count() == 1
    spark.sql("drop database lake cascade")


def test_staged_load_stops_on_bad_data(spark, tmp_path):
    loaded = []

    def refuse(df):
        if df.filter("n is null").count():
            raise ValueError("nulls")

    good, bad = spark.createDataFrame([("a", 1)], SCHEMA), spark.createDataFrame([("a", None)], SCHEMA)
    writers.staged_load(good, str(tmp_path / "s"), refuse, lambda d: loaded.append(d.count()))
    with pytest.raises(ValueError):
        writers.staged_load(bad, str(tmp_path / "s"), refuse, lambda d: loaded.append(d.count()))
    assert loaded == [1]


def test_extract_ranges_cover_every_row(spark):
    df = spark.range(1000)
    out = readers.extract_partitioned(spark, df, "id", 0, 500, 4, "id % 2 = 0")
    assert out.count() == 500 and out.rdd.getNumPartitions() == 4


class FakeSession:
    def __init__(self, master, named=None):
        class Context:
            applicationId = "app"

        self.sparkContext = Context()
        self.sparkContext.master = master
        self.conf = {"spark.checkpoint.dir": named} if named else {}


def test_shared_folder_rules():
    assert session.scratch_path(FakeSession("yarn", "hdfs:///shared/"), "x").startswith("hdfs:///shared/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeSession("yarn"))
    local = FakeSession("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local)


def test_stream_landing_splits_errors(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    write_lines(src, '{"id":"a","n":1}', "{oops")

    def run():
        jobs.stream_land(spark, src, SCHEMA, out, str(tmp_path / "cp"), "shop", "orders", None).awaitTermination()

    run()
    write_lines(src, '{"id":"b","n":2}')
    run()
    run()
    data = spark.read.parquet(f"{out}/data")
    assert sorted(r.id for r in data.select("data.*").collect()) == ["a", "b"]
    assert {r.client for r in data.collect()} == {"shop"}
    assert [r.record for r in spark.read.parquet(f"{out}/errors").collect()] == ["{oops"]


def test_stream_upsert_keeps_the_newest(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    schema = T.StructType([*SCHEMA.fields, T.StructField("day", T.LongType())])

    def run():
        stream = spark.readStream.schema(schema).json(src)
        jobs.stream_upsert(stream, out, ["id"], "n", ["day"], str(tmp_path / "cp"), None).awaitTermination()
        return sorted((r.id, r.n, r.day) for r in spark.read.parquet(out).collect())

    write_lines(src, '{"id":"a","n":1,"day":1}', '{"id":"a","n":3,"day":1}', '{"id":"b","n":1,"day":2}')
    assert run() == [("a", 3, 1), ("b", 1, 2)]
    write_lines(src, '{"id":"a","n":2,"day":1}', '{"id":"c","n":1,"day":2}')
    assert run() == [("a", 3, 1), ("b", 1, 2), ("c", 1, 2)]


def test_stream_counts_and_dedup(spark, tmp_path):
    src = str(tmp_path / "src")
    lines = ['{"id":"%s","at":"2024-01-01T00:0%d:00"}' % (i, m) for i, m in (("a", 0), ("a", 1), ("b", 6), ("c", 7))]
    write_lines(src, *lines)
    stream = lambda: spark.readStream.schema("id string, at timestamp").json(src)
    out = str(tmp_path / "counts")
    jobs.save_updates(jobs.stream_window_counts(stream(), "at"), out, str(tmp_path / "cp1")).awaitTermination()
    got = jobs.latest_windows(spark, out, ["window_start"]).orderBy("window_start").collect()
    assert [r.rows for r in got] == [2, 2]
    writer = jobs.stream_dedup(stream(), ["id"], "at").writeStream.format("parquet")
    writer = writer.option("path", str(tmp_path / "d")).option("checkpointLocation", str(tmp_path / "cp2"))
    jobs.triggered(writer, None).start().awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "d")).collect()) == ["a", "b", "c"]


def test_freshness(spark):
    df = spark.sql("select timestamp'2024-01-01 00:00:00' at")
    assert jobs.freshness_lag(df, "at", F.lit("2024-01-01 00:15:00").cast("timestamp")).first() == (900, True)
    assert jobs.freshness_lag(df, "at", F.lit("2024-01-01 00:15:01").cast("timestamp")).first() == (901, False)


def test_late_rows_are_kept_and_replays_change_nothing(spark, rows, tmp_path):
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    batches = [
        [(1, "2024-01-01 10:00:00"), (2, "2024-01-01 10:04:00"), (3, None)],
        [(4, "2024-01-01 09:39:59"), (5, "2024-01-01 09:59:00"), (6, "2024-01-01 11:00:00")],
        [(7, "2024-01-01 10:30:00"), (8, "2024-01-01 10:42:00")],
    ]
    for n, data in enumerate(batches):
        df = spark.createDataFrame(data, "id int, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        df.coalesce(1).write.mode("append").parquet(landing)
    stream = spark.readStream.schema("id int, ts timestamp_ntz").option("maxFilesPerTrigger", 1).parquet(landing)
    for n in range(2):
        # The second pass starts from an empty checkpoint, so every batch is replayed under its number.
        jobs.stream_counts_keeping_late(stream, "ts", out, str(tmp_path / f"c{n}"), trigger=None).awaitTermination()
        assert rows(jobs.late_rows(spark, out), "id", "_batch") == [(3, 0), (4, 1), (7, 2)]
        counts = jobs.on_time_counts(spark, out)
        assert rows(counts.select(F.date_format("window_start", "HH:mm"), "rows")) == [("09:55", 1), ("10:00", 2), ("10:40", 1), ("11:00", 1)]
