"""Changing tables, history, layout, and writing then reading each kind of sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.config import RuleSet
from tributary.functions import clock
from tributary.operators import incremental, quality, tables
from tributary.operators.dedup import pk_violations
from tributary.plans.registry import query, table
from tributary.session import scratch_path
from tributary.sources import readers, writers


def target_and_source(spark, sf):
    """All orders, and a batch: orders still in progress with a new price, urgent ones under a new key."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    fresh = F.col("o_orderpriority") == "1-URGENT"
    batch = o.filter("o_orderstatus = 'P'").select(
        F.when(fresh, F.col("o_orderkey") + 10000000).otherwise(F.col("o_orderkey")).alias("o_orderkey"),
        F.lit("F").alias("o_orderstatus"),
        (F.col("o_totalprice") + 1).alias("o_totalprice"),
        "o_orderdate",
    )
    return o.drop("o_orderpriority"), batch


_BATCH = """
    t AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders),
    s AS (SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey + 10000000 ELSE o_orderkey END AS o_orderkey,
                 'F' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate FROM orders WHERE o_orderstatus = 'P')
"""


@query(
    "upsert_result",
    f"""
    WITH {_BATCH}
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)
    UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM s
    """,
)
def upsert_result(spark, sf):
    target, batch = target_and_source(spark, sf)
    return tables.upsert(target, batch, ["o_orderkey"]).drop("o_orderdate")


@query(
    "upsert_partitions",
    f"""
    WITH {_BATCH},
    u AS (SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) UNION ALL SELECT * FROM s)
    SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM u
    """,
)
def upsert_partitions(spark, sf):
    """The same upsert on files: only the years in the batch are rewritten."""
    target, batch = target_and_source(spark, sf)
    path = scratch_path(spark, "orders")
    cols = ["o_orderkey", "o_orderstatus", "o_totalprice", "year"]
    writers.write_partitioned(target.withColumn("year", F.year("o_orderdate")).select(*cols), path, ["year"])
    tables.upsert_path(spark, path, batch.withColumn("year", F.year("o_orderdate")).select(*cols), ["o_orderkey"], ["year"])
    return readers.read_parquet(spark, path)


@query(
    "range_replace",
    """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate NOT BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-12-31'
    UNION ALL SELECT o_orderkey + 10000000, o_totalprice * 2 FROM orders
      WHERE o_orderdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-12-31'
    """,
)
def range_replace(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", clock.day_key(F.col("o_orderdate")).alias("day"))
    new = o.filter(F.col("day").between(19980101, 19981231)).select(
        (F.col("o_orderkey") + 10000000).alias("o_orderkey"), (F.col("o_totalprice") * 2).alias("o_totalprice"), "day"
    )
    return tables.replace_range(o, new, "day", 19980101, 19981231).drop("day")


@query(
    "key_replace",
    """
    SELECT o_custkey, o_orderkey FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    UNION ALL SELECT c_custkey, -c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'
    """,
)
def key_replace(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    new = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("o_custkey"), (-F.col("c_custkey")).alias("o_orderkey")
    )
    return tables.replace_keys(o, new, ["o_custkey"])


@query(
    "as_of",
    """
    SELECT user_id, event_type, event_id, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n
      FROM events WHERE ts <= TIMESTAMP '2024-01-15 12:00:00')
    WHERE n = 1
    """,
)
def as_of(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value", "ts")
    return tables.as_of(e, ["user_id", "event_type"], "ts", "2024-01-15 12:00:00", [F.col("event_id").desc()]).drop("ts")


@query(
    "version_history",
    """
    SELECT t.day, count(*) AS users, CAST(sum(e.event_id) AS BIGINT) AS newest
    FROM (VALUES (5), (15), (25)) t(day)
    JOIN LATERAL (SELECT user_id, max_by(event_id, (ts, event_id)) AS event_id FROM events
                  WHERE ts <= make_timestamp(2024, 1, t.day, 12, 0, 0) GROUP BY user_id) e ON true
    GROUP BY t.day
    """,
)
def version_history(spark, sf):
    """The state of every user at three moments, read from the history of events: no versions are stored."""
    e = table(spark, sf, "events").select("user_id", "event_id", "ts")
    out = None
    for day in (5, 15, 25):
        then = tables.as_of(e, ["user_id"], "ts", f"2024-01-{day:02d} 12:00:00", [F.col("event_id").desc()])
        one = then.agg(F.count(F.lit(1)).alias("users"), F.sum("event_id").alias("newest")).select(F.lit(day).alias("day"), "users", "newest")
        out = one if out is None else out.unionByName(one)
    return out.filter("users > 0")


@query(
    "range_replace_files",
    """
    SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) NOT BETWEEN 1994 AND 1996
    UNION ALL SELECT o_orderkey, o_totalprice + 1, CAST(year(o_orderdate) AS INTEGER) FROM orders WHERE year(o_orderdate) IN (1994, 1996)
    """,
)
def range_replace_files(spark, sf):
    """Three years on files are replaced; the source lacks one of them, whose old rows must go."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    path = scratch_path(spark, "years")
    writers.write_partitioned(o, path, ["year"])
    new = o.filter("year in (1994, 1996)").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    tables.replace_range_path(spark, path, new, ["year"], F.col("year").between(1994, 1996))
    return readers.read_parquet(spark, path)


@query(
    "upsert_moving",
    f"""
    WITH {_BATCH}
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)
    UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM s
    """,
)
def upsert_moving(spark, sf):
    """An upsert that moves records: every order in progress changes its status, which is the partition."""
    target, batch = target_and_source(spark, sf)
    path, cols = scratch_path(spark, "orders"), ["o_orderkey", "o_totalprice", "o_orderstatus"]
    writers.write_partitioned(target.select(*cols), path, ["o_orderstatus"])
    tables.upsert_path(spark, path, batch.select(*cols), ["o_orderkey"], ["o_orderstatus"], moving=True)
    return readers.read_parquet(spark, path)


@query(
    "partition_roundtrip",
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS rows
    FROM orders GROUP BY 1, 2
    """,
)
def partition_roundtrip(spark, sf):
    path = scratch_path(spark, "gold")
    o = tables.date_partitions(table(spark, sf, "orders"), "o_orderdate", ("year", "month"))
    writers.write_partitioned(o, path, ["year", "month"], sort=["o_orderkey"])
    return tables.partition_stats(readers.read_parquet(spark, path), ["year", "month"])


@query(
    "bronze_roundtrip",
    """
    SELECT o_orderkey, o_orderstatus, o_totalprice, 'shop' AS client_id, 'orders' AS entity FROM orders
    """,
)
def bronze_roundtrip(spark, sf):
    path = scratch_path(spark, "bronze")
    at = F.lit("2002-01-01").cast("timestamp_ntz")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    writers.land(readers.wrap_envelope(o, "shop", "orders", "polling", at), path, "shop", "orders", at)
    schema = (
        f"_metadata {readers.METADATA_DDL}, "
        "data struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>, entity string"
    )
    rows, _ = readers.split_corrupt(readers.read_json(spark, path, schema))
    return rows.select("data.*", F.col("_metadata.client_id").alias("client_id"), "entity")


@query(
    "text_roundtrip",
    "SELECT event_id, event_type FROM events",
)
def text_roundtrip(spark, sf):
    path = scratch_path(spark, "text")
    writers.write_text(table(spark, sf, "events").select("event_id", "event_type"), path)
    raw = spark.read.text(path)
    return raw.select(F.from_json("value", "event_id bigint, event_type string").alias("r")).select("r.*")


@query(
    "csv_roundtrip",
    "SELECT CAST(s_suppkey AS VARCHAR) AS key, s_name AS info_name, '[1,2]' AS tags FROM supplier",
)
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    s = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"), F.struct(F.col("s_name").alias("name")).alias("info"),
        F.array(F.lit(1), F.lit(2)).alias("tags"),
    )
    writers.write_csv(s, path)
    return spark.read.option("header", True).csv(path)


@query(
    "export_manifest",
    "SELECT CAST(sum(1) AS BIGINT) AS rows, 'o_totalprice > 1000' AS where_clause FROM orders WHERE o_totalprice > 1000",
)
def export_manifest(spark, sf):
    path = scratch_path(spark, "export")
    o = table(spark, sf, "orders")
    manifest = writers.export_with_manifest(o, path, 4, "o_orderkey", "o_totalprice > 1000")
    return manifest.groupBy("where_clause").agg(F.sum("rows").alias("rows"))


@query(
    "partitioned_extract",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice > 100000",
)
def partitioned_extract(spark, sf):
    o = table(spark, sf, "orders")
    return readers.extract_partitioned(spark, o, "o_orderkey", 0, 15000, 8, "o_totalprice > 100000").select(
        "o_orderkey", "o_custkey"
    )


@query(
    "initial_load",
    """
    SELECT 'initial_load' AS source, o_orderkey, c_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0
    WHERE o_orderdate >= TIMESTAMP '1999-01-01'
    """,
)
def initial_load(spark, sf):
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").filter("c_acctbal > 0")
    wrapped = readers.initial_load(
        o, c, F.col("o_custkey") == F.col("c_custkey"), "o_orderdate", "1999-01-01", "shop", "orders",
        F.lit("2002-01-01").cast("timestamp_ntz"),
    )
    return wrapped.select(F.col("_metadata.source").alias("source"), "data.o_orderkey", "data.c_name")


@query(
    "multi_table_read",
    """
    SELECT c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier
    """,
)
def multi_table_read(spark, sf):
    stacked = readers.read_many(spark, [f"{sf}/customer.parquet", f"{sf}/supplier.parquet"])
    return stacked.select(F.coalesce("c_custkey", "s_suppkey").alias("key"), F.coalesce("c_name", "s_name").alias("name"))


@query(
    "staged_load",
    f"""
    WITH {_BATCH}
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)
    UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM s
    """,
)
def staged_load(spark, sf):
    """Stage the batch, refuse it if a key is null or repeated, then upsert from the stage."""
    target, batch = target_and_source(spark, sf)
    out = scratch_path(spark, "warehouse")

    def checks(staged):
        if not staged.filter("o_orderkey is null").isEmpty() or not pk_violations(staged, ["o_orderkey"]).isEmpty():
            raise ValueError("the staged batch has null or repeated keys")

    def load(staged):
        writers.full_replace(tables.upsert(target, staged, ["o_orderkey"]).drop("o_orderdate"), out)

    writers.staged_load(batch, scratch_path(spark, "stage"), checks, load)
    return readers.read_parquet(spark, out)


@query("compact_roundtrip", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem")
def compact_roundtrip(spark, sf):
    """Many small files become few of the wanted size."""
    small, big = scratch_path(spark, "small"), scratch_path(spark, "big")
    table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").repartition(16).write.parquet(small)
    tables.compact(spark, small, big)
    return readers.read_parquet(spark, big)


@query(
    "day_window",
    "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS day FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-02-01' AND TIMESTAMP '1996-02-29'",
)
def day_window(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", clock.day_key(F.col("o_orderdate")).alias("day"))
    return readers.day_window(o, "day", 19960201, 19960229)


@query(
    "local_day_pruning",
    """
    SELECT event_id FROM events WHERE epoch_us(ts) // 1000000 >= 1705294800 AND epoch_us(ts) // 1000000 < 1705554000
    """,
)
def local_day_pruning(spark, sf):
    """Whole local days as bounds on the raw epoch, in place of a filter on formatted days."""
    lo, hi = clock.local_bounds("2024-01-15", "2024-01-17")
    e = table(spark, sf, "events").select("event_id", clock.to_epoch(F.col("ts")).alias("epoch"))
    return e.filter((F.col("epoch") >= lo) & (F.col("epoch") < hi)).select("event_id")


@query(
    "audit_append",
    """
    SELECT md5('events|' || CAST(event_id AS VARCHAR) || '|range:value') AS issue_id, 'events' AS table_name,
           CAST(event_id AS VARCHAR) AS record_id, 'range:value' AS validation_rule FROM events WHERE value > 20
    """,
)
def audit_append(spark, sf):
    root = scratch_path(spark, "audit")
    paths = writers.create_audit_tables(spark, root)
    issues = quality.issue_rows(
        table(spark, sf, "events"), RuleSet(ranges={"value": (None, 20)}), "events", "event_id",
        F.lit("2026-01-01").cast("timestamp"),
    )
    writers.append_audit(issues, root, "data_quality_issues")
    return readers.read_parquet(spark, paths["data_quality_issues"]).select(
        "issue_id", "table_name", "record_id", "validation_rule"
    )


@query(
    "watermark_advance",
    """
    SELECT event_type AS entity, CAST(max(epoch_us(ts) // 1000000) AS BIGINT) AS watermark FROM events
    WHERE epoch_us(ts) // 1000000 < 1705276800 GROUP BY 1
    UNION ALL SELECT 'all', CAST(max(epoch_us(ts) // 1000000) AS BIGINT) FROM events
    """,
)
def watermark_advance(spark, sf):
    """State by mid-month, with the newest time of all events added."""
    e = table(spark, sf, "events").select(F.col("event_type").alias("entity"), clock.to_epoch(F.col("ts")).alias("at"))
    state = e.filter(F.col("at") < 1705276800).groupBy("entity").agg(F.max("at").alias("watermark"))
    return incremental.advance(state, "all", incremental.next_watermark(e, ["absent", "at"]))


@query(
    "schema_diff",
    """
    WITH a AS (SELECT event_type, CAST(user_id AS VARCHAR) AS u, CASE WHEN max(value) > 20 THEN 'double' ELSE 'int' END AS t
               FROM events WHERE ts < TIMESTAMP '2024-01-10' GROUP BY 1, 2),
    b AS (SELECT event_type, CAST(user_id AS VARCHAR) AS u, CASE WHEN max(value) > 20 THEN 'double' ELSE 'int' END AS t
          FROM events WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY 1, 2)
    SELECT coalesce(a.event_type, b.event_type) AS table_name, coalesce(a.u, b.u) AS column_name,
           CASE WHEN a.t IS NULL THEN 'ADD' WHEN b.t IS NULL THEN 'DROP' ELSE 'TYPE' END AS change_type,
           a.t AS old_type, b.t AS new_type
    FROM a FULL JOIN b ON a.event_type = b.event_type AND a.u = b.u
    WHERE a.t IS NULL OR b.t IS NULL OR a.t <> b.t
    """,
)
def schema_diff(spark, sf):
    """Column catalogs drawn from the events of two periods."""
    e = table(spark, sf, "events")
    cut = F.lit("2024-01-10").cast("timestamp_ntz")

    def catalog(rows):
        kind = F.when(F.max("value") > 20, "double").otherwise("int")
        return rows.groupBy(
            F.col("event_type").alias("table"), F.col("user_id").cast("string").alias("column")
        ).agg(kind.alias("type"))

    return tables.schema_diff(catalog(e.filter(F.col("ts") < cut)), catalog(e.filter(F.col("ts") >= cut)))


@query(
    "schema_evolution",
    """
    SELECT o_orderkey AS id, o_orderstatus AS status, NULL::VARCHAR AS extra FROM orders
    UNION ALL SELECT c_custkey, NULL, c_mktsegment FROM customer
    """,
)
def schema_evolution(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("extra"))
    return tables.append_evolving(o, c)
