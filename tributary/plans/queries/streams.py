"""Streaming jobs drained to the end and read back as tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions import clock
from tributary.functions.money import ratio
from tributary.plans.registry import query, table
from tributary.session import scratch_path
from tributary.streaming import jobs


def event_stream(spark, sf):
    """The events file as a stream; the event time becomes an instant."""
    schema = table(spark, sf, "events").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return raw.withColumn("ts", clock.utc_instant(F.col("ts")))


def _seconds(c):
    return F.unix_seconds(c)


@query(
    "stream_tumbling",
    """
    SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) // 1000000 AS window_start, event_type, count(*) AS rows,
           CAST(sum(CASE WHEN value > 20 THEN 1 ELSE 0 END) AS BIGINT) AS errors
    FROM events GROUP BY 1, 2
    """,
)
def stream_tumbling(spark, sf):
    out = scratch_path(spark, "tumbling")
    counts = jobs.stream_window_counts(
        event_stream(spark, sf), "ts", "1 hour", by=["event_type"], errors=F.count_if(F.col("value") > 20)
    )
    jobs.save_updates(counts, out, out + "-checkpoint").awaitTermination()
    final = jobs.latest_windows(spark, out, ["window_start", "event_type"])
    return final.select(_seconds(F.col("window_start")).alias("window_start"), "event_type", "rows", "errors")


@query(
    "stream_dedup",
    "SELECT user_id, event_type, count(*) AS copies FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY ALL",
)
def stream_dedup(spark, sf):
    """Watermark longer than the data: the first copy of every key and no other."""
    out = scratch_path(spark, "dedup")
    first = jobs.stream_dedup(event_stream(spark, sf), ["user_id", "event_type"], "ts", "60 days")
    writer = first.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-checkpoint")
    jobs.triggered(writer, None).start().awaitTermination()
    return spark.read.parquet(out).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("copies"))


@query(
    "stream_upsert",
    """
    SELECT user_id, event_type, event_id, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS n FROM events) WHERE n = 1
    """,
)
def stream_upsert(spark, sf):
    out = scratch_path(spark, "silver")
    stream = event_stream(spark, sf).select("user_id", "event_id", "value", "event_type")
    jobs.stream_upsert(
        stream, out, ["user_id", "event_type"], "event_id", ["event_type"], out + "-checkpoint", None
    ).awaitTermination()
    return spark.read.parquet(out)


@query(
    "stream_freshness",
    """
    SELECT CAST(epoch_us(TIMESTAMP '2024-01-31 00:05:00') // 1000000 - epoch_us(max(ts)) // 1000000 AS BIGINT) AS lag_seconds,
           epoch_us(TIMESTAMP '2024-01-31 00:05:00') // 1000000 - epoch_us(max(ts)) // 1000000 <= 900 AS fresh FROM events
    """,
)
def stream_freshness(spark, sf):
    e = table(spark, sf, "events")
    return jobs.freshness_lag(e, "ts", F.lit("2024-01-31 00:05:00").cast("timestamp_ntz"))


@query(
    "stream_land",
    """
    SELECT 'data' AS part, event_id, 'shop' AS client, 'events' AS entity FROM events WHERE event_type <> 'error'
    UNION ALL SELECT 'errors', event_id, NULL, NULL FROM events WHERE event_type = 'error'
    """,
)
def stream_land(spark, sf):
    """Events as JSON lines, those of errors cut short: good lines land in Bronze, broken ones apart."""
    src, out = scratch_path(spark, "landing"), scratch_path(spark, "bronze")
    line = F.to_json(F.struct("event_id", "user_id"))
    cut = F.concat(F.lit("{"), F.col("event_id").cast("string"))
    lines = table(spark, sf, "events").select(F.when(F.col("event_type") == "error", cut).otherwise(line).alias("value"))
    lines.write.text(src)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType())])
    jobs.stream_land(spark, src, schema, out, out + "-checkpoint", "shop", "events", None).awaitTermination()
    data = spark.read.parquet(f"{out}/data").select(F.lit("data").alias("part"), "data.event_id", "client", "entity")
    broken = spark.read.parquet(f"{out}/errors").select(
        F.lit("errors").alias("part"), F.substring("record", 2, 20).cast("bigint").alias("event_id")
    )
    return data.unionByName(broken, allowMissingColumns=True)


@query(
    "stream_rates",
    """
    SELECT epoch_us(time_bucket(INTERVAL 1 DAY, ts)) // 1000000 AS day, count(*) AS rows,
           CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS error_rate
    FROM events GROUP BY 1
    """,
)
def stream_rates(spark, sf):
    """Rows and error share per day, kept up to date by a stream."""
    out = scratch_path(spark, "rates")
    counts = jobs.stream_window_counts(
        event_stream(spark, sf), "ts", "1 day", errors=F.count_if(F.col("event_type") == "error")
    )
    jobs.save_updates(counts, out, out + "-checkpoint").awaitTermination()
    final = jobs.latest_windows(spark, out, ["window_start"])
    return final.select(
        _seconds(F.col("window_start")).alias("day"), "rows", ratio(F.col("errors"), F.col("rows")).alias("error_rate")
    )


@query(
    "stream_late_rows",
    """
    WITH s AS (SELECT *, ts >= TIMESTAMP '2024-01-16 00:00:00' AS first_batch, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS ends,
                      (SELECT max(ts) FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00') AS newest FROM events)
    SELECT event_type, CASE WHEN NOT first_batch AND ends <= newest - INTERVAL 20 MINUTE THEN 'late' ELSE 'on time' END AS arrival,
           CAST(count(*) AS BIGINT) AS rows
    FROM s GROUP BY 1, 2
    """,
)
def stream_late_rows(spark, sf):
    """The later half of the events arrives first, so the earlier half is late; both together are all rows."""
    e = table(spark, sf, "events").select("event_id", "event_type", "ts")
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "counts")
    for half in ("ts >= '2024-01-16 00:00:00'", "ts < '2024-01-16 00:00:00'"):
        # One file is one batch here; files are taken in the order of their times.
        e.filter(half).coalesce(1).write.mode("append").parquet(landing)
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    jobs.stream_counts_keeping_late(stream, "ts", out, scratch_path(spark, "checkpoint"), by=["event_type"], trigger=None).awaitTermination()
    on_time = jobs.on_time_counts(spark, out, ["event_type"]).groupBy("event_type").agg(F.sum("rows").alias("rows"))
    late = jobs.late_rows(spark, out).groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))
    return on_time.withColumn("arrival", F.lit("on time")).unionByName(late.withColumn("arrival", F.lit("late"))).select("event_type", "arrival", "rows")
