"""Landing files, upserts, deduplication and live counts.

Each batch's output is keyed by its batch id or by its rows' keys, so a batch
that is replayed after a failure overwrites itself instead of adding twice.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tributary.functions.clock import to_epoch, utc_now
from tributary.operators.dedup import resolve_conflicts
from tributary.operators.tables import _touched
from tributary.session import materialize
from tributary.sources.readers import CORRUPT, parse_lines

BUFFER = "300 seconds"
MAX_FRESHNESS_SECONDS = 900


def triggered(writer, trigger: str | None):
    """``None`` drains what is there and stops; otherwise the buffer interval."""
    return writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)


def read_landing(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return parse_lines(spark.readStream.text(path), schema)


def stream_land(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    out: str,
    checkpoint: str,
    client: str,
    entity: str,
    trigger: str | None = BUFFER,
) -> StreamingQuery:
    """Files to Bronze under client and entity; broken lines go to ``<out>/errors``."""

    def save(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            broken = F.col(CORRUPT).isNotNull()
            good = kept.filter(~broken).drop(CORRUPT)
            envelope = good.select(
                F.struct(
                    F.lit(client).alias("client_id"),
                    F.lit(entity).alias("entity_type"),
                    F.date_format(utc_now(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ingestion_timestamp"),
                    F.lit("webhook").alias("source"),
                ).alias("_metadata"),
                F.struct(*[F.col(f"`{c}`") for c in good.columns]).alias("data"),
                F.lit(client).alias("client"),
                F.lit(entity).alias("entity"),
                F.lit(batch_id).alias("batch"),
            )
            writer = envelope.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("client", "entity", "batch").parquet(f"{out}/data")
            errors = kept.filter(broken).select(
                F.col(CORRUPT).alias("record"), F.lit("CORRUPT_JSON").alias("_dlq_reason"), F.lit(batch_id).alias("batch")
            )
            errors.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(
                f"{out}/errors"
            )
        finally:
            kept.unpersist()

    writer = read_landing(spark, path, schema).writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return triggered(writer, trigger).start()


def stream_dedup(stream: DataFrame, keys: list[str], ts: str, delay: str = "20 minutes") -> DataFrame:
    """First copy of each key; copies later than ``delay`` are outside the overlap and pass."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def upsert_latest(old: DataFrame, new: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """Newest version per key of both; an older late copy never replaces a newer one."""
    return resolve_conflicts(old.unionByName(new, allowMissingColumns=True), keys, order_col)


def stream_upsert(
    stream: DataFrame,
    target: str,
    keys: list[str],
    order_col: str,
    by: list[str],
    checkpoint: str,
    trigger: str | None = BUFFER,
) -> StreamingQuery:
    """Keep ``target`` at the latest version per key; only touched partitions are rewritten.

    Each batch is staged beside the table before it replaces anything, in two
    folders that the next batch overwrites.
    """
    staging = target.rstrip("/") + "_staging"

    def save(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        newest = materialize(resolve_conflicts(batch, keys, order_col), path=f"{staging}/batch")
        if newest.isEmpty():
            return
        try:
            table = spark.read.option("mergeSchema", "true").parquet(target)
        except AnalysisException as missing:  # the table does not exist before the first batch
            if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            table = None
        merged = newest
        if table is not None:
            # Columns that the batch lacks stay; those it has are read with its types (a partition's are inferred).
            kinds = dict(newest.dtypes)
            old = table.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in table.columns])
            merged = materialize(upsert_latest(old.filter(_touched(newest, by)), newest, keys, order_col), path=f"{staging}/merged")
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(target)

    writer = stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return triggered(writer, trigger).start()


def stream_window_counts(
    stream: DataFrame,
    ts: str,
    every: str = "5 minutes",
    delay: str = "20 minutes",
    by: list[str] | None = None,
    **metrics: Column,
) -> DataFrame:
    """Counts (and rates) per tumbling window."""
    grouped = stream.withWatermark(ts, delay).groupBy(F.window(ts, every), *(by or []))
    counted = grouped.agg(F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()])
    return counted.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *(by or []), "rows", *metrics,
    )


def _batch_rows(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """What earlier batches wrote below ``path``; None if there is nothing."""
    try:
        rows = spark.read.option("recursiveFileLookup", "true").parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return rows if before is None else rows.filter(F.col("_batch") < before)


def stream_counts_keeping_late(
    stream: DataFrame,
    ts: str,
    out: str,
    checkpoint: str,
    every: str = "5 minutes",
    delay_seconds: int = 1200,
    by: list[str] | None = None,
    trigger: str | None = BUFFER,
) -> StreamingQuery:
    """Counts per tumbling window, with the rows that come after their window has closed kept in a table of their own.

    A built-in windowed aggregate drops such rows without a trace. Here a batch's watermark is the newest time of all
    earlier batches less the delay; a row is late if its window ended by then. Each batch writes three parts under its
    number: partial counts of the rows on time, the late rows whole, and its newest time. A replayed batch sees the same
    earlier batches, so it overwrites its parts with the same rows. ``on_time_counts`` merges the partial counts. Rows
    without a time count as late, as no window is theirs.
    """
    by = by or []

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = _batch_rows(spark, f"{out}/newest", batch_id)
        # As text of the session, so that no other clock comes between.
        newest = seen.agg(F.max("newest").cast("string")).first()[0] if seen is not None else None
        # F.window leaves out rows without a time.
        placed = batch.withColumn("_window", F.window(ts, every))
        no_time = batch.filter(F.col(ts).isNull()).withColumn("_window", F.lit(None).cast(placed.schema["_window"].dataType))
        closed = F.lit(False)
        if newest is not None:
            closed = F.col("_window.end") <= F.timestamp_add("SECOND", F.lit(-delay_seconds), F.lit(newest).cast(batch.schema[ts].dataType))
        judged = placed.withColumn("_late", closed).unionByName(no_time.withColumn("_late", F.lit(True)))
        staged = materialize(judged, path=f"{out}/staging")
        counts = staged.filter("not _late").groupBy(F.col("_window.start").alias("window_start"), *by).agg(F.count(F.lit(1)).alias("rows"))
        parts = {
            "windows": counts,
            "late": staged.filter("_late").drop("_window", "_late"),
            "newest": staged.agg(F.max(ts).alias("newest")),
        }
        for name, rows in parts.items():
            materialize(rows.withColumn("_batch", F.lit(batch_id)), path=f"{out}/{name}/{batch_id}")

    writer = stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return triggered(writer, trigger).start()


def on_time_counts(spark: SparkSession, out: str, by: list[str] | None = None) -> DataFrame:
    """Rows per window of everything that came on time so far."""
    return _batch_rows(spark, f"{out}/windows").groupBy("window_start", *(by or [])).agg(F.sum("rows").alias("rows"))


def late_rows(spark: SparkSession, out: str) -> DataFrame:
    """The late rows as they came, with the number of their batch in ``_batch``."""
    return _batch_rows(spark, f"{out}/late")


def save_updates(counts: DataFrame, out: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Write changed windows of every batch; ``latest_windows`` reads the current state."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch").parquet(out)

    writer = counts.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint)
    return triggered(writer, trigger).start()


def latest_windows(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    from tributary.operators.windows import top_per_key

    return top_per_key(spark.read.parquet(out), keys, [F.col("batch").desc()]).drop("batch")


def freshness_lag(df: DataFrame, ts: str, now: Column, limit: int = MAX_FRESHNESS_SECONDS) -> DataFrame:
    """Seconds between the newest event and ``now``, and whether that is within the limit."""
    lag = to_epoch(now) - to_epoch(F.max(ts))
    return df.agg(lag.alias("lag_seconds")).withColumn("fresh", F.col("lag_seconds") <= limit)
