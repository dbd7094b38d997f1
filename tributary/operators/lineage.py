"""Where rows came from, whether they changed, and how long each stage took."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tributary.functions.money import ratio
from tributary.session import materialize


def row_hash(df: DataFrame, null_mark: str | None = None) -> Column:
    """md5 of the ``|``-joined business columns (names without a leading ``_``).

    Nulls are skipped; give ``null_mark`` to tell a null from an absent value.
    """
    names = [c for c in df.columns if not c.startswith("_")]
    if not names:
        return F.lit("no_business_cols")
    values = [F.col(f"`{c}`").cast("string") for c in names]
    if null_mark is not None:
        values = [F.coalesce(v, F.lit(null_mark)) for v in values]
    return F.md5(F.concat_ws("|", *values))


def add_lineage(df: DataFrame, pipeline_id: str, source: str, as_of: Column, track_hash: bool = True) -> DataFrame:
    added = {
        "_lineage_pipeline_id": F.lit(pipeline_id),
        "_lineage_source": F.lit(source),
        "_lineage_timestamp": as_of,
    }
    if track_hash:
        added["_lineage_record_hash"] = row_hash(df)
    return df.withColumns(added)


def _exact_hash(df: DataFrame) -> Column:
    """md5 of the business columns, each with its length before it, so that nulls and separators cannot shift values."""
    names = [c for c in df.columns if not c.startswith("_")]
    if not names:
        return F.md5(F.lit(""))
    values = [F.col(f"`{c}`").cast("string") for c in names]
    marked = [F.coalesce(F.concat(F.length(v), F.lit(":"), v), F.lit("-")) for v in values]
    return F.md5(F.concat_ws("|", *marked))


def hash_changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Keys added, removed or changed between two versions with unique keys."""
    a = old.select(*keys, _exact_hash(old).alias("_old"))
    b = new.select(*keys, _exact_hash(new).alias("_new"))
    state = (
        F.when(F.col("_old").isNull(), F.lit("added"))
        .when(F.col("_new").isNull(), F.lit("removed"))
        .when(F.col("_old") != F.col("_new"), F.lit("changed"))
        .otherwise(F.lit("same"))
    )
    return a.join(b, keys, "full").select(*keys, state.alias("change")).filter("change <> 'same'")


class StageMeter:
    """Row counts of each stage, taken while the data flows to its sink.

    ``observe`` rides on the job that writes the result, so no stage is counted
    by running it again.
    """

    def __init__(self, pipeline_id: str):
        self.pipeline_id = pipeline_id
        self._seen: list[tuple[str, Observation]] = []
        #: Start and length of staged stages, by position.
        self._clock: dict[int, tuple[float, float]] = {}

    def watch(self, df: DataFrame, stage: str) -> DataFrame:
        seen = Observation(f"{self.pipeline_id}:{len(self._seen)}:{stage}")
        self._seen.append((stage, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def timed(self, df: DataFrame, stage: str, path: str | None = None) -> DataFrame:
        """Count a stage and measure it: the rows are staged, and the clock runs around that write.

        Spark runs unstaged operators together, so only what lies between two staged copies has a duration of its own.
        """
        position = len(self._seen)
        watched = self.watch(df, stage)
        started = time.time()
        begin = time.perf_counter()
        staged = materialize(watched, f"stage-{position}", path)
        self._clock[position] = (started, time.perf_counter() - begin)
        return staged

    def report(self, spark, at: Column, status: str = "success") -> DataFrame:
        """One row per stage: in, out, dropped and drop rate. Call after the write."""
        counts = [(n, s, o.get["rows"]) for n, (s, o) in enumerate(self._seen)]
        rows = []
        for n, stage, out in counts:
            came = counts[n - 1][2] if n else out
            rows.append((self.pipeline_id, n, stage, came, out, *self._clock.get(n, (None, None))))
        df = spark.createDataFrame(
            rows,
            "pipeline_id string, position int, stage string, records_in bigint, records_out bigint, "
            "started_epoch double, duration_seconds double",
        )
        dropped = F.col("records_in") - F.col("records_out")
        return df.withColumns(
            {
                "records_dropped": dropped,
                "drop_rate": F.coalesce(ratio(dropped, F.col("records_in")), F.lit(0.0)),
                "status": F.lit(status),
                "timestamp": at,
            }
        )


def write_report(report: DataFrame, path: str, run: str) -> None:
    """Add a run's report to the table of reports; a repeated run replaces its own."""
    materialize(report.withColumn("run", F.lit(run)).coalesce(1), path=f"{path}/{run}")


def read_reports(spark, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").parquet(path)


def slowest(metrics: DataFrame, k: int, column: str = "duration_seconds") -> DataFrame:
    """The ``k`` longest runs; this limit is the report itself."""
    return metrics.orderBy(F.col(column).desc(), *[c for c in metrics.columns if c != column]).limit(k)
