"""Changing a table: upsert, replace, as-of reads and layout, on plain files.

Functions on DataFrames say what the table becomes; functions with a path do
it while touching only the partitions involved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.operators.windows import top_per_key


def _without_keys(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key does not occur in ``source``; null keys are equal to each other."""
    gone = source.select(*[F.col(f"`{k}`").alias(f"_gone_{k}") for k in keys]).distinct()
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"`_gone_{k}`"))
    return target.join(gone, same, "left_anti")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Source rows replace target rows with the same key; others are added.

    Of several source rows with one key the first by ``order`` counts, and without an order the one with the
    smallest row hash. Null keys are equal to each other. Columns new to the source are added to the table with
    nulls for old rows.
    """
    hashable = [f"`{f.name}`" for f in source.schema.fields if not f.dataType.simpleString().startswith("map")]
    single = top_per_key(source, keys, [*(order or []), F.xxhash64(*hashable)])
    return _without_keys(target, source, keys).unionByName(single, allowMissingColumns=True)


def replace_range(target: DataFrame, source: DataFrame, column: str, low, high) -> DataFrame:
    """Delete ``low ≤ column ≤ high``, then insert. Rows with a null column stay."""
    gone = F.coalesce(F.col(column).between(low, high), F.lit(False))
    return target.filter(~gone).unionByName(source)


def replace_keys(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Delete every row whose key occurs in the source, then insert all source rows."""
    return _without_keys(target, source, keys).unionByName(source)


def merge_into(spark: SparkSession, table: str, source: DataFrame, keys: list[str]) -> None:
    """MERGE for tables of a catalog that supports it."""
    view = f"_merge_{abs(hash(table))}"
    source.createOrReplaceTempView(view)
    on = " AND ".join(f"t.`{k}` <=> s.`{k}`" for k in keys)
    sets = ", ".join(f"t.`{c}` = s.`{c}`" for c in source.columns if c not in keys)
    names = ", ".join(f"`{c}`" for c in source.columns)
    values = ", ".join(f"s.`{c}`" for c in source.columns)
    spark.sql(
        f"MERGE INTO {table} t USING {view} s ON {on} "
        f"WHEN MATCHED THEN UPDATE SET {sets} WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def _touched(source: DataFrame, by: list[str]) -> Column:
    """Filter for the partitions the source touches, as literals so the scan prunes.

    The list is as long as the table has partitions, not rows.
    """
    rows = source.select(*by).distinct().collect()
    if len(by) == 1:
        values = [r[0] for r in rows if r[0] is not None]
        condition = F.col(by[0]).isin(values)
        return condition | F.col(by[0]).isNull() if len(values) < len(rows) else condition
    condition = F.lit(False)
    for r in rows:
        one = F.lit(True)
        for c in by:
            one = one & F.col(c).eqNullSafe(F.lit(r[c]))
        condition = condition | one
    return condition


def upsert_path(
    spark: SparkSession, path: str, source: DataFrame, keys: list[str], by: list[str], moving: bool = False
) -> None:
    """Upsert into partitioned Parquet: only the partitions involved are rewritten.

    Normally the partition follows from the key (an order's creation day does), and the partitions of the source are
    those involved. Where a record may change its partition, say ``moving``: the keys of the whole table are then read
    to find the partitions that hold the source's keys now, and those are rewritten too.
    """
    from tributary.session import materialize

    source = materialize(source, "upsert-source")
    table = spark.read.parquet(path)
    involved = source.select(*by).distinct()
    if moving:
        wanted = source.select(*[F.col(f"`{k}`").alias(f"_w_{k}") for k in keys]).distinct()
        same = F.lit(True)
        for k in keys:
            same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"`_w_{k}`"))
        held = table.select(*dict.fromkeys([*keys, *by])).join(wanted, same, "left_semi").select(*by).distinct()
        involved = involved.unionByName(held)
    old = table.filter(_touched(involved, by))
    merged = materialize(upsert(old, source, keys), "upsert-merged")
    # A partition that loses its last record gets no rows to overwrite it with.
    emptied = stale_partitions(spark, path, merged, by, _touched(involved, by)) if moving else []
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    _remove(spark, emptied)


def stale_partitions(spark: SparkSession, path: str, source: DataFrame, by: list[str], inside: Column) -> list[str]:
    """Folders of the partitions that ``inside`` selects and that ``source`` has no row for.

    Partition values come from the layout, so no data column is read; the list is as long as the range has partitions.
    """
    table = spark.read.parquet(path)
    here = table.filter(inside).select(*[F.col(f"`{c}`") for c in by], F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("_folder"))
    filled = source.select(*[F.col(f"`{c}`").cast(table.schema[c].dataType).alias(f"_f_{c}") for c in by]).distinct()
    same = F.lit(True)
    for c in by:
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"`_f_{c}`"))
    return sorted(r[0] for r in here.distinct().join(filled, same, "left_anti").select("_folder").distinct().collect())


def _remove(spark: SparkSession, folders: list[str]) -> None:
    """Remove folders through Spark's own file system client."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        place = jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(conf).delete(place, True)


def replace_range_path(spark: SparkSession, path: str, source: DataFrame, by: list[str], inside: Column | None = None) -> list[str]:
    """Replace the partitions of a range by the source's rows; returns the folders that became empty and were removed.

    ``inside`` is a condition on the partition columns, such as days of a window. Source rows outside it are an error.
    The source is staged first and written before anything is removed, so a failure leaves old rows, never a
    hole, and the next run settles it. Without ``inside`` only the partitions of the source change.
    """
    from tributary.session import materialize

    if inside is None:
        source.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
        return []
    source = materialize(source, "range-source")
    outside = source.filter(~F.coalesce(inside, F.lit(False))).limit(1).count()
    if outside:
        raise ValueError("source rows outside the range that is replaced")
    stale = stale_partitions(spark, path, source, by, inside)
    source.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    _remove(spark, stale)
    return stale


def as_of(history: DataFrame, keys: list[str], ts_col: str, ts, tie: list[Column] | None = None) -> DataFrame:
    """Latest version of each key that had arrived by ``ts``."""
    seen = history.filter(F.col(ts_col) <= F.lit(ts))
    return top_per_key(seen, keys, [F.col(ts_col).desc(), *(tie or [])])


def compact(
    spark: SparkSession, source: str, target: str, target_bytes: int = 128 * 1024 * 1024, by: list[str] | None = None
) -> int:
    """Rewrite many small files as few of about ``target_bytes``; returns the least number of files that takes.

    ``by`` names the partition columns of a partitioned table, which the copy keeps; adaptive execution then splits
    large partitions and joins small ones, so a hot partition is not written by one task.
    """
    df = spark.read.parquet(source)
    sizes = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.parquet"
    ).load(source)
    total = sizes.agg(F.sum("length")).first()[0] or 0
    files = max(1, -(-total // target_bytes))
    if by:
        df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(target)
    else:
        df.repartition(files).write.mode("overwrite").parquet(target)
    return files


SMALL_BYTES = 64 * 1024 * 1024
TARGET_BYTES = 128 * 1024 * 1024


def data_files(spark: SparkSession, path: str, by: list[str] | None = None) -> DataFrame:
    """``file``, ``bytes`` and the partition columns of every data file, from the listing; no content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.select(*[F.col(f"`{c}`") for c in by or []], F.col("path").alias("file"), F.col("length").alias("bytes"))


def compaction_plan(files: DataFrame, by: list[str] | None = None, target_bytes: int = TARGET_BYTES, small_bytes: int = SMALL_BYTES) -> DataFrame:
    """``file`` and ``bin``: small files packed into bins of at most ``target_bytes``, each within one partition.

    Files of ``small_bytes`` or more are left alone, and so is a small file that would be alone in its bin. A bin is
    filled up to half the target by files that each fit in the other half, so none overflows and all but the last of a
    partition are at least a quarter full. The plan has one row per small file, not per row of data.
    """
    parts = [F.col(f"`{c}`") for c in by or []]
    small = files.filter(F.col("bytes") < F.least(F.lit(small_bytes), F.lit(target_bytes // 2)))
    upto = Window.partitionBy(*parts).orderBy("bytes", "file").rowsBetween(Window.unboundedPreceding, -1)
    placed = small.withColumn("_slot", F.floor(F.coalesce(F.sum("bytes").over(upto), F.lit(0)) / (target_bytes // 2)).cast("bigint"))
    named = placed.select("file", F.concat_ws("/", *[F.coalesce(c.cast("string"), F.lit("null")) for c in parts], F.col("_slot").cast("string")).alias("bin"))
    return named.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("bin"))).filter("_n > 1").drop("_n")


def compact_partitioned(
    spark: SparkSession, source: str, target: str, by: list[str] | None = None, target_bytes: int = TARGET_BYTES, small_bytes: int = SMALL_BYTES
) -> DataFrame:
    """Write the small files' rows of ``source`` to ``target``, one file a bin; returns the plan (``file``, ``bin``).

    ``target`` then holds what takes the place of the files named; large files stay where they are and are not read.
    Which copy readers use is the catalog's decision, so both exist until the named files are removed.
    """
    from tributary.session import materialize

    plan = materialize(compaction_plan(data_files(spark, source, by), by, target_bytes, small_bytes), "compaction")
    bins = plan.select("bin").distinct().count()
    rows = spark.read.option("basePath", source).parquet(source)
    names = rows.columns
    marked = rows.withColumn("_file", F.col("_metadata.file_path"))
    packed = marked.join(plan, F.col("_file") == F.col("file")).drop("_file", "file")
    out = packed.repartition(max(1, bins), "bin").sortWithinPartitions(*(by or ["bin"])).select(*names)
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*by) if by else writer).parquet(target)
    return plan


def date_partitions(df: DataFrame, column: str, parts: tuple[str, ...] = ("year", "month", "day")) -> DataFrame:
    """Partition columns from the event's own date."""
    builders = {"year": F.year, "month": F.month, "day": F.dayofmonth}
    return df.withColumns({p: builders[p](F.col(column)) for p in parts})


def partition_stats(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))


def schema_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """ADD, DROP and TYPE rows between two column catalogs (table, column, type)."""
    a = old.withColumnRenamed("type", "old_type")
    b = new.withColumnRenamed("type", "new_type")
    change = (
        F.when(F.col("old_type").isNull(), F.lit("ADD"))
        .when(F.col("new_type").isNull(), F.lit("DROP"))
        .when(F.col("old_type") != F.col("new_type"), F.lit("TYPE"))
    )
    joined = a.join(b, ["table", "column"], "full").withColumn("change_type", change)
    return joined.filter("change_type is not null").select(
        F.col("table").alias("table_name"), "change_type", F.col("column").alias("column_name"), "old_type", "new_type"
    )


def schema_change_log(diff: DataFrame, at: Column) -> DataFrame:
    ident = F.md5(F.concat_ws("|", "table_name", "change_type", "column_name"))
    return diff.select(ident.alias("change_id"), *diff.columns, at.alias("timestamp"))


def append_evolving(target: DataFrame, source: DataFrame) -> DataFrame:
    """Append where either side may lack columns."""
    return target.unionByName(source, allowMissingColumns=True)
