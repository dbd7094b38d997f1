"""Session settings that suit both a laptop and a large cluster."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # The JVM does not compile methods over 8000 bytes; wide projections then run in smaller methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


_LOCAL_DIRS: dict[str, str] = {}


def builder(app_name: str = "tributary") -> SparkSession.Builder:
    b = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    parts = shuffle_partitions or (8 if cores == "*" else int(cores))
    return (
        builder("tributary-local")
        .master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder before running on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def storable(df) -> bool:
    """Whether Parquet can hold every column: columns without a type, at any depth, and calendar intervals cannot be written."""
    return not re.search(r'"(type|elementType|keyType|valueType)":"(void|interval)"', df.schema.json())


def materialize(df, label: str = "stage", path: str | None = None):
    """Write ``df`` once and read it back.

    Used where a later step must see exactly the rows an earlier step saw. The
    written copy survives the loss of any executor. Without ``path`` it goes to
    a new place in the shared folder; a job that repeats gives its own path,
    which is then overwritten each time.
    """
    target = path or scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)
