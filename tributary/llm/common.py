"""Words, row packing and staging shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tributary.session import materialize

BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of anything but ASCII white space, in order; an empty array for an empty or null text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.filter(F.split(trimmed, BLANK_RUN), lambda w: w != "")


def pack(docs: DataFrame, **own: Column) -> DataFrame:
    """The whole input row in the struct ``row`` and the named columns beside it, so that no input name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in own.items()])


def only_where(df: DataFrame, condition: Column, value: Column, name: str) -> DataFrame:
    """``value`` of the rows that meet a condition computed from earlier projections.

    A plain filter would be pushed below those projections, with their expressions copied into the per-element
    functions and computed again for each element. Spark does not push a filter below the generator used here.
    """
    kept = df.select(F.explode_outer(F.when(condition, F.array(F.struct(value.alias("v"))))).alias("_kept"))
    return kept.filter("_kept IS NOT NULL").select(F.col("_kept.v").alias(name))


#: Spark's setting that drops a query's shuffle files when the query has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back; survives lost executors and cuts the lineage.

    Later steps read the copy, so the shuffle files of the write are dropped with it instead of at some later time.
    """
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return materialize(df, label)
    finally:
        if before is None:
            conf.unset(SHUFFLE_CLEANUP)
        else:
            conf.set(SHUFFLE_CLEANUP, before)


def counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """``stage``, and the number of rows as the write itself saw it."""
    seen = Observation()
    written = stage(df.observe(seen, F.count(F.lit(1)).alias("n")), label)
    return written, seen.get["n"]
