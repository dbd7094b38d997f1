"""Join forms: enrich, dimensions, ranges, adjacency and orphans.

None of them forces a broadcast: Spark broadcasts a side when its measured
size is below the threshold and shuffles otherwise, and adaptive execution
splits skewed partitions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.clock import to_epoch
from tributary.operators.windows import top_per_key
from tributary.session import materialize


def enrich(
    df: DataFrame,
    lookup: DataFrame,
    on: list[str],
    cols: list[str],
    order_by: list[Column],
) -> DataFrame:
    """Overwrite ``cols`` where the lookup has a match, keep the old value otherwise.

    Several lookup rows per key are first reduced to one by ``order_by``.
    """
    one = top_per_key(lookup, on, order_by).select(
        *on, *[F.col(c).alias(f"_new_{c}") for c in cols], F.lit(True).alias("_hit")
    )
    joined = df.join(one, on, "left")
    out = [F.col(c) for c in df.columns if c not in cols]
    for c in cols:
        old = F.col(c) if c in df.columns else F.lit(None)
        out.append(F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(old).alias(c))
    return joined.select(*out)


@dataclass(frozen=True)
class Dimension:
    table: DataFrame
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    how: str = "left"
    prefix: str = ""


def join_dims(df: DataFrame, dims: list[Dimension]) -> DataFrame:
    """Star join; only the wanted columns of each dimension are read."""

    def one(left: DataFrame, d: Dimension) -> DataFrame:
        right = d.table.select(*d.keys, *[F.col(c).alias(d.prefix + c) for c in d.columns])
        return left.join(right, list(d.keys), d.how)

    return reduce(one, dims, df)


def range_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    point: str,
    lo: str,
    hi: str,
    bucket_seconds: int,
    how: str = "inner",
) -> DataFrame:
    """Rows of ``left`` whose time lies in ``[lo, hi)`` of ``right``.

    Time is cut into buckets: each point falls into one, each range is copied
    to those it touches. The join is then an equality on keys and bucket, so it
    hashes, and a busy key is spread over time. Choose the bucket near the usual
    length of a range.
    """
    width = F.lit(bucket_seconds)
    points = left.withColumn("_bucket", F.floor(to_epoch(F.col(point)) / width))
    first = F.floor(to_epoch(F.col(lo)) / width)
    last = F.floor((to_epoch(F.col(hi))) / width)
    valid = F.col(lo).isNotNull() & F.col(hi).isNotNull() & (F.col(hi) > F.col(lo))
    ranges = right.filter(valid).withColumn("_rbucket", F.explode(F.sequence(first, last)))
    ranges = ranges.withColumnsRenamed({k: f"_r_{k}" for k in on})
    condition = (F.col("_bucket") == F.col("_rbucket")) & (F.col(point) >= F.col(lo)) & (F.col(point) < F.col(hi))
    for k in on:
        condition = condition & (points[k] == ranges[f"_r_{k}"])
    return points.join(ranges, condition, how).drop("_bucket", "_rbucket", *[f"_r_{k}" for k in on])


#: Children of a node of the interval tree, as a power of two: wider nodes mean fewer levels but more nodes a level.
FAN_BITS = 2
#: Whole seconds between the years 1 and 9999 and the origin fit below this many.
_SECONDS = 1 << 39


def _levels(bucket_seconds: int) -> int:
    """Levels of the tree over all buckets that times can fall into."""
    buckets, levels = 2 * _SECONDS // bucket_seconds + 2, 1
    while 1 << (FAN_BITS * levels) < buckets:
        levels += 1
    return levels


def cover(first: Column, last: Column, levels: int) -> Column:
    """The fewest nodes (level, place) of the tree whose leaves are the buckets ``first`` to ``last``, both included.

    On each level those of its nodes inside the range that no node of the next level inside the range contains: at most
    2^FAN_BITS - 1 at either end, so the cover grows with the number of levels and not with the length of the range.
    """
    fan = 1 << FAN_BITS

    def inside(level: int) -> tuple[Column, Column]:
        """Nodes wholly in the range, from (included) to (not included)."""
        shift = FAN_BITS * level
        return F.shiftright(first + ((1 << shift) - 1), shift), F.shiftright(last + 1, shift)

    def node_at(level: int):
        return lambda n: F.struct(F.lit(level).alias("level"), n.alias("place"))

    nodes = []
    for level in range(levels + 1):
        low, high = inside(level)
        above_low, above_high = inside(level + 1)
        whole = above_low >= above_high
        ends = [(low, F.when(whole, high).otherwise(above_low * fan)), (F.when(whole, high).otherwise(above_high * fan), high)]
        for start, stop in ends:
            some = F.when(start < stop, F.sequence(start, stop - 1)).otherwise(F.array().cast("array<bigint>"))
            nodes.append(F.transform(some, node_at(level)))
    return F.concat(*nodes)


def range_join_open(
    left: DataFrame, right: DataFrame, on: list[str], point: str, lo: str, hi: str, bucket_seconds: int = 60, how: str = "inner"
) -> DataFrame:
    """Rows of ``left`` whose time lies in ``[lo, hi)`` of ``right``, for ranges of any length, open ones included.

    A null ``lo`` or ``hi`` leaves that end open. Every range becomes the few tree nodes that cover its buckets and
    every point the ancestors of its bucket on the levels that occur in a cover, so a range of years costs as much as
    one of minutes and the join stays an equality. A pair meets in exactly one node; times are compared in
    full afterwards. Points and keys that are null match nothing. ``how`` is ``inner`` or ``left``.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unknown join: {how}")
    levels = _levels(bucket_seconds)
    bucket = lambda c: F.floor((to_epoch(F.col(c)) + F.lit(_SECONDS)) / F.lit(bucket_seconds)).cast("bigint")
    top = (1 << (FAN_BITS * levels)) - 1
    some = F.col(lo).isNull() | F.col(hi).isNull() | (F.col(hi) > F.col(lo))
    first, last = F.coalesce(bucket(lo), F.lit(0).cast("bigint")), F.coalesce(bucket(hi), F.lit(top).cast("bigint"))
    ranges = right.filter(some).withColumns({"_first": first, "_last": last}).withColumn("_node", F.explode(cover(F.col("_first"), F.col("_last"), levels)))
    ranges = ranges.drop("_first", "_last").withColumnsRenamed({k: f"_r_{k}" for k in on})
    # One row per level of the tree at most.
    used = sorted(r[0] for r in ranges.select("_node.level").distinct().collect())
    numbered = left
    if how == "left":
        numbered = materialize(left.withColumn("_row", F.monotonically_increasing_id()), "points")
    leaf = bucket(point)
    ancestors = [F.struct(F.lit(n).alias("level"), F.shiftright(leaf, FAN_BITS * n).alias("place")) for n in used]
    nodes = F.array(*ancestors) if ancestors else F.array().cast("array<struct<level:int,place:bigint>>")
    points = numbered.filter(F.col(point).isNotNull()).withColumn("_at", F.explode(nodes))
    within = (F.col(lo).isNull() | (F.col(point) >= F.col(lo))) & (F.col(hi).isNull() | (F.col(point) < F.col(hi)))
    condition = (F.col("_at") == F.col("_node")) & within
    for k in on:
        condition = condition & (points[k] == ranges[f"_r_{k}"])
    found = points.join(ranges, condition).drop("_at", "_node", *[f"_r_{k}" for k in on])
    if how == "inner":
        return found
    alone = numbered.join(found.select("_row").distinct(), "_row", "left_anti")
    return found.unionByName(alone, allowMissingColumns=True).drop("_row")


def adjacent(df: DataFrame, on: list[str], start: str, end: str, cols: dict[str, str]) -> DataFrame:
    """Attach columns of the row that starts where this one ends.

    The following row is unique per keys and start (latest end wins).
    """
    following = top_per_key(
        df.select(*on, start, *[c for c in dict.fromkeys([end, *cols]) if c != start]),
        [*on, start],
        [F.col(end).desc_nulls_last()],
    )
    following = following.select(
        *[F.col(k).alias(f"_f_{k}") for k in on],
        F.col(start).alias("_f_start"),
        *[F.col(c).alias(a) for c, a in cols.items()],
    )
    condition = F.col(end) == F.col("_f_start")
    for k in on:
        condition = condition & (F.col(k) == F.col(f"_f_{k}"))
    return df.join(following, condition, "left").drop("_f_start", *[f"_f_{k}" for k in on])


def latest_per_key(rows: DataFrame, key: str, ident: str, first: bool = False) -> DataFrame:
    """Only the row with the largest (or smallest) id per key: the inner-join form."""
    order = F.col(ident).asc() if first else F.col(ident).desc()
    return top_per_key(rows, [key], [order])


def with_latest_flag(rows: DataFrame, key: str, ident: str) -> DataFrame:
    """All rows, plus the largest id per key on the row that has it: the left-join form."""
    newest = rows.groupBy(key).agg(F.max(ident).alias("_newest"))
    joined = rows.join(newest, key, "left")
    return joined.select(*rows.columns, F.when(F.col(ident) == F.col("_newest"), F.col("_newest")).alias("latest_id"))


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Children whose non-null foreign key has no parent."""
    keys = parent.select(F.col(pk).alias(fk)).distinct()
    return child.filter(F.col(fk).isNotNull()).join(keys, fk, "left_anti")


def with_constants(df: DataFrame, **values) -> DataFrame:
    """One-row variables as literals, so filters on them still reach the scan."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def semi(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return df.join(keys.select(*on), on, "left_semi")


def anti(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return df.join(keys.select(*on), on, "left_anti")
