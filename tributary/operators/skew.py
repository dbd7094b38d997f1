"""Group facts and lookups that stay balanced when one key holds most rows.

A window over a key sends the whole key to one task. A mergeable frequent-items
summary, taken while the input is staged, names the keys too large for that;
their rows are aggregated first (map-side, so a hot key shrinks to one row per
task) and get the small result by broadcast. All other keys use a plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tributary.session import materialize

#: A key is hot when it holds more than one part in SHARES of an average shuffle partition.
SHARES = 2


#: Items a frequent-items summary tracks for each key that could be hot; more items, fewer false candidates.
TRACKED = 16


def staged_with_hot(df: DataFrame, keys: list[str], stored: bool = False) -> tuple[DataFrame, list[int], int]:
    """``df`` written once, hashes of the keys that may be hot in it, and its number of rows.

    ``stored`` says that ``df`` only reads stored columns: then it is left where it is and only its keys are read.

    The one write that evaluates ``df`` also feeds a mergeable frequent-items summary, so hot keys need no pass or
    count of their own. Every key with more rows than an average shuffle partition divided by ``SHARES`` is among the
    candidates: the summary tracks ``TRACKED`` times as many items as keys of that weight can exist, whose error stays
    far below that weight. A candidate
    that is not hot costs nothing but its place in the list.
    """
    parts = SHARES * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = ", ".join(f"`{k}`" for k in keys)
    summary = F.expr(f"approx_top_k(xxhash64({named}), {parts}, {max(1024, parts * TRACKED)})")
    facts = (summary.alias("top"), F.count(F.lit(1)).alias("rows"))
    if stored:
        staged, found = df, df.agg(*facts).first()
    else:
        seen = Observation()
        staged = materialize(df.observe(seen, *facts), "grouped")
        found = seen.get
    rows = found["rows"] or 0
    return staged, [h["item"] for h in found["top"] or [] if h["count"] * parts >= rows], rows


def _hashed_in(keys: list[str], hashes: list[int]) -> Column:
    return F.xxhash64(*keys).isin(hashes)


def joined_to_hot(rows: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of hot keys with the facts of their keys. The summary names a bounded number of keys, so
    the facts are broadcast and no row of a hot key is shuffled."""
    right = facts.withColumnsRenamed({k: f"_hot_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"`{k}`").eqNullSafe(F.col(f"`_hot_{k}`"))
    return rows.join(F.broadcast(right), condition, "left").drop(*[f"_hot_{k}" for k in keys])


def with_group_stats(
    df: DataFrame, keys: list[str], min_rows: int | None = None, stored: bool = False, **stats: Column
) -> DataFrame:
    """Add group aggregates to every row; no group meets in one task if it is large.

    The input is staged once and its hot keys come with the write. Rows of hot keys are aggregated map-side and get
    the result by broadcast; all others go through a plain window. ``stats`` are aggregate functions such as
    ``F.count(...)``. ``min_rows`` counts the keys instead and takes those with so many rows as hot.
    """
    if min_rows is None:
        staged, hot, _ = staged_with_hot(df, keys, stored)
    else:
        staged = materialize(df, "grouped")
        # At most rows / min_rows keys can have that many rows.
        busy = staged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") >= min_rows)
        hot = [r[0] for r in busy.select(F.xxhash64(*keys)).collect()]
    window = Window.partitionBy(*keys)
    if not hot:
        return staged.select("*", *[c.over(window).alias(n) for n, c in stats.items()])
    is_hot = _hashed_in(keys, hot)
    rest = staged.filter(~is_hot).select("*", *[c.over(window).alias(n) for n, c in stats.items()])
    mine = staged.filter(is_hot)
    facts = mine.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    return rest.unionByName(joined_to_hot(mine, facts, keys))
