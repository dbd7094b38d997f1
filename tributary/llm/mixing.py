"""Mixing sources to target weights by balanced sampling (the cube method).

Targets. Every source has a weight; the sizes of all documents are shared by weight, and a source takes at most
``MOST`` times its own size. What it cannot take is shared among the others, again by weight, until none is above.

Copies. A source that takes r times its size takes floor(r) copies of every document and one more of each with
probability r - floor(r). Which documents get the one more is decided by the cube method: a vector of such
probabilities walks through the null space of the constraints (number of documents, sum of sizes), each step fixing
at least one document, until at most as many documents are left as there are constraints. Blocks of documents of a
source walk in parallel, their leftovers meet in the next round's blocks, and so on. The last dozen of a source are
the landing problem: all their choices are compared and the sum of sizes is met best.

Only ids, sizes and sources take part; a source with most documents is cut into blocks of ``BLOCK``. Steps are
drawn from the documents' hashes, so every run gives the same mix.

Defined cases: a null text has size 0, and a document of size 0 has floor(r) or floor(r) + 1 copies like any other;
a null source is a source of its own, ordered last; equal rows are told apart by their number among equals; an
empty table gives an empty result; if all sizes are 0, so are all targets and nothing is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import BLANK_RUN, BLANKS, stage

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK = 2048
LANDING = 10


def text_size(text: Column) -> Column:
    """Number of words, without building them: runs of white space inside the trimmed text, and one."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(F.char_length(t) == 0, 0).otherwise(F.size(F.split(t, BLANK_RUN))).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source with ``source_size``, ``n_docs`` and ``target``; ``sizes`` has ``source, size`` and ``n`` equal rows.

    With sources in the order of most * size / weight, those at their cap come first. The level at which the rest
    shares what is left follows from running sums, so no repetition is needed. The windows run over one row per
    source, not over documents.
    """
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    listed = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("weight", F.element_at(listed, (F.pmod(place, F.lit(len(weights))) + 1).cast("int")))
    cap = most * F.col("source_size").cast("double")
    every = Window.partitionBy()
    up = Window.orderBy("fill", F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("fill", cap / F.col("weight"))
    per = per.withColumn("total", F.sum("source_size").over(every).cast("double")).withColumn(
        # the level if this source and all after it share what those before it leave
        "level",
        (F.col("total") - F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
        / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
    )
    per = per.withColumn("level", F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "source", "level"))).over(every)["level"])
    share = F.least(F.col("weight") * F.coalesce("level", F.lit(float("inf"))), cap)
    return per.select("source", "source_size", "n_docs", share.alias("target"))


def _uniform(seed: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) from 64-bit seeds (the splitmix64 finaliser)."""
    z = seed.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0**53


def flight(prob: np.ndarray, size: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Move probabilities to 0 or 1 while their sum and their sum of sizes stay; at most two stay between.

    Three open documents and two constraints leave one direction, the cross product of the constraint rows. The
    walk goes either way along it, to the nearest wall, with chances that keep the expected value.
    """
    p = prob.astype(float).copy()
    eps = 1e-9
    queue = [i for i in range(len(p)) if eps < p[i] < 1 - eps]
    open_ = []
    k = 0
    for i in queue:
        open_.append(i)
        while len(open_) >= 3:
            a, b, c = open_
            x, y, z = size[a], size[b], size[c]
            u = (z - y, x - z, y - x)
            if u == (0.0, 0.0, 0.0):
                u = (1.0, -1.0, 0.0)
            up = down = np.inf
            for j, d in zip(open_, u):
                if d > 0:
                    up, down = min(up, (1 - p[j]) / d), min(down, p[j] / d)
                elif d < 0:
                    up, down = min(up, p[j] / -d), min(down, (1 - p[j]) / -d)
            step = up if draw[k % len(draw)] * (up + down) < down else -down
            k += 1
            for j, d in zip(open_, u):
                p[j] += step * d
            for j in open_:
                if p[j] <= eps:
                    p[j] = 0.0
                elif p[j] >= 1 - eps:
                    p[j] = 1.0
            open_ = [j for j in open_ if 0.0 < p[j] < 1.0]
    return p


def land(prob: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Decide the last open documents, LANDING + 2 at most, by looking at every choice.

    The choice misses the sum of sizes least; a document too many or too few costs a hundredth of the mean size.
    """
    p = prob.copy()
    left = np.flatnonzero((p > 0.0) & (p < 1.0))
    if not len(left):
        return p
    taken = (np.arange(2 ** len(left))[:, None] >> np.arange(len(left))) & 1
    missed = np.abs(taken @ size[left] - p[left] @ size[left])
    extra = np.abs(taken.sum(axis=1) - p[left].sum())
    p[left] = taken[np.argmin(missed + extra * (0.01 * size.mean() + 1e-6))]
    return p


UNIT = "source string, doc_id long, size long, nth long, seed long, prob double"


def _walk(last: bool):
    def run(unit: pd.DataFrame) -> pd.DataFrame:
        unit = unit.sort_values(["seed", "doc_id", "nth"], kind="stable").reset_index(drop=True)
        seeds, p, size = unit.seed.to_numpy(), unit.prob.to_numpy(float), unit["size"].to_numpy(float)
        walking = max(0, len(p) - LANDING) if last else len(p)
        if walking:
            p = np.concatenate([flight(p[:walking], size[:walking], _uniform(seeds)), p[walking:]])
        if last:
            p = land(p, size)
        return unit.assign(prob=p)[[f.split()[0] for f in UNIT.split(", ")]]

    return run


def choose(units: DataFrame, most_in_source: int, block: int = BLOCK) -> DataFrame:
    """Run the walk over units (UNIT) to the end; ``prob`` of each comes back as 0 or 1.

    A round cuts every source into blocks of about ``block`` units; two of each stay open at most, so the number of
    rounds is the logarithm of the largest source to that base. Decided units go to the result; only the open ones
    are carried on.
    """
    done: list[DataFrame] = []
    n = most_in_source
    level = 0
    while True:
        blocks = max(1, -(-n // block))
        key = F.pmod(F.xxhash64("seed", "doc_id", "nth", F.lit(level)), F.lit(blocks))
        walked = units.groupBy("source", key.alias("block")).applyInPandas(_walk(blocks == 1), UNIT)
        if blocks == 1:
            return _union([*done, walked])
        walked = stage(walked, "cube")
        is_open = (F.col("prob") > 0) & (F.col("prob") < 1)
        done.append(walked.filter(~is_open))
        units = walked.filter(is_open)
        n, level = 2 * blocks, level + 1


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """``doc_id, source, size, nth, source_size, target, copies`` for rows with ``doc_id, source, size``.

    ``nth`` numbers equal rows from 0. The counts of equal rows are aggregated before they are spread out again,
    so a key that holds many rows is never gathered.
    """
    own = stage(docs.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    goal = stage(targets(own, weights, most), "mix-targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rate = goal.select(F.col("source").alias("s"), "source_size", "target", ratio.alias("ratio"))
    each = own.select("doc_id", "source", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("nth"))
    each = each.join(rate, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    whole = F.floor(F.col("ratio") + 1e-12)
    units = each.select(
        "source", "doc_id", "size", "nth",
        F.xxhash64("doc_id", "size", "nth").alias("seed"),
        F.greatest(F.col("ratio") - whole, F.lit(0.0)).alias("prob"),
    )
    top = goal.agg(F.max("n_docs")).first()[0] or 0
    drawn = choose(units, top, block)
    drawn = drawn.join(rate, drawn.source.eqNullSafe(rate.s)).drop("s")
    return drawn.select(
        "doc_id", "source", "size", "nth", "source_size", "target",
        (whole + F.round("prob")).cast("long").alias("copies"),
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per document: its size, its source's size and target, and the number of words that the mix takes of it."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), text_size(F.col(text)).alias("size"))
    got = copies(own, weights, most)
    return got.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents themselves, each as often as the mix takes it, with their own columns.

    Rows meet their numbers of copies by id, source and size; rows equal in these are numbered by their text's hash.
    """
    names = docs.columns
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        F.col(doc_id).alias("i"), F.col(source).alias("s"), text_size(F.col(text)).alias("z"), F.xxhash64(F.col(text)).alias("h"),
    )
    got = copies(packed.select(F.col("i").alias("doc_id"), F.col("s").alias("source"), F.col("z").alias("size")), weights, most)
    got = got.filter("copies > 0").select("doc_id", "source", "size", "nth", "copies")
    among = Window.partitionBy("i", "s", "z").orderBy("h")
    numbered = packed.withColumn("n", F.row_number().over(among) - 1)
    same = (
        F.col("i").eqNullSafe(F.col("doc_id")) & F.col("s").eqNullSafe(F.col("source"))
        & (F.col("z") == F.col("size")) & (F.col("n") == F.col("nth"))
    )
    joined = numbered.join(got, same)
    return joined.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).select("row.*")
