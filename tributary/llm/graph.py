"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tributary.llm.common import stage

#: Edges of which a task holds the forest at a time.
CHUNK = 1 << 17

EDGE = "u binary, v binary"


def forest(edges: list[tuple[bytes, bytes]]) -> list[tuple[bytes, bytes]]:
    """Stars ``(node, smallest node reachable)`` that connect the same nodes as ``edges``."""
    parent: dict[bytes, bytes] = {}

    def root(x: bytes) -> bytes:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in edges:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(x, r) for x in parent if (r := root(x)) != x]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(edges: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        stars = forest(edges)
        columns = [pa.array([s[i] for s in stars], pa.binary()) for i in range(2)]
        return pa.RecordBatch.from_arrays(columns, names=["u", "v"])

    held: list[tuple[bytes, bytes]] = []
    for batch in batches:
        held.extend(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        while len(held) >= CHUNK:
            yield out(held[:CHUNK])
            held = held[CHUNK:]
    if held:
        yield out(held)


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges(a, b)``; the label is the smallest node reachable. Nodes are binary.

    Each turn first replaces every ``CHUNK`` edges by the stars of their own forest, without a shuffle. One chunk is then
    the result; of several, the stars are brought together by a large-star and a small-star step, until nothing moves.
    Each step is one aggregation, combined before the shuffle, and one join; a node with very many edges is split by
    the skew join. Every turn is written out, and the write itself counts its rows, so a lost executor costs one
    turn at most. Null ends and loops are ignored; without edges the result is empty.
    """
    now, mark = _written(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while mark[0]:
        chunks = -(-mark[0] // CHUNK)
        stars = now.coalesce(chunks).mapInArrow(_forests, EDGE)
        if chunks == 1:
            now, mark = _written(stars)
            break
        was = mark
        now, mark = _written(_small_star(_large_star(stars)))
        if was == mark:
            break
    own = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return own.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, written and read back, with their number and a mark of their content."""
    seen = Observation()
    marks = [F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.bit_xor(F.xxhash64("v", "u")).alias("y")]
    now = stage(edges.observe(seen, *marks), "components")
    r = seen.get
    return now, (r["n"], r["x"], r["y"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to the smallest node around it."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node itself, move to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
