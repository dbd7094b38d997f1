"""MinHash near-duplicate detection with an LSH forest.

Each text's set of five-word shingles gets a signature of ``HASHES`` minima. A tree of the forest is an order of the
signature's components; all sets are sorted in that order, and the neighbours with the longest common prefix are
candidates. A region is a run of sets that agree on the first ``DEPTH`` components. Sets in a sparse region meet at
that depth; in a crowded one the order goes deeper by itself, as the following components are part of the sort key,
so each set meets those that agree with it longest. Each set also meets the first of its region, which ties the
region together.

Candidates of one group are then confirmed on their full shingle sets. Groups are the connected components of the
candidate graph; inside a group the likeliest pairs are confirmed first, and a pair whose ends are connected by
confirmed links already is not looked at again. So a large group costs about as many comparisons as it has members,
while components come out as if all its candidate pairs had been compared. Very large groups are cut into blocks of
pairs and joined again by the links that the blocks find.

Crowded regions. In a region of more than ``NEIGHBOURS`` + 1 sets not all pairs are neighbours. Where such a region
still holds sets of different components, its sets go through an exact join: shingles ordered by their exact counts
among these sets, prefix, length and positional filters as in ``lines``, and verification of all pairs from
different components. A passage that many of them share is ordered last, so it brings no sets together by itself.

Exact copies, and texts with equal sets, are one node throughout: copies of any number cost one row each.

Recall: two sets of similarity s agree on the first two components of a tree with chance s * s, so at 0.75 a pair
meets no tree of 16 with chance (1 - 0.5625) ** 16, below two in a million. A pair that meets in a tree is a
neighbour, is connected through others, or is found by the exact join.

Defined cases: null and wordless texts have an empty set, are linked with nothing, and each is a component of its
own; a text of fewer than five words is one shingle; repeated rows are copies; of rows with one doc_id and
different texts the classes stay apart; a null doc_id comes after all others; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import counted, stage
from tributary.llm.graph import components
from tributary.llm.shingles import PLACE, U, mixed, set_name, shingle_sets, text_chunks

TREES = 16
DEPTH = 2
HASHES = TREES * DEPTH
NEIGHBOURS = 3
#: Nodes of a group that are confirmed together, and left ends of a block of pairs of a larger group.
GROUP = 512
BLOCK = 128
#: Shingles that leave a task in one batch.
OUT = 1 << 16

_random = np.random.default_rng(977)
TURN = _random.integers(1, 2**63, HASHES, dtype=np.uint64)
FACTOR = _random.integers(1, 2**63, HASHES, dtype=np.uint64) | U(1)

SIGNED = "doc_id long, th long, n_shingles long, node binary, keys array<long>, orders array<long>"


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For non-empty sets: per tree the hash of its first components, and the top bytes of the next eight."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    least = np.empty((HASHES, len(sets)), np.uint64)
    for p in range(HASHES):
        least[p] = np.minimum.reduceat((flat ^ TURN[p]) * FACTOR[p], starts)
    least = mixed(least)
    keys, orders = np.empty((len(sets), TREES), np.int64), np.empty((len(sets), TREES), np.int64)
    for t in range(TREES):
        key = np.full(len(sets), U(t + 1))
        for j in range(DEPTH):
            key = mixed(key + least[t * DEPTH + j] * PLACE[j])
        deep = np.zeros(len(sets), np.uint64)
        for j in range(8):
            deep = (deep << U(8)) | (least[(t * DEPTH + DEPTH + j) % HASHES] >> U(56))
        keys[:, t], orders[:, t] = key.view(np.int64), deep.view(np.int64)
    return keys, orders


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lists = pa.list_(pa.int64())
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for first, data, offsets in text_chunks(texts):
            sets = shingle_sets(data, offsets)
            full = [i for i, s in enumerate(sets) if len(s)]
            keys = np.zeros((len(sets), TREES), np.int64)
            orders = np.zeros((len(sets), TREES), np.int64)
            if full:
                keys[full], orders[full] = signatures([sets[i] for i in full])
            ends = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * TREES)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(first, len(sets)).cast(pa.int64()),
                    batch.column(2).slice(first, len(sets)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_name(s) if len(s) else None for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(ends, pa.array(keys.ravel())).cast(lists),
                    pa.ListArray.from_arrays(ends, pa.array(orders.ravel())).cast(lists),
                ],
                names=["doc_id", "th", "n_shingles", "node", "keys", "orders"],
            )


PAIR = "edge boolean, key long, deep long, a binary, na long, b binary, nb long"


def _neighbours(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Candidate pairs from sorted rows (key, deep, node, n). The first and last rows of a partition, and the first row of
    its last region, go out with ``edge``, so that the runs can be joined across partitions."""
    held, first = None, None

    def out(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        small, large = np.minimum(a.n.to_numpy(), b.n.to_numpy()), np.maximum(a.n.to_numpy(), b.n.to_numpy())
        fits = 4 * small >= 3 * large
        return pd.DataFrame(
            {
                "edge": False, "key": b.key.to_numpy()[fits], "deep": b.deep.to_numpy()[fits],
                "a": a.node.to_numpy()[fits], "na": a.n.to_numpy()[fits], "b": b.node.to_numpy()[fits], "nb": b.n.to_numpy()[fits],
            }
        )

    for frame in frames:
        if not len(frame):
            continue
        if first is None or len(first) < NEIGHBOURS:
            first = pd.concat([first, frame], ignore_index=True).iloc[:NEIGHBOURS]
        new = len(held) if held is not None else 0
        rows = pd.concat([held, frame], ignore_index=True) if new else frame.reset_index(drop=True)
        key = rows.key.to_numpy()
        at = np.arange(len(rows))
        begin = np.maximum.accumulate(np.where(np.concatenate([[True], key[1:] != key[:-1]]), at, 0))
        for back in range(1, NEIGHBOURS + 1):
            i = at[new:]
            i = i[i - back >= begin[i]]
            yield out(rows.iloc[i - back], rows.iloc[i])
        i = at[new:]
        i = i[i - NEIGHBOURS > begin[i]]
        yield out(rows.iloc[begin[i]], rows.iloc[i])
        tail = rows.iloc[max(0, len(rows) - NEIGHBOURS) :]
        pivot = rows.iloc[[begin[-1]]] if begin[-1] < len(rows) - NEIGHBOURS else rows.iloc[:0]
        held = pd.concat([pivot, tail[tail.key == key[-1]]], ignore_index=True)
    if first is not None:
        ends = pd.concat([first, held], ignore_index=True).drop_duplicates(["key", "node"])
        yield pd.DataFrame({"edge": True, "key": ends.key, "deep": ends.deep, "a": ends.node, "na": ends.n, "b": ends.node, "nb": ends.n})


def candidates(classes: DataFrame) -> DataFrame:
    """``a, b, trees`` from classes (node, n, keys, orders): pairs that are neighbours, and in how many trees."""
    rows = classes.select("node", "n", F.explode(F.arrays_zip("keys", "orders")).alias("t")).select(
        F.col("t.keys").alias("key"), F.col("t.orders").alias("deep"), "node", "n"
    )
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "key", "deep", "node").sortWithinPartitions("key", "deep", "node")
    found = stage(ordered.mapInPandas(_neighbours, PAIR), "forest")
    # A few rows per partition: the runs that go on in the next partition.
    ends = found.filter("edge").select("key", "deep", F.col("a").alias("node"), F.col("na").alias("n"))
    before = Window.partitionBy("key").orderBy("deep", "node")
    seen = F.struct("node", "n")
    others = F.array(*[F.lag(seen, k).over(before) for k in range(1, NEIGHBOURS + 1)], F.first(seen).over(before))
    seams = ends.withColumn("others", others).select("node", "n", F.explode(F.array_distinct("others")).alias("o")).select(
        F.col("o.node").alias("a"), F.col("o.n").alias("na"), F.col("node").alias("b"), F.col("n").alias("nb")
    ).filter("a IS NOT NULL AND a <> b AND 4 * least(na, nb) >= 3 * greatest(na, nb)")
    every = found.filter("NOT edge").select("a", "b").union(seams.select("a", "b"))
    return every.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count(F.lit(1)).alias("trees")).filter("a <> b")


LINK = "a binary, b binary"


def _confirm(nodes: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
    """Links among the pairs of a block, without those whose ends are connected already."""
    sets: dict[bytes, np.ndarray] = {}
    column = pa.array(nodes.text.tolist(), pa.string())
    for first, data, offsets in text_chunks(column):
        for i, s in enumerate(shingle_sets(data, offsets), first):
            name = nodes.node.iloc[i]
            if len(s) and name not in sets and set_name(s) == bytes(name):
                sets[bytes(name)] = s
    parent = {k: k for k in sets}

    def root(x: bytes) -> bytes:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    pairs = pairs.sort_values(["trees", "a", "b"], ascending=[False, True, True])
    for a, b in zip(map(bytes, pairs.a), map(bytes, pairs.b)):
        if a not in sets or b not in sets:
            raise ValueError("a candidate's text was not found")
        ra, rb = root(a), root(b)
        if ra == rb:
            continue
        x, y = sets[a], sets[b]
        shared = len(np.intersect1d(x, y, assume_unique=True))
        if 100 * shared >= 75 * (len(x) + len(y) - shared):
            links.append((a, b))
            parent[ra] = rb
    return pd.DataFrame(links, columns=["a", "b"])


def confirmed(pairs: DataFrame, many: int, classes: DataFrame, texts: DataFrame, dense: bool = False) -> DataFrame:
    """The links ``a, b`` among the ``many`` candidate pairs that connect all that the pairs can connect.

    A set may have any number of partners in ``dense`` pairs, so their blocks are bounded on both ends.
    ``texts`` has ``doc_id, text, th``; ``classes`` has ``node, rep, th`` with the doc_id and hash of one text of the class.
    """
    groups, total = counted(components(pairs), "near-groups")
    sizes = groups.groupBy("label").agg(F.count(F.lit(1)).alias("members"))
    per = F.when(F.col("members") <= GROUP, F.lit(1)).otherwise(F.ceil(F.col("members") / (GROUP if dense else BLOCK)))
    blocks = max(1, -(-total // (2 * GROUP)))
    cell = [F.pmod(F.xxhash64("a"), "parts")]
    if dense:
        blocks = max(blocks, -(-many * 4 // GROUP**2))
        cell.append(F.pmod(F.xxhash64("b"), "parts"))
    member = groups.join(sizes, "label").select("node", "label", per.alias("parts"))
    placed = pairs.join(member, pairs.a == member.node).select(
        "a", "b", "trees", F.pmod(F.xxhash64("label", *cell), F.lit(blocks)).cast("int").alias("block")
    )
    placed = stage(placed, "near-blocks")
    wanted = placed.select("block", F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = wanted.join(classes.select("node", "rep", "th"), "node")
    found = texts.join(wanted, texts.doc_id.eqNullSafe(wanted.rep) & (texts.th == wanted.th)).select("block", "node", "text")
    own = placed.select(F.col("block").alias("of_block"), F.col("a").alias("one"), F.col("b").alias("other"), "trees")
    own = own.toDF("block", "a", "b", "trees")
    return found.groupBy("block").cogroup(own.groupBy("block")).applyInPandas(_confirm, LINK)


def _open_sets(classes: DataFrame, found: DataFrame) -> DataFrame:
    """``node, label`` of the sets in crowded regions that hold more than one component; the label is a hash."""
    labels = found.select("node", F.xxhash64("label").alias("label"))
    own = classes.select("node", "keys").join(labels, "node", "left").withColumn("label", F.coalesce("label", F.xxhash64("node")))
    rows = own.select("node", "label", F.explode("keys").alias("key"))
    regions = rows.groupBy("key").agg(F.count(F.lit(1)).alias("many"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    left = regions.filter(f"many > {NEIGHBOURS + 1} AND lo <> hi").select("key")
    return rows.join(left, "key", "left_semi").select("node", "label").distinct()


def _sets_of(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and shingles of the rows (node, label, text) whose text is their node's."""
    nodes = batch.column(0).to_pylist()
    for first, data, offsets in text_chunks(batch.column(2)):
        for i, s in enumerate(shingle_sets(data, offsets), first):
            if len(s) and set_name(s) == nodes[i]:
                yield i, s


GRAM = "node binary, label long, n int, s long"


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each shingle of each set; sets go out together until they hold ``OUT`` shingles."""

    def out(batch: pa.RecordBatch, rows: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        sizes = np.array([len(s) for s in sets], np.int32)
        at = pa.array(np.repeat(rows, sizes))
        columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(np.repeat(sizes, sizes)), pa.array(np.concatenate(sets).view(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["node", "label", "n", "s"])

    for batch in batches:
        rows, sets, held = [], [], 0
        for i, s in _sets_of(batch):
            rows.append(i)
            sets.append(s)
            held += len(s)
            if held >= OUT:
                yield out(batch, rows, sets)
                rows, sets, held = [], [], 0
        if rows:
            yield out(batch, rows, sets)


def crowded_pairs(opened: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """``a, b, trees``: all pairs of ``opened`` (node, label) with different labels that may be similar, by prefix filter."""
    wanted = opened.join(classes.select("node", "rep", "th"), "node")
    sets = stage(texts.join(wanted, texts.doc_id.eqNullSafe(wanted.rep) & (texts.th == wanted.th)).select("node", "label", "text"), "near-open-texts")
    grams = sets.mapInArrow(_grams, GRAM)
    labels = grams.groupBy("s").agg(F.count(F.lit(1)).alias("count"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    shared = labels.filter("lo <> hi").select("s", "count")
    # Shingles of one component come first in the order: they take their places in the prefix, but are never met.
    ranked = grams.join(shared, "s").groupBy("node", "label", "n").agg(F.sort_array(F.collect_list(F.struct("count", "s"))).alias("r"))
    alone = ranked.withColumn("alone", F.col("n") - F.size("r"))
    prefix = "greatest(n - CAST((3 * n + 3) DIV 4 AS INT) + 1 - alone, 0)"
    cut = alone.select("node", "label", "n", "alone", F.posexplode(F.expr(f"slice(r, 1, {prefix})")).alias("i", "x"))
    live = stage(cut.select(F.col("x.s").alias("key"), "node", "label", "n", (F.col("alone") + F.col("i")).alias("at")), "near-shared")
    # Pairs inside the largest component of a shingle are never formed: one end is always of another.
    main = live.groupBy("key", "label").count().groupBy("key").agg(F.max_by("label", F.struct("count", "label")).alias("main"))
    a = live.join(main, "key").filter("label <> main").select("key", F.col("node").alias("a"), F.col("label").alias("la"), F.col("n").alias("na"), F.col("at").alias("pa"))
    b = live.select("key", F.col("node").alias("b"), F.col("label").alias("lb"), F.col("n").alias("nb"), F.col("at").alias("pb"))
    possible = "la <> lb AND 4 * least(na, nb) >= 3 * greatest(na, nb) AND 7 * least(na - pa, nb - pb) >= 3 * (na + nb)"
    met = a.join(b, "key").filter(possible)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().withColumn("trees", F.lit(1).cast("long"))


def _grouped(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signed rows, their classes, and ``node, label`` of the classes that are linked."""
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("th"))
    signed = stage(texts.mapInArrow(_sign, SIGNED), "near-signatures")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("of")
    classes = signed.filter("node IS NOT NULL").groupBy("node").agg(
        first, F.first("n_shingles").alias("n"), F.first("keys").alias("keys"), F.first("orders").alias("orders")
    )
    classes = stage(classes.select("node", F.col("of.doc_id").alias("rep"), F.col("of.th").alias("th"), "n", "keys", "orders"), "near-classes")
    pairs, many = counted(candidates(classes), "near-candidates")
    links = stage(confirmed(pairs, many, classes, texts), "near-links")
    found = components(links)
    opened, apart = counted(_open_sets(classes, found), "near-open")
    if apart:
        far, many = counted(crowded_pairs(opened, classes, texts), "near-far")
        if many:
            more, new = counted(confirmed(far, many, classes, texts, dense=True), "near-far-links")
            if new:
                found = components(links.union(more))
    return signed, classes, found


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, node, component_id`` for each row of ``docs``; node is null for an empty set."""
    signed, classes, found = _grouped(docs, doc_id, text)
    # The smallest id of a component, by node; nodes without a link stand for themselves.
    own = classes.select("node", "rep").join(found, "node")
    least = own.groupBy("label").agg(F.min("rep").alias("component_id"))
    by_node = stage(own.join(least, "label").select("node", "component_id"), "near-components")
    alone = classes.select("node", F.col("rep").alias("own_id"))
    ids = alone.join(by_node, "node", "left").select("node", F.coalesce("component_id", "own_id").alias("component_id"))
    joined = signed.select("doc_id", "n_shingles", "node").join(ids, "node", "left")
    return joined.select(
        "doc_id", "n_shingles", "node",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each component, all columns as they were, and every row with an empty set.

    The row that stays has the smallest doc_id of its component; a null doc_id comes after all others. If several
    texts of the component have that id, one text class of them stays, and of its repeated rows one.
    """
    signed, classes, found = _grouped(docs, doc_id, text)
    labelled = classes.select("node", "rep").join(found, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = labelled.groupBy("label").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "node")).alias("k"))
    keepers = stage(least.select(F.col("k.rep").alias("rep"), F.col("k.node").alias("node")), "near-keepers")
    # A class may have several texts with one id, which differ in blanks or case: the smallest hash stays.
    stays = signed.select("doc_id", "th", "node").join(keepers, "node").filter("doc_id <=> rep")
    stays = stays.groupBy("node").agg(F.first("doc_id").alias("d"), F.min("th").alias("h"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(doc_id).cast("long").alias("i"), F.col(text).alias("t"))
    packed = packed.withColumn("wordless", ~F.coalesce(F.col("t"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")).withColumn("th", F.xxhash64("t"))
    kept = packed.filter("NOT wordless").join(stays, F.col("i").eqNullSafe(F.col("d")) & (F.col("th") == F.col("h")))
    numbered = kept.withColumn("nth", F.row_number().over(Window.partitionBy("i", "node").orderBy("th")))
    return packed.filter("wordless").select("row.*").union(numbered.filter("nth = 1").select("row.*"))
