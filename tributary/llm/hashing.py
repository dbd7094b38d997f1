"""Approximate nearest neighbours by multi-index hashing.

A rotation learned on a bounded sample (principal axes, then iterative quantisation) turns a vector into a code of one
bit per axis. Codes are cut into substrings of eight bits, and each substring is an index of its own. Two codes that
differ in at most r bits differ in at most floor(r / m) bits in one of m substrings, so probing every substring value
within that distance finds every code within radius r (pigeonhole). Codes found are filtered by their full Hamming
distance, and the vectors of those that remain are ranked by cosine in double precision.

The radius is the one within which the sample's own nearest neighbours lie in all but a hundredth of the cases; they
are closer still among all vectors. A query that finds fewer than k codes widens its radius until it has k or has seen
the whole block.

Vectors are dealt by hash into blocks of about ``BLOCK_ROWS``; each block builds its index and answers all queries with
its own k best, and the best of these are kept. No task holds more than a block and the queries, which meet it in
batches. Equal vectors are one entry with their k + 1 smallest ids, so copies of any number cost one row.

Defined cases: a vector that is null, zero, of another length than most, or with a null or non-finite component takes
no part, neither as query nor as candidate; with fewer than k candidates a query returns all; a query with none and an
empty table give no rows; an id with several rows counts with its best score, and a query leaves out all rows of its own id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import stage

K = 5
#: Vectors that the rotation and the radius are learned from, at most.
SAMPLE = 4096
BLOCK_ROWS = 16384
SUBSTRING = 8
MISSED = 0.01


def learn(sample: np.ndarray, seed: int = 7) -> dict:
    """Mean, rotation and radius from rows of a matrix."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    mean = unit.mean(axis=0)
    dims = sample.shape[1]
    bits = max(SUBSTRING, dims - dims % SUBSTRING)
    centred = unit - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1]
    if dims < bits:
        axes = np.random.default_rng(seed).normal(size=(dims, bits))
    axes = axes[:, :bits]
    turned = centred @ axes
    rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))[0]
    for _ in range(30):
        signs = np.where(turned @ rotation > 0, 1.0, -1.0)
        u, _, w = np.linalg.svd(signs.T @ turned)
        rotation = (u @ w).T
    model = {"mean": mean, "project": axes @ rotation, "dims": dims, "bits": bits, "radius": bits}
    if len(unit) > K:
        some = unit[: min(len(unit), 512)]
        score = some @ unit.T
        score[np.arange(len(some)), np.arange(len(some))] = -2
        best = np.argpartition(-score, K - 1, axis=1)[:, :K]
        code = encode(model, sample)
        far = POPCOUNT[code[: len(some), None, :] ^ code[best]].sum(axis=2)
        model["radius"] = int(np.quantile(far, 1 - MISSED))
    return model


POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.int64)
BY_DISTANCE = [np.flatnonzero(POPCOUNT <= r) for r in range(SUBSTRING + 1)]


def encode(model: dict, vectors: np.ndarray) -> np.ndarray:
    """Codes as rows of bytes; each byte is one substring."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.packbits((unit - model["mean"]) @ model["project"] > 0, axis=1)


class Index:
    """Per substring, the rows of a block ordered by its value, and where each value begins."""

    def __init__(self, model: dict, vectors: np.ndarray):
        self.model, self.vectors = model, vectors
        self.norms = np.linalg.norm(vectors, axis=1)
        self.codes = encode(model, vectors)
        self.order = [np.argsort(c, kind="stable") for c in self.codes.T]
        self.begin = [np.searchsorted(c[o], np.arange(257)) for c, o in zip(self.codes.T, self.order)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose codes differ in at most ``radius`` bits: probe, then check."""
        found = np.zeros(len(self.vectors), bool)
        probes = BY_DISTANCE[min(SUBSTRING, radius // len(code))]
        for value, order, begin in zip(code, self.order, self.begin):
            for v in probes ^ int(value):
                found[order[begin[v] : begin[v + 1]]] = True
        rows = np.flatnonzero(found)
        return rows[POPCOUNT[self.codes[rows] ^ code].sum(axis=1) <= radius]

    def nearest(self, code: np.ndarray, vector: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """At least ``wanted`` rows (all, if fewer) and their cosines; ties at the end are all kept."""
        radius = self.model["radius"]
        rows = self.within(code, radius)
        while len(rows) < min(wanted, len(self.vectors)):
            radius += len(code)
            rows = self.within(code, radius)
        score = (self.vectors[rows] * vector).sum(axis=1) / (self.norms[rows] * np.sqrt((vector * vector).sum()))
        if len(rows) > wanted:
            last = np.partition(score, len(score) - wanted)[len(score) - wanted]
            rows, score = rows[score >= last], score[score >= last]
        return rows, score


VECTOR = "vec_id long, v array<double>"


def _usable(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        keep = []
        for e in b.v:
            if e is None or not len(e):
                keep.append(False)
                continue
            a = np.array([np.nan if x is None else x for x in e], float)
            keep.append(bool(np.isfinite(a).all() and a.any() and np.isfinite(a @ a) and a @ a > 0))
        yield b[np.array(keep, bool)]


def nearest(vectors: DataFrame, is_query, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``vectors`` that ``is_query`` (a condition on vec_id) selects."""
    own = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    good = stage(own.mapInPandas(_usable, VECTOR).filter("vec_id IS NOT NULL"), "ann-vectors")
    lengths = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    dims, total = (lengths[0][0], lengths[0][1]) if lengths else (0, 0)
    good = good.filter(F.size("v") == dims)
    entry = [F.xxhash64("v").alias("h"), F.xxhash64(F.lit(1), "v").alias("g")]
    # Repeated rows are one. Only the k + 1 smallest ids of equal vectors can be asked for.
    place = F.row_number().over(Window.partitionBy("h", "g").orderBy("vec_id"))
    single = good.select(*entry, "vec_id", "v").groupBy("h", "g", "vec_id").agg(F.first("v").alias("v"))
    ranked = single.withColumn("place", place).filter(F.col("place") <= k + 1)
    classes = stage(ranked.groupBy("h", "g").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("v").alias("v")), "ann-classes")

    n = classes.count()
    rate = min(1.0, SAMPLE / max(n, 1))
    picked = classes.filter(F.pmod("h", F.lit(1_000_000)) < int(rate * 1_000_000)).orderBy("h", "g").limit(SAMPLE).select("v").collect()
    if not picked:
        picked = classes.orderBy("h", "g").limit(SAMPLE).select("v").collect()
    model = learn(np.array([r[0] for r in picked])) if picked else None

    blocks = max(1, -(-n // BLOCK_ROWS))
    queries = good.filter(is_query(F.col("vec_id"))).select(*entry, "vec_id")
    asked = classes.join(queries.select("h", "g").distinct(), ["h", "g"], "left_semi")
    everywhere = asked.select("h", "g", F.col("v").alias("q"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    dealt = classes.select("ids", "v", F.pmod("h", F.lit(blocks)).cast("int").alias("block"))

    def answer(index_rows: pd.DataFrame, questions: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(index_rows) and len(questions):
            index = Index(model, np.stack(index_rows.v.to_numpy()))
            ids = index_rows.ids.to_numpy()
            asked_v = np.stack(questions.q.to_numpy())
            for h, g, v, code in zip(questions.h, questions.g, asked_v, encode(model, asked_v)):
                # One id more than k, as the query's own may be among them; an id may have several vectors.
                wanted = k + 1
                rows, score = index.nearest(code, v, wanted)
                while len({i for r in rows for i in ids[r]}) <= k and len(rows) < len(ids):
                    wanted *= 2
                    rows, score = index.nearest(code, v, wanted)
                for r, s in zip(rows, score):
                    out += [(h, g, int(i), float(s)) for i in ids[r]]
        return pd.DataFrame(out, columns=["h", "g", "vec_id", "score"])

    found = dealt.groupBy("block").cogroup(everywhere.groupBy("block")).applyInPandas(answer, "h long, g long, vec_id long, score double")
    order = Window.partitionBy("h", "g").orderBy(F.desc("score"), "vec_id")
    # k + 1 ids per distinct vector are enough: a query takes out rows of its own id.
    # An id with several vectors counts with its best score alone.
    best = found.groupBy("h", "g", "vec_id").agg(F.max("score").alias("score"))
    top = stage(best.withColumn("p", F.row_number().over(order)).filter(F.col("p") <= k + 1).drop("p"), "ann-top")
    joined = queries.withColumnRenamed("vec_id", "query_id").join(top, ["h", "g"]).filter("query_id <> vec_id")
    per = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = joined.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(per))
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
