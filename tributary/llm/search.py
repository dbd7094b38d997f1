"""Ranked lexical search: MaxScore whose bounds are tightened by precomputed term pairs.

Terms are maximal runs of ASCII letters, digits and anything beyond ASCII, with A-Z lower-cased. Items (the stated
query set) are met in groups of about ``ITEM_BYTES`` of text, so what a task receives of them is bounded; all
documents are searched for each group.

1. ``matches`` reads every document once and keeps its number of terms and its counts of the group's terms.
2. Corpus statistics (documents, terms, documents per term) are aggregated from that.
3. ``build_index`` turns each batch of documents into one index block: a posting list of impacts per term with its
   maximum, and for pairs of terms that stand near each other in an item's weight order the largest joint impact
   of a document holding both (0 where the two lists do not meet).
4. ``search`` runs MaxScore per item and block. Terms are taken by falling maximum. A document that holds none of the
   first ones can score at most the bound of the rest; where that bound is below the tenth best score so far, the rest
   adds no candidates. The bound of a set of terms is the least found by matching terms into pairs: a pair adds
   max(joint, either maximum) instead of the sum of its maxima. Candidates are dropped by the same bounds as the rest is
   added term by term. Tasks keep the best ten of their documents; a window ranks those of all tasks.

Skipping needs a bound strictly below the tenth score, so ties are decided by the smaller id and results are exact.

Defined cases: a null text has no terms and does not count as a document; a null doc_id ranks behind others of equal
score; repeated rows are documents of their own; an item's terms are those of all rows with its id, once each; items
without terms or without a match return nothing; a null item id is an item; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.llm.common import stage

TOP = 10
#: Text of the items searched together; their terms are held by every task.
ITEM_BYTES = 8 << 20
#: Documents of an index block.
DOCS = 5000
#: How far apart in an item's weight order two terms may stand to have a pair in the index.
PAIR_REACH = 3

# Fixed values of the ranking.
WEIGHT_SCALE, IMPACT_SCALE, SATURATION, NORM_SCALE, NORM_BASE, NORM_SLOPE = 1000, 1_000_000_000, 8, 1000, 10, 90

#: Bytes that separate terms become blanks, A-Z become a-z.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)

MATCHES = "doc_id long, n long, terms array<int>, counts array<int>"
INDEX = (
    "docs array<long>, unnamed array<boolean>, term array<int>, start array<int>, place array<int>, impact array<long>, "
    "top array<long>, pair_a array<int>, pair_b array<int>, joint array<long>"
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


@dataclass
class Items:
    """A group of items: for each its id and the numbers of its terms."""

    ids: list
    terms: list[np.ndarray]
    vocabulary: dict[bytes, int]
    weight: np.ndarray | None = None
    pairs: set = field(default_factory=set)

    def weigh(self, documents: int, df: dict[int, int]) -> None:
        """Set the terms' weights, and the pairs that an index should hold for these items."""
        over = 2 * documents + 2
        self.weight = np.array(
            [math.floor(WEIGHT_SCALE * math.log(over / (2 * df.get(t, 0) + 1))) for t in range(len(self.vocabulary))], np.int64
        )
        for terms in self.terms:
            ranked = terms[np.lexsort((terms, -self.weight[terms]))].tolist()
            for i, a in enumerate(ranked):
                for b in ranked[i + 1 : i + 1 + PAIR_REACH]:
                    self.pairs.add((min(a, b), max(a, b)))


def item_groups(items: DataFrame, item_id: str, text: str) -> Iterator[Items]:
    """The items in groups of bounded text. All rows of an item are in one group."""
    named = items.select(F.col(item_id).alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = size // ITEM_BYTES + 1
    for g in range(groups):
        mine = named.filter(F.pmod(F.xxhash64("id"), F.lit(groups)) == g)
        vocabulary, by_id = {}, {}
        for row in mine.toLocalIterator():
            found = by_id.setdefault(row["id"], set())
            found.update(vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(bytes(row["text"])))
        ids = list(by_id)
        yield Items(ids, [np.array(sorted(by_id[i]), np.int64) for i in ids], vocabulary)


def matches(docs: DataFrame, vocabulary, doc_id: str, text: str) -> DataFrame:
    """Per document with a term: its number of terms, and its counts of the broadcast vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            keep, sizes, terms, counts, starts = [], [], [], [], [0]
            for i, raw in enumerate(batch.column("text")):
                words = terms_of(raw.as_py() or b"")
                if not words:
                    continue
                keep.append(i)
                sizes.append(len(words))
                for word, times in Counter(words).items():
                    t = known.get(word)
                    if t is not None:
                        terms.append(t)
                        counts.append(times)
                starts.append(len(terms))
            offsets = pa.array(starts, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(keep, pa.int64())), pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32())),
                ],
                ["doc_id", "n", "terms", "counts"],
            )

    light = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return light.mapInArrow(count, MATCHES)


def impacts(counts: np.ndarray, sizes: np.ndarray, weight: np.ndarray, documents: int, total: int) -> np.ndarray:
    """Weighted saturating counts in whole numbers."""
    norm = NORM_BASE + (NORM_SLOPE * sizes * documents) // total
    return weight * ((IMPACT_SCALE * counts) // (NORM_SCALE * counts + SATURATION * norm))


def index_block(ids: np.ndarray, unnamed: np.ndarray, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray, lengths: np.ndarray, items: Items, documents: int, total: int) -> dict:
    """Posting lists, their maxima and the joint maxima of the items' pairs for one block of documents."""
    place = np.repeat(np.arange(len(ids)), lengths)
    impact = impacts(counts, sizes[place], items.weight[terms], documents, total)
    order = np.argsort(terms, kind="stable")
    term, place, impact = terms[order], place[order], impact[order]
    present, start = np.unique(term, return_index=True)
    stop = np.append(start[1:], len(term))
    top = np.maximum.reduceat(impact, start) if len(term) else np.zeros(0, np.int64)
    slot = {t: i for i, t in enumerate(present.tolist())}
    pair_a, pair_b, joint = [], [], []
    dense = np.zeros(len(ids), np.int64)
    # Pairs sorted by their first term: its impacts are laid out once for all its pairs.
    last = None
    for a, b in sorted(items.pairs):
        i, j = slot.get(a), slot.get(b)
        if i is None or j is None:
            continue
        if a != last:
            dense[:] = 0
            dense[place[start[i] : stop[i]]] = impact[start[i] : stop[i]]
            last = a
        other = dense[place[start[j] : stop[j]]]
        both = other > 0
        best = int((other + impact[start[j] : stop[j]])[both].max()) if both.any() else 0
        pair_a.append(a)
        pair_b.append(b)
        joint.append(best)
    return dict(docs=ids, unnamed=unnamed, term=present, start=start, place=place, impact=impact, top=top, pair_a=pair_a, pair_b=pair_b, joint=joint)


def build_index(found: DataFrame, items, documents: int, total: int) -> DataFrame:
    """One row per block of documents; ``items`` is a broadcast group with weights."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS):
                part = batch.slice(at, DOCS)
                terms, doc_id = part.column("terms"), part.column("doc_id")
                block = index_block(
                    np.asarray(doc_id.fill_null(0)), np.asarray(doc_id.is_null()), np.asarray(part.column("n")),
                    np.asarray(terms.flatten()).astype(np.int64), np.asarray(part.column("counts").flatten()).astype(np.int64),
                    np.asarray(terms.value_lengths()), items.value, documents, total,
                )
                yield _one_row(block)

    return found.mapInArrow(build, INDEX)


def _one_row(block: dict) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    names = [(f.split()[0], kinds[f.split("<")[1].rstrip(">")]) for f in INDEX.split(", ")]
    columns = [pa.ListArray.from_arrays(pa.array([0, len(block[n])], pa.int32()), pa.array(np.asarray(block[n]), t)) for n, t in names]
    return pa.RecordBatch.from_arrays(columns, [n for n, _ in names])


def pair_bound(terms: list[int], top: dict[int, int], joint: dict[tuple[int, int], int]) -> list[int]:
    """For each suffix of ``terms`` the largest sum a document without the earlier terms can reach.

    Built from the end: a term is added alone or, where that is less, replaces a partner that stood alone by a pair
    that adds max(joint, either maximum). Any matching into disjoint pairs bounds the score, so the least is taken.
    """
    bounds = [0] * (len(terms) + 1)
    free: set[int] = set()
    for i in range(len(terms) - 1, -1, -1):
        a = terms[i]
        alone, partner = top[a], None
        for b in free:
            known = joint.get((min(a, b), max(a, b)))
            if known is not None:
                more = max(known, top[a], top[b]) - top[b]
                if more < alone:
                    alone, partner = more, b
        if partner is None:
            free.add(a)
        else:
            free.discard(partner)
        bounds[i] = bounds[i + 1] + alone
    return bounds


class Best:
    """The best ``k`` (score, unnamed, doc_id) of an item so far, best first."""

    def __init__(self, k: int):
        self.k = k
        self.score = np.zeros(0, np.int64)
        self.doc = np.zeros(0, np.int64)
        self.unnamed = np.zeros(0, bool)

    @property
    def floor(self) -> int:
        """What a document must reach to matter; at least 1, as only scores above 0 are returned."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray, unnamed: np.ndarray) -> None:
        s, d, u = np.append(self.score, score), np.append(self.doc, doc), np.append(self.unnamed, unnamed)
        order = np.lexsort((d, u, -s))[: self.k]
        self.score, self.doc, self.unnamed = s[order], d[order], u[order]


class Block:
    """One index block, ready to be searched. ``scored`` counts the documents whose scores were begun."""

    def __init__(self, row: dict):
        self.docs, self.unnamed = row["docs"], row["unnamed"]
        term, start = row["term"].tolist(), row["start"].tolist()
        stop = start[1:] + [len(row["place"])]
        self.list = {t: slice(a, b) for t, a, b in zip(term, start, stop)}
        self.top = dict(zip(term, row["top"].tolist()))
        self.place, self.impact = row["place"], row["impact"]
        self.joint = {(a, b): j for a, b, j in zip(row["pair_a"].tolist(), row["pair_b"].tolist(), row["joint"].tolist())}
        self.sum = np.zeros(len(self.docs), np.int64)
        self.scored = 0

    def search(self, terms: np.ndarray, best: Best, pairs: bool = True) -> None:
        """Add this block's documents to ``best``. Without ``pairs`` the bounds are sums of single maxima."""
        ranked = sorted((t for t in terms.tolist() if t in self.list and self.top[t] > 0), key=lambda t: (-self.top[t], t))
        if not ranked:
            return
        bounds = pair_bound(ranked, self.top, self.joint if pairs else {})
        floor = best.floor
        essential = next(i for i, bound in enumerate(bounds) if bound < floor)
        for t in ranked[:essential]:
            at = self.list[t]
            self.sum[self.place[at]] += self.impact[at]
        open_ = np.flatnonzero(self.sum)
        self.scored += len(open_)
        for i in range(essential, len(ranked)):
            if len(open_) > best.k:
                # The tenth of the sums so far is reached by ten documents, so it is a floor too.
                floor = max(floor, int(np.partition(self.sum[open_], -best.k)[-best.k]))
            keep = self.sum[open_] + bounds[i] >= floor
            self.sum[open_[~keep]] = 0
            open_ = open_[keep]
            if not len(open_):
                return
            at = self.list[ranked[i]]
            places = self.place[at]
            held = self.sum[places] > 0
            self.sum[places[held]] += self.impact[at][held]
        score = self.sum[open_]
        if len(open_) > best.k:
            enough = score >= np.partition(score, -best.k)[-best.k]
            best.add(score[enough], self.docs[open_[enough]], self.unnamed[open_[enough]])
        else:
            best.add(score, self.docs[open_], self.unnamed[open_])
        self.sum[open_] = 0


def search(index: DataFrame, items, k: int = TOP) -> DataFrame:
    """The best ``k`` documents of each task for each item: ``item`` (place in the group), ``doc_id``, ``score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = items.value
        best = [Best(k) for _ in group.ids]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: np.asarray(batch.column(n)[i].values) for n in batch.schema.names}
                block = Block(row)
                for terms, mine in zip(group.terms, best):
                    block.search(terms, mine)
        sizes = [len(b.score) for b in best]
        doc = [None if u else d for b in best for d, u in zip(b.doc.tolist(), b.unnamed.tolist())]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(best)), sizes), pa.int64()), pa.array(doc, pa.int64()),
                pa.array(np.concatenate([b.score for b in best]) if best else [], pa.int64()),
            ],
            ["item", "doc_id", "score"],
        )

    return index.mapInArrow(run, "item long, doc_id long, score long")


def rank(
    spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = TOP, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``item_id``, ``rank`` from 1, ``doc_id``, ``score`` of the ``k`` best documents of every item."""
    id_type = items.schema[item_id].dataType.simpleString()
    parts = []
    for group in item_groups(items, item_id, item_text):
        vocabulary = spark.sparkContext.broadcast(group.vocabulary)
        found = stage(matches(docs, vocabulary, doc_id, text), "search-matches")
        stats = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = found.select(F.explode("terms").alias("t")).groupBy("t").count()
        # At most one row per term of the group's vocabulary.
        group.weigh(stats[0], {r["t"]: r["count"] for r in df.toLocalIterator()})
        shared = spark.sparkContext.broadcast(group)
        index = stage(build_index(found, shared, stats[0], stats[1]), "search-index")
        best = search(index, shared, k)
        names = spark.createDataFrame(list(enumerate(group.ids)), f"item long, item_id {id_type}")
        ranked = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        top = best.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
        parts.append(top.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out
