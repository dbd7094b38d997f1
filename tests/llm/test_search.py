"""Ranked search against every score, and the work that pair bounds save."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from tributary.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, k=10):
    """All scores of all documents, as the ranking is defined."""
    bags = [(i, Counter(TERM.findall((t or "").translate(UP)))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall((t or "").translate(UP)))
    out = []
    for item, terms in asked.items():
        scores = []
        for i, b in bags:
            m = 10 + (90 * sum(b.values()) * n_docs) // total
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 8 * m)) for t in terms if b[t]
            )
            if s:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def pairs(df, name):
    return [tuple(r) for r in df.select(name, "text").collect()]


def test_whole_table(spark, docs):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    assert got(search.rank(spark, docs, items)) == plain(pairs(docs, "doc_id"), pairs(items, "item_id"))


def test_odd_rows_on_both_sides(spark, odd, nothing, monkeypatch):
    asked = spark.createDataFrame(
        [(1, "One TWO café", 0), (1, "seven", 1), (2, None, 0), (3, "", 0), (4, "absent zzz", 0), (None, "word token", 1), (5, "中文 ßİ", 0)],
        "item_id long, text string, score int",
    )
    want = plain(pairs(odd, "doc_id"), pairs(asked, "item_id"))
    assert got(search.rank(spark, odd, asked)) == want
    monkeypatch.setattr(search, "ITEM_BYTES", 30)
    assert got(search.rank(spark, odd, asked)) == want
    assert got(search.rank(spark, nothing, asked)) == [] == got(search.rank(spark, odd, asked.limit(0)))


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, "same words here") for i in range(40, 0, -1)] + [(None, "same words here"), (99, "other text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame([(7, "words")], "item_id long, text string")
    assert [r[2] for r in sorted(got(search.rank(spark, docs, items)), key=lambda r: r[1])] == list(range(1, 11))


def blocks(seed, n_docs=3000, n_terms=40):
    """Random documents in which the terms 2k and 2k + 1 never meet, as an index block and items that ask for both."""
    rng = np.random.default_rng(seed)
    lists = []
    for _ in range(n_docs):
        chance = rng.random(n_terms // 2)
        lists.append(np.concatenate([2 * np.flatnonzero(chance < 0.15), 2 * np.flatnonzero(chance > 0.85) + 1]))
    lengths = np.array([len(x) for x in lists])
    terms = np.concatenate(lists).astype(np.int64)
    counts = rng.integers(1, 4, len(terms))
    sizes = np.add.reduceat(np.append(counts, 0), np.append(0, np.cumsum(lengths)[:-1])) * (lengths > 0) + rng.integers(1, 60, n_docs)
    asked = [np.sort(np.concatenate([2 * k, 2 * k + 1])) for k in (rng.choice(n_terms // 2, 6, replace=False) for _ in range(30))]
    items = search.Items(list(range(30)), asked, {str(t).encode(): t for t in range(n_terms)})
    items.weigh(n_docs, Counter(terms.tolist()))
    ids = rng.permutation(n_docs)
    return search.index_block(ids, np.zeros(n_docs, bool), sizes, terms, counts, lengths, items, n_docs, int(sizes.sum())), items, (ids, sizes, terms, counts, lengths)


@pytest.mark.parametrize("seed", range(4))
def test_pair_bounds_begin_fewer_documents_and_lose_none(seed):
    row, items, (ids, sizes, terms, counts, lengths) = blocks(seed)
    row = {k: np.asarray(v) for k, v in row.items()}
    impact = search.impacts(counts, np.repeat(sizes, lengths), items.weight[terms], len(ids), int(sizes.sum()))
    owner = np.repeat(np.arange(len(ids)), lengths)
    work = {}
    for pairs_used in (True, False):
        work[pairs_used] = 0
        for asked in items.terms:
            best = search.Best(10)
            first = search.Block(row)
            first.search(asked, best, pairs_used)
            again = search.Block(row)
            again.search(asked, best, pairs_used)
            work[pairs_used] += again.scored
            total = np.bincount(owner, np.where(np.isin(terms, asked), impact, 0), len(ids)).astype(np.int64)
            order = np.lexsort((ids, -total))[:10]
            once = search.Best(10)
            search.Block(row).search(asked, once, pairs_used)
            assert once.score.tolist() == total[order].tolist() and once.doc.tolist() == ids[order].tolist()
    assert work[True] < work[False]


def test_a_pair_that_never_meets_is_skipped_whole():
    """Two frequent terms could together beat the rare one by their maxima, but no document holds both."""
    lists = [[0]] * 20 + [[1], [2]] * 70
    terms, lengths = np.concatenate(lists).astype(np.int64), np.ones(160, np.int64)
    items = search.Items([0], [np.arange(3)], {b"0": 0, b"1": 1, b"2": 2})
    items.weigh(160, Counter(terms.tolist()))
    ids, sizes = np.arange(160), np.full(160, 5)
    row = search.index_block(ids, np.zeros(160, bool), sizes, terms, np.ones(160, np.int64), lengths, items, 160, 800)
    row = {k: np.asarray(v) for k, v in row.items()}
    row["top"] = np.array([1000, 600, 600])
    row["impact"] = np.where(row["place"] < 20, 1000, 600)
    scored = {}
    for use in (True, False):
        best = search.Best(10)
        best.add(np.full(10, 1000), np.arange(10), np.zeros(10, bool))
        block = search.Block(row)
        block.search(np.arange(3), best, use)
        assert best.score.tolist() == [1000] * 10 and best.doc.tolist() == sorted(best.doc.tolist())
        scored[use] = block.scored
    assert scored == {True: 20, False: 90}


def test_bound_covers_every_document():
    row, items, (ids, sizes, terms, counts, lengths) = blocks(9)
    block = search.Block({k: np.asarray(v) for k, v in row.items()})
    impact = search.impacts(counts, np.repeat(sizes, lengths), items.weight[terms], len(ids), int(sizes.sum()))
    owner = np.repeat(np.arange(len(ids)), lengths)
    for asked in items.terms:
        ranked = sorted((t for t in asked.tolist() if t in block.list), key=lambda t: (-block.top[t], t))
        bounds, loose = search.pair_bound(ranked, block.top, block.joint), search.pair_bound(ranked, block.top, {})
        for i in range(len(ranked)):
            most = np.bincount(owner, np.where(np.isin(terms, ranked[i:]), impact, 0), len(ids)).max()
            assert most <= bounds[i] <= loose[i]
