"""Removal of repeated byte strings: every byte covered by a string of 200 bytes that also starts elsewhere.

1. Anchors. Each 200-byte string is served by the anchor in it (see ``anchors``), so equal strings meet at anchors of
   one hash, and a corpus of n bytes has about n / 80 of them. Anchors whose hash occurs once are dropped.
2. Stretches. The strings that an anchor serves make up one stretch of text. If a stretch occurs twice as a whole, all
   its occurrences are covered; this settles copies of any number by counting, without looking at text.
3. Suffix arrays. Where different stretches share an anchor hash, one occurrence of each goes to the block of that
   hash. There, strings whose hash is unique are cut away, the rest is sorted with a two-stage suffix array, and
   neighbours with a common prefix of 200 bytes are covered.

An anchor hash with very many different stretches (``CROWD``) is not gathered in a block: its strings are spread by their
own hashes and counted, which is the same question asked one string at a time.

Texts travel once, to meet what was found in them; only those with open stretches are carried on. Hashes have 64 bits,
and strings meet by anchor and stretch hash together, which makes 128.

Defined cases: a null text counts as empty; a text shorter than 200 bytes keeps all; rows repeated exactly are separate
documents, so their strings occur twice; a null doc_id is an id like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.anchors import GRAM, LENGTH, anchors, prefix_sums, range_hashes
from tributary.llm.common import stage
from tributary.llm.shingles import U, mixed, text_chunks
from tributary.llm.suffixes import share_prefix, suffix_array

CROWD = 20_000
#: Stretches that share a block of the third step, about.
BLOCK = 6_000

ANCHOR = "h long, s long, u long, start int, n int, times int"


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text (u, text) its stretches: anchor hash, stretch hash, first string, number of strings, occurrences.

    A stretch that a text holds twice goes out once with ``times`` 2; the strings that this covers go out as ranges
    with ``times`` 0, joined where they touch.
    """
    names = [f.split()[0] for f in ANCHOR.split(", ")]
    for batch in batches:
        us = batch.column(0).to_numpy(zero_copy_only=False)
        for first, data, offsets in text_chunks(batch.column(1)):
            one, two = prefix_sums(data), prefix_sums(data, 1)
            parts = []
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                if b - a < LENGTH:
                    continue
                p, low, high = anchors(one, a, b)
                h = range_hashes(one, p, p + GRAM).view(np.int64)
                s = mixed(range_hashes(two, low, high + LENGTH) + (p - low).astype(np.uint64)).view(np.int64)
                times = np.ones(len(p), np.int32)
                start, n = (low - a).astype(np.int32), (high - low + 1).astype(np.int32)
                key = h ^ s
                _, where, back, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
                if len(where) < len(p):
                    again = count[back] > 1
                    lo, hi = merge(start[again], start[again] + n[again] - 1 + LENGTH)
                    times[where[count > 1]] = 2
                    keep = np.sort(where)
                    h, s, start, n, times = h[keep], s[keep], start[keep], n[keep], times[keep]
                    h = np.concatenate([h, np.full(len(lo), us[first + i])])
                    s = np.concatenate([s, np.zeros(len(lo), np.int64)])
                    start = np.concatenate([start, lo]).astype(np.int32)
                    n = np.concatenate([n, hi - lo]).astype(np.int32)
                    times = np.concatenate([times, np.zeros(len(lo), np.int32)])
                parts.append((h, s, np.full(len(h), us[first + i]), start, n, times))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], names=names)


def merge(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges [start, end) as maximal ranges; ranges that touch are joined."""
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(start, kind="stable")
    start, end = np.asarray(start, np.int64)[order], np.maximum.accumulate(np.asarray(end, np.int64)[order])
    new = np.concatenate([[True], start[1:] > end[:-1]])
    return start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]


SETTLED = (
    "u long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text binary,"
    " low array<int>, high array<int>, open array<struct<h:long,start:int,n:int,free:boolean>>"
)
DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _digest(raw: bytes, low: np.ndarray, high: np.ndarray) -> tuple[int, int, int, str]:
    sha, at = hashlib.sha256(), 0
    for a, b in zip(low.tolist(), high.tolist()):
        sha.update(raw[at:a])
        at = b
    sha.update(raw[at:])
    return len(raw), int((high - low).sum()), len(low), sha.hexdigest()


def _settle(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Join the ranges found so far. Rows with open stretches keep text and ranges; all others are finished."""
    for f in frames:
        out = []
        for u, doc_id, raw, found in zip(f.u, f.doc_id, f.text, f.found):
            found = [] if found is None else found
            ranges = [r for r in found if r["h"] is None]
            low, high = merge(np.array([r["start"] for r in ranges], np.int64), np.array([r["start"] + r["n"] for r in ranges], np.int64))
            open_ = [{"h": r["h"], "start": r["start"], "n": r["n"], "free": r["times"] == 1} for r in found if r["h"] is not None]
            raw = bytes(raw)
            out.append((u, doc_id, *_digest(raw, low, high), raw if open_ else None, low.tolist(), high.tolist(), open_))
        yield pd.DataFrame(out, columns=["u", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text", "low", "high", "open"])


PIECE = "h long, u long, start int, n int, free boolean, piece binary"


def _cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The text of every open stretch."""
    for f in frames:
        out = []
        for u, raw, open_ in zip(f.u, f.text, f.open):
            raw = bytes(raw)
            out += [(r["h"], u, r["start"], r["n"], r["free"], raw[r["start"] : r["start"] + r["n"] - 1 + LENGTH]) for r in open_]
        yield pd.DataFrame(out, columns=["h", "u", "start", "n", "free", "piece"])


RANGE = "u long, start int, n int"


def _starts(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of the pieces, and for each of their strings its place, its row and its hash."""
    sizes = np.array([len(p) for p in frame.piece])
    data = np.frombuffer(b"".join(map(bytes, frame.piece)), np.uint8)
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    n = sizes - LENGTH + 1
    row = np.repeat(np.arange(len(frame)), n)
    at = np.arange(n.sum()) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n) + begin[row]
    return data, at, row, range_hashes(prefix_sums(data, 1), at, at + LENGTH)


def _sort_block(frame: pd.DataFrame) -> pd.DataFrame:
    """Ranges of free stretches that are covered by strings found twice in the block."""
    frame = frame.reset_index(drop=True)
    data, at, row, name = _starts(frame)
    free = frame.free.to_numpy(bool)[row]
    _, index, back, count = np.unique(name, return_index=True, return_inverse=True, return_counts=True)
    # A string that is settled already is needed once at most, to be found by free ones.
    has_free = np.zeros(len(index), bool)
    has_free[back[free]] = True
    reference = np.zeros(len(at), bool)
    settled = np.flatnonzero(~free)
    seen, where = np.unique(back[settled], return_index=True)
    reference[settled[where]] = has_free[seen]
    use = np.flatnonzero(((count[back] > 1) & free) | reference)
    if not len(use):
        return pd.DataFrame({"u": [], "start": [], "n": []})
    # Runs of neighbouring strings become pieces of one text of 16-bit symbols, with 0 between them.
    split = np.concatenate([[True], (np.diff(at[use]) != 1) | (np.diff(row[use]) != 0)])
    begin = np.flatnonzero(split)
    strings = np.diff(np.append(begin, len(use)))
    length = strings + LENGTH - 1
    room = np.concatenate([[0], np.cumsum(length + 1)])
    text = np.zeros(room[-1], np.uint16)
    inside = np.arange(length.sum()) - np.repeat(np.concatenate([[0], np.cumsum(length)[:-1]]), length)
    text[np.repeat(room[:-1], length) + inside] = data[np.repeat(at[use[begin]], length) + inside].astype(np.uint16) + 1
    place = np.repeat(room[:-1], strings) + (np.arange(len(use)) - np.repeat(begin, strings))
    order = suffix_array(text, LENGTH)
    source = np.full(len(text), -1, np.int64)
    source[place] = use
    order = order[source[order] >= 0]
    equal = share_prefix(text, order, LENGTH)
    hit = np.zeros(len(order), bool)
    hit[:-1] |= equal
    hit[1:] |= equal
    found = source[order[hit]]
    found = np.sort(found[free[found]])
    if not len(found):
        return pd.DataFrame({"u": [], "start": [], "n": []})
    split = np.concatenate([[True], (np.diff(at[found]) != 1) | (np.diff(row[found]) != 0)])
    begin = np.flatnonzero(split)
    last = np.append(begin[1:] - 1, len(found) - 1)
    r = row[found[begin]]
    origin = np.concatenate([[0], np.cumsum([len(p) for p in frame.piece])[:-1]]).astype(np.int64)
    start = frame.start.to_numpy()[r] + at[found[begin]] - origin[r]
    return pd.DataFrame({"u": frame.u.to_numpy()[r], "start": start, "n": at[found[last]] - at[found[begin]] + LENGTH})


def _strings(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each string of crowded anchors by its two hashes."""
    for f in frames:
        if len(f):
            f = f.reset_index(drop=True)
            data, at, row, name = _starts(f)
            other = range_hashes(prefix_sums(data, 2), at, at + LENGTH)
            origin = np.concatenate([[0], np.cumsum([len(p) for p in f.piece])[:-1]]).astype(np.int64)
            yield pd.DataFrame(
                {"a": name.view(np.int64), "b": other.view(np.int64), "u": f.u.to_numpy()[row], "start": f.start.to_numpy()[row] + at - origin[row], "free": f.free.to_numpy()[row]}
            )


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: bytes, bytes removed, maximal removed runs, and the SHA-256 of what is left."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("u", F.xxhash64("doc_id", "text"))
    each = rows.select("u", "text").mapInArrow(_anchor_rows, ANCHOR)
    repeated = each.filter("times > 0").groupBy("h").agg(F.sum("times").alias("k"), F.min("s").alias("x"), F.max("s").alias("y"))
    repeated = repeated.filter("k > 1").select("h", (F.col("x") != F.col("y")).alias("varied"))
    met = each.join(repeated.withColumnRenamed("h", "g"), F.col("h") == F.col("g"), "left").filter("g IS NOT NULL OR times = 0")
    met = stage(met.select("h", "s", "u", "start", "n", "times", F.coalesce("varied", F.lit(False)).alias("varied")), "strings-met")

    varied = met.filter("varied AND times > 0")
    kinds = stage(
        varied.groupBy("h", "s").agg(F.sum("times").alias("times"), F.min(F.struct("u", "start", "n")).alias("rep")), "strings-kinds"
    )
    no = F.lit(None).cast("long")
    whole = met.filter("NOT varied").select("u", no.alias("h"), "start", F.when(F.col("times") == 0, F.col("n")).otherwise(F.col("n") - 1 + LENGTH).alias("n"), F.lit(2).alias("times"))
    twice = kinds.filter("times > 1").select(F.col("h").alias("g"), F.col("s").alias("z"))
    more = varied.join(twice, (F.col("h") == F.col("g")) & (F.col("s") == F.col("z"))).select("u", no.alias("h"), "start", (F.col("n") - 1 + LENGTH).alias("n"), F.lit(2).alias("times"))
    open_ = kinds.select(F.col("rep.u").alias("u"), "h", F.col("rep.start").alias("start"), F.col("rep.n").alias("n"), F.least("times", F.lit(2)).cast("int").alias("times"))
    found = whole.unionByName(more).unionByName(open_.select("u", "h", "start", "n", "times"))
    found = found.groupBy(F.col("u").alias("v")).agg(F.collect_list(F.struct("h", "start", "n", "times")).alias("found"))
    full = rows.select("u", "doc_id", F.encode("text", "UTF-8").alias("text")).join(found, F.col("u") == F.col("v"), "left")
    settled = stage(full.select("u", "doc_id", "text", "found").mapInPandas(_settle, SETTLED), "strings-settled")

    pending = settled.filter("size(open) > 0")
    pieces = pending.dropDuplicates(["u"]).select("u", "text", "open").mapInPandas(_cut, PIECE)
    crowds = kinds.groupBy("h").count()
    total = kinds.count()
    blocks = max(1, -(-total // BLOCK))
    crowded = crowds.filter(F.col("count") > CROWD).select(F.col("h").alias("g"))
    if crowded.limit(1).count():
        crowded = stage(crowded, "strings-crowded")
        strings = pieces.join(crowded, F.col("h") == F.col("g"), "left_semi").mapInPandas(_strings, "a long, b long, u long, start int, free boolean")
        many = strings.groupBy("a", "b").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select(F.col("a").alias("c"), F.col("b").alias("d"))
        by_string = strings.filter("free").join(many, (F.col("a") == F.col("c")) & (F.col("b") == F.col("d"))).select("u", "start", F.lit(LENGTH).alias("n"))
        pieces = pieces.join(crowded, F.col("h") == F.col("g"), "left_anti")
    else:
        by_string = None
    ranges = pieces.groupBy(F.pmod(F.xxhash64("h"), F.lit(blocks)).alias("block")).applyInPandas(_sort_block, RANGE)
    if by_string is not None:
        ranges = ranges.unionByName(by_string)
    per = ranges.groupBy(F.col("u").alias("v")).agg(F.collect_list(F.struct("start", "n")).alias("more"))

    def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for doc, raw, low, high, extra in zip(f.doc_id, f.text, f.low, f.high, f.more):
                extra = [] if extra is None else extra
                a = np.concatenate([np.array(low, np.int64), np.array([r["start"] for r in extra], np.int64)])
                b = np.concatenate([np.array(high, np.int64), np.array([r["start"] + r["n"] for r in extra], np.int64)])
                out.append((doc, *_digest(bytes(raw), *merge(a, b))))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in DIGEST.split(", ")])

    last = pending.select("u", "doc_id", "text", "low", "high").join(per, F.col("u") == F.col("v"), "left")
    done = last.select("doc_id", "text", "low", "high", "more").mapInPandas(finish, DIGEST)
    return settled.filter("size(open) = 0").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").unionByName(done)
