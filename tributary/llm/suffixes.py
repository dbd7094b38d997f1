"""Suffix arrays by two-stage sorting, in numpy.

A suffix is of type B if it is smaller than its successor, else of type A. Only type B suffixes are sorted directly;
the order of the others is induced by scanning the buckets of first symbols from the smallest: a type A suffix comes
after its successor in sorted order, so when a bucket is complete, the suffixes one place to the left that are greater
take their place in the order in which the scan meets them. A bucket's type A suffixes stand before its type B ones.

The order holds to a depth of ``depth`` symbols, which is all that the common prefixes of that length need.
"""

from __future__ import annotations

import numpy as np

from tributary.llm.shingles import PLACE, U, mixed, powers

WORD = 4


def depth_names(text: np.ndarray, depth: int) -> np.ndarray:
    """For each place a hash of the next ``depth`` symbols, the end counting as zeros."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(depth, text.dtype)]).astype(np.uint64)
    up, down = powers(n + depth)
    sums = np.zeros(n + depth + 1, np.uint64)
    np.cumsum(mixed(padded + PLACE[40]) * up, out=sums[1:])
    return (sums[depth : depth + n] - sums[:n]) * down[:n]


def _direct(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """``at`` sorted by the next ``depth`` symbols, WORD symbols a round.

    After each round only ties go on, and of these only runs in which the next ``depth`` symbols still differ.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(depth + 2 * WORD, text.dtype)]).astype(np.uint64)
    words = np.zeros(n + depth + WORD, np.uint64)
    for j in range(WORD):
        words = (words << U(16)) | padded[j : j + len(words)]
    names = depth_names(text, depth)
    order = at.copy()
    group = np.zeros(len(order), np.int64)
    todo = np.arange(len(order))
    for offset in range(0, depth, WORD):
        if not len(todo):
            break
        own = order[todo]
        sort = np.lexsort((words[own + offset], group[todo])) if offset else np.argsort(words[own], kind="stable")
        own = own[sort]
        order[todo] = own
        g, w = group[todo], words[own + offset]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (w[1:] != w[:-1])])
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(own)))
        group[todo] = todo[np.repeat(begin, size)]
        name = names[own]
        same = np.minimum.reduceat(name, begin) == np.maximum.reduceat(name, begin)
        todo = todo[np.repeat((size > 1) & ~same, size)]
    return order


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes of ``text`` (symbols from 0 to 65535), in order to ``depth`` symbols."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    # The empty suffix is smaller than the last one, which is therefore of type A.
    differs = np.concatenate([text[1:] != text[:-1], [True]])
    up = np.concatenate([text[:-1] < text[1:], [False]])
    index = np.where(differs, np.arange(n), n)
    nearest = np.minimum.accumulate(index[::-1])[::-1]
    is_b = up[nearest]
    b_sorted = _direct(text, np.flatnonzero(is_b), depth)
    first_b = text[b_sorted]
    symbols, counts = np.unique(text, return_counts=True)
    begin = dict(zip(symbols.tolist(), np.concatenate([[0], np.cumsum(counts)[:-1]]).tolist()))
    size = dict(zip(symbols.tolist(), counts.tolist()))
    out = np.full(n, -1, np.int64)
    edges = np.searchsorted(first_b, symbols)
    edges_end = np.searchsorted(first_b, symbols, "right")
    for c, a, z in zip(symbols.tolist(), edges.tolist(), edges_end.tolist()):
        end = begin[c] + size[c]
        out[end - (z - a) : end] = b_sorted[a:z]
    fill = dict(begin)
    out[fill[int(text[n - 1])]] = n - 1
    fill[int(text[n - 1])] += 1
    for c in symbols.tolist():
        low, high = begin[c], begin[c] + size[c]
        # Type A suffixes of this bucket that follow one of the same bucket: runs of one symbol, level by level.
        level = out[low : fill[c]]
        while len(level):
            before = level[level > 0] - 1
            before = before[(text[before] == c) & ~is_b[before]]
            out[fill[c] : fill[c] + len(before)] = before
            fill[c] += len(before)
            level = before
        done = out[low:high]
        before = done[done > 0] - 1
        before = before[(text[before] > c) & ~is_b[before]]
        heads = text[before]
        sort = np.argsort(heads, kind="stable")
        before, heads = before[sort], heads[sort]
        for d, a, z in zip(*_runs(heads)):
            out[fill[d] : fill[d] + z - a] = before[a:z]
            fill[d] += z - a
    return out


def _runs(values: np.ndarray) -> tuple[list, list, list]:
    if not len(values):
        return [], [], []
    begin = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return values[begin].tolist(), begin.tolist(), np.append(begin[1:], len(values)).tolist()


def share_prefix(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each neighbour pair of ``order`` whether the next ``depth`` symbols are equal, compared symbol by symbol."""
    n = len(text)
    if len(order) < 2:
        return np.zeros(0, bool)
    padded = np.concatenate([text, np.zeros(depth + 2 * WORD, text.dtype)]).astype(np.uint64)
    words = np.zeros(n + depth + WORD, np.uint64)
    for j in range(WORD):
        words = (words << U(16)) | padded[j : j + len(words)]
    a, b = order[:-1], order[1:]
    equal = np.ones(len(a), bool)
    live = np.arange(len(a))
    for offset in [*range(0, depth - WORD, WORD), depth - WORD]:
        live = live[words[a[live] + offset] == words[b[live] + offset]]
    equal[:] = False
    equal[live] = True
    return equal
