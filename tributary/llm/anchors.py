"""Content-defined anchors of byte texts (winnowing), in numpy over Arrow batches.

Of every run of SPAN byte strings of length GRAM the one with the smallest hash is an anchor. Equal strings of
LENGTH = GRAM + SPAN - 1 bytes hold an anchor with the same hash, wherever they stand, so repeats of that length can be
looked for among occurrences of one anchor hash alone.
"""

from __future__ import annotations

import numpy as np

from tributary.llm.shingles import BYTE_VALUE, PLACE, U, mixed, powers

LENGTH = 200
GRAM = 32
SPAN = LENGTH - GRAM + 1


def prefix_sums(data: np.ndarray, salt: int = 0) -> np.ndarray:
    up, _ = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(mixed(BYTE_VALUE + PLACE[salt])[data] * up, out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte strings [start, end), the same for equal strings of equal length."""
    _, down = powers(len(sums))
    return mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * PLACE[30])


def anchors(sums: np.ndarray, start: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the text [start, end): their places, and the first and last start of the strings that they serve.

    A string of LENGTH bytes is served by the leftmost smallest hash in it, so every start has one anchor, and equal
    strings have theirs at the same offset. A text shorter than LENGTH has none.
    """
    n = end - start - GRAM + 1
    none = np.zeros(0, np.int64)
    if n < SPAN:
        return none, none, none
    at = np.arange(start, start + n)
    h = range_hashes(sums, at, at + GRAM)
    runs = n - SPAN + 1
    # Sliding minima from prefix and suffix minima of blocks.
    padded = np.full(-(-n // SPAN) * SPAN, ~U(0))
    padded[:n] = h
    square = padded.reshape(-1, SPAN)
    left = np.minimum.accumulate(square, axis=1).ravel()
    right = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(right[:runs], left[SPAN - 1 : n])
    # The anchor changes where the minimum does, or where it has been left behind.
    change = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (h[: runs - 1] == low[:-1])]))
    hits = np.flatnonzero(_is_minimum(h, low))
    k = np.searchsorted(hits, change)
    todo = np.flatnonzero(h[hits[k]] != low[change])
    while len(todo):
        k[todo] += 1
        todo = todo[h[hits[k[todo]]] != low[change[todo]]]
    return hits[k] + start, change + start, np.append(change[1:] - 1, runs - 1) + start


def _is_minimum(h: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Whether a position is the minimum of any run that covers it, that is, equals the largest run minimum around it."""
    n, runs = len(h), len(low)
    blocks = -(-(n + SPAN) // SPAN) + 1
    padded = np.zeros(blocks * SPAN, np.uint64)
    padded[SPAN - 1 : SPAN - 1 + runs] = low
    square = padded.reshape(blocks, SPAN)
    left = np.maximum.accumulate(square, axis=1).ravel()
    right = np.maximum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    # Runs that cover p begin at p - SPAN + 1 .. p; in the padded array that is p .. p + SPAN - 1.
    return h == np.maximum(right[:n], left[SPAN - 1 : SPAN - 1 + n])
