"""Hashes of words and word shingles for whole Arrow batches, in numpy.

A word's hash is a polynomial over its bytes, read off two running sums, so a batch needs no Python string per word.
All numbers are unsigned 64-bit and wrap; two different words or shingles share a hash with a chance of 2 ** -64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_random = np.random.default_rng(20240)
BYTE_VALUE = _random.integers(1, 2**63, 256, dtype=np.uint64) | U(1)
BASE = U(0x9E3779B97F4A7C15)
BASE_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 2**64))
PLACE = _random.integers(1, 2**63, 64, dtype=np.uint64) | U(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
CHUNK_BYTES = 1 << 21

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse for i < n."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for k, base in enumerate((BASE, BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def text_chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts of about ``most`` bytes together (one text may be longer): first row, bytes, offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z lower-cased, and the number of the first word of each text (one more at the end)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~BLANK[data]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < n)]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    start[edge] = inside[edge]
    end[edge - 1] = inside[edge - 1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    up, down = powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUE[LOWER[data]] * up, out=sums[1:])
    return mixed((sums[e] - sums[s]) * down[s]), np.searchsorted(s, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than ``width`` make one shingle."""
    words, first = word_hashes(data, offsets)
    w = len(words)
    if w >= width:
        grams = np.zeros(w - width + 1, np.uint64)
        for j in range(width):
            grams += words[j : w - width + 1 + j] * PLACE[j]
        grams = mixed(grams)
    else:
        grams = np.zeros(0, np.uint64)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(grams[a : b - width + 1]))
        elif b > a:
            total = (words[a:b] * PLACE[: b - a]).sum(dtype=np.uint64, keepdims=True)
            out.append(mixed(total + PLACE[40 + b - a : 41 + b - a]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_name(hashes: np.ndarray) -> bytes:
    """Sixteen bytes that name a set of hashes."""
    a = mixed(hashes ^ PLACE[60]).sum(dtype=np.uint64)
    b = mixed(hashes * PLACE[61]).sum(dtype=np.uint64) + U(len(hashes))
    return a.tobytes() + b.tobytes()
