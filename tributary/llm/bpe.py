"""Byte-level BPE encoding and decoding as a monoid reduction.

A text is cut into halves until the pieces are short, the pieces are encoded, and neighbours are joined up the
tree. The encoding of a text is the concatenation of the encodings of its blocks, where a block begins at every
white-space character that follows a non-white-space one: each alternative of the pattern ends before such a place
and none looks behind. So a join re-encodes a window around the cut that grows on either side until it begins and
ends at such places (or at the ends of the text); tokens outside it cannot change. Joining is associative, its unit
is the empty text, and decoding concatenates bytes up the same tree.

One row's text is the unit of distribution: rows are encoded independently in the tasks that read them, without a
shuffle. Memory is bounded by the Arrow batch, which is cut by bytes, and by one text.

Defined cases: a null text counts as empty; an empty text has no tokens; unpaired surrogates cannot occur in Spark
strings; text that spells a special token is ordinary text; repeated rows give repeated results; other columns,
whatever their names, are kept apart from the added ones; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.common import pack

LEAF = 4096
WINDOW = 32


class Codec:
    """A vocabulary of ranks with its pattern. ``leaf`` is the length below which a piece is encoded directly."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF):
        import tiktoken

        self.encode_leaf = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.leaf = leaf
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            self.bytes_of[rank] = piece
        self.decimal = [str(i) for i in range(len(self.bytes_of))]

    def encode(self, text: str) -> list[int]:
        return self._encode(text, 0, len(text))

    def _encode(self, text: str, start: int, end: int) -> list[int]:
        if end - start <= self.leaf:
            return self.encode_leaf(text[start:end])
        middle = (start + end) // 2
        return self.join(text, start, middle, end, self._encode(text, start, middle), self._encode(text, middle, end))

    def join(self, text: str, start: int, cut: int, end: int, left: list[int], right: list[int]) -> list[int]:
        """The encoding of ``text[start:end]`` from those of its parts before and after ``cut``."""
        if start == cut or cut == end:
            return left or right
        low, high = block_before(text, start, cut), block_after(text, cut, end)
        tail, head = len(self.encode_leaf(text[low:cut])), len(self.encode_leaf(text[cut:high]))
        return left[: len(left) - tail] + self.encode_leaf(text[low:high]) + right[head:]

    def decode(self, ids: list[int]) -> bytes:
        table = self.bytes_of
        return b"".join([table[i] for i in ids])


def block_before(text: str, start: int, cut: int) -> int:
    """The last block start at or before ``cut``, or ``start``; looked for in windows of growing size."""
    size = WINDOW
    high = cut
    while high > start:
        low = max(start, high - size)
        for i in range(high, low, -1):
            if i < cut and text[i].isspace() and not text[i - 1].isspace():
                return i
        high, size = low, size * 2
    return start


def block_after(text: str, cut: int, end: int) -> int:
    """The first block start after ``cut`` within ``text[cut:end]``, or ``end``."""
    i = cut + 1
    while i < end:
        if text[i].isspace() and not text[i - 1].isspace():
            return i
        i += 1
    return end


@lru_cache(maxsize=2)
def codec(ranks_path: str, pattern: str, leaf: int = LEAF) -> Codec:
    """One codec per Python worker."""
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return Codec(ranks, pattern, leaf)


def tokenizer(name: str) -> tuple[str, str]:
    """Path and pattern of an installed vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def _per_text(frame: DataFrame, name: str, schema: str, fn) -> DataFrame:
    """Add to each row the columns of ``schema`` that ``fn(codec, text)`` returns. ``frame`` has columns row, text."""
    fields = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[tuple[pd.Series]]) -> Iterator[pd.DataFrame]:
        own = codec(*tokenizer(name))
        for texts in batches:
            yield pd.DataFrame([fn(own, t or "") for t in texts], columns=fields)

    udf = F.pandas_udf(run, schema)
    return frame.withColumn("out", udf("text"))


def with_tokens(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """Columns ``row`` (the input row) and ``tokens`` (array of ids) for every document."""
    out = _per_text(pack(docs, text=F.col(text)), name, "ids array<int>", lambda c, t: (c.encode(t),))
    return out.select("row", F.col("out.ids").alias("tokens"))


def from_tokens(frame: DataFrame, name: str, tokens: str = "tokens") -> DataFrame:
    """Add ``decoded`` (binary) to rows with token ids; a null list decodes to no bytes."""

    @F.pandas_udf("binary")
    def decoded(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(*tokenizer(name))
        for part in ids:
            yield pd.Series([own.decode([] if i is None else list(i)) for i in part])

    return frame.withColumn("decoded", decoded(tokens))


def _digest(own: Codec, text: str) -> tuple:
    ids = own.encode(text)
    decimal = own.decimal
    listed = ",".join([decimal[i] for i in ids]).encode()
    return len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(own.decode(ids)).hexdigest()


def token_digests(docs: DataFrame, name: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Number of tokens, digest of the ids and digest of the decoded bytes, computed where the text is."""
    frame = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _per_text(frame, name, schema, _digest).select("doc_id", "out.*")
