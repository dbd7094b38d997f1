"""Secret scans: base patterns, and novelty measured by a dictionary-primed zstandard coder.

Base patterns find assignments to sensitive names, access keys and hexadecimal runs. Beyond them, a run of key
characters that follows a sensitive word within ``REACH`` characters is a candidate. Its novelty is the number of bytes that it adds to the
compressed text around it, with a dictionary of common identifiers known to the coder beforehand: names, words and
repeated values cost little, random keys cost about what their alphabet holds. A candidate is reported if it
adds at least ``NOVEL`` of its length.

Every text is scanned whole, in the task that reads it; nothing is shuffled. Defined cases: a null text counts as
empty; an empty text has no spans; positions are code points, ends are exclusive; repeated rows give repeated results;
an empty table gives an empty result; other columns stay out of it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGNED = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Words that make a context sensitive.
SENSITIVE = ("secret", "token", "passw", "pwd", "api", "key", "auth", "credential", "bearer", "private", "session", "signature")
SENSITIVE_WORD = re.compile("|".join(SENSITIVE), re.IGNORECASE | re.ASCII)
DIGIT, LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
REACH = 64
AROUND = 512
NOVEL = 0.55

#: Known to the coder before any text.
IDENTIFIERS = (
    "import export const let var function return class public private static final void string integer boolean true"
    " false null none self this new throw catch try finally while for each if else switch case default break continue"
    " config configuration settings environment variable default example sample test placeholder your_api_key_here"
    " changeme username password secret token api_key apikey access_key secret_key private_key client_id client_secret"
    " authorization bearer basic session cookie csrf signature certificate credential database connection host port"
    " user admin root localhost http https www com org net example.com index main init setup build version release"
    " abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0123456789abcdef xxxxxxxxxxxxxxxx 0000000000000000"
)


class Novelty:
    """Marginal compressed bytes of a string in its context."""

    def __init__(self) -> None:
        import zstandard

        known = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.size = zstandard.ZstdCompressor(level=9, dict_data=known, write_checksum=False, write_content_size=False).compress

    def share(self, before: str, candidate: str, after: str) -> float:
        """Bytes added by the candidate for each of its own."""
        around = (before + after).encode()
        return (len(self.size(around + candidate.encode())) - len(self.size(around))) / max(1, len(candidate))


def base_spans(text: str, low: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns; ``low`` is the text in lower case, used to skip patterns fast."""
    out = []
    if any(w in low for w in ASSIGNED):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def novel_spans(text: str, known: list[tuple[int, int, int]], coder: Novelty) -> list[tuple[int, int, int]]:
    """Candidates of letters and digits near a sensitive word, outside the known spans, that do not compress."""
    out = []
    for m in CANDIDATE.finditer(text):
        start, stop, string = m.start(), m.end(), m[0]
        if not (DIGIT.search(string) and LETTER.search(string)) or any(s < stop and start < e for s, _, e in known):
            continue
        if SENSITIVE_WORD.search(text, max(0, start - REACH), start):
            if coder.share(text[max(0, start - AROUND) : start], string, text[stop : stop + AROUND]) >= NOVEL:
                out.append((start, 3, stop))
    return out


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(text: str, coder: Novelty) -> tuple[int, int, int, str, str, int]:
    low = text.lower()
    base = base_spans(text, low)
    more = novel_spans(text, base, coder) if any(w in low for w in SENSITIVE) else []
    n = [sum(1 for s in base if s[1] == k) for k in range(3)]
    return (*n, hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(sorted(base + more)), len(more))


SCHEMA = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long"


def secret_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: base counts, digest of the base spans, all spans, and how many of them novelty added."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = Novelty()
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        for texts in batches:
            yield pd.DataFrame([scan(t or "", coder) for t in texts], columns=names)

    found = F.pandas_udf(run, SCHEMA)
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return own.select("doc_id", found("text").alias("out")).select("doc_id", "out.*")
