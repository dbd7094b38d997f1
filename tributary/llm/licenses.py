"""License scans by ordered signature rules.

A rule is a regular expression with a keyword, a label and a priority. Rules see the whole text with each run of blanks
and line ends as one space, in pieces of ``PIECE`` characters with ``MARGIN`` more on both sides; a detection belongs to
the piece that it starts in. A rule meets only the pieces with its own keyword, by an equality join with the table of
rules, whose size is fixed. Overlapping detections are resolved by priority: one that lies within
another of at least its priority is dropped, and of two with the same extent the one with the better rank stays.

Base phrases are counted over the words of the whole text, across lines.

Only DataFrame functions are used. Defined cases: a null text counts as empty; an empty text has no words, places or
labels; labels are empty strings if there are none; rows with one doc_id and one text get the same result each; an
empty table gives an empty result; other columns stay out of it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
EDGES = "".join(chr(c) for c in [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])

#: Base phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Names of licenses as written, as patterns without regard to case, with their labels.
NAMES = (
    ("mit", r"MIT(?:/X11)?"), ("apache", r"Apache(?: Software)?(?: License)?,?(?: Version)? ?(?:1\.1|2\.0|2)?"),
    ("bsd-2-clause", r"(?:BSD[- ]2[- ]Clause|Simplified BSD|FreeBSD)"), ("bsd-3-clause", r"(?:BSD[- ]3[- ]Clause|New BSD|Modified BSD)"),
    ("bsd", r"BSD"), ("agpl", r"(?:AGPL|GNU Affero General Public License)(?:[- ]?v?3(?:\.0)?)?(?:-only|-or-later)?"),
    ("lgpl", r"(?:LGPL|GNU (?:Lesser|Library) General Public License)(?:[- ]?v?[23](?:\.[01])?)?(?:-only|-or-later)?"),
    ("gpl", r"(?:GPL|GNU General Public License)(?:[- ]?v?[123](?:\.0)?)?(?:-only|-or-later)?"),
    ("mpl", r"(?:MPL|Mozilla Public License)(?:[- ,]*(?:v|version )?[12]\.[01])?"), ("epl", r"(?:EPL|Eclipse Public License)(?:[- ]v?[12]\.0)?"),
    ("cddl", r"(?:CDDL|Common Development and Distribution License)(?:[- ]1\.[01])?"), ("isc", r"ISC"), ("zlib", r"zlib(?:/libpng)?"),
    ("boost", r"(?:Boost Software(?: License)?|BSL)(?:[- ]1\.0)?"), ("artistic", r"Artistic(?: License)?(?:[- ][12]\.0)?"),
    ("unlicense", r"Unlicense"), ("wtfpl", r"WTFPL"), ("eupl", r"(?:EUPL|European Union Public License)(?:[- ]1\.[12])?"),
    ("ofl", r"(?:OFL|SIL Open Font License)(?:[- ]1\.1)?"), ("cc0", r"(?:CC0|CC Zero)(?:[- ]1\.0)?"),
    ("cc-by-nc-nd", r"CC[- ]BY[- ]NC[- ]ND(?:[- ][1-4]\.[05])?"), ("cc-by-nc-sa", r"CC[- ]BY[- ]NC[- ]SA(?:[- ][1-4]\.[05])?"),
    ("cc-by-nc", r"CC[- ]BY[- ]NC(?:[- ][1-4]\.[05])?"), ("cc-by-nd", r"CC[- ]BY[- ]ND(?:[- ][1-4]\.[05])?"),
    ("cc-by-sa", r"CC[- ]BY[- ]SA(?:[- ][1-4]\.[05])?"), ("cc-by", r"CC[- ]BY(?:[- ][1-4]\.[05])?"),
    ("gfdl", r"(?:GFDL|GNU Free Documentation License)(?:[- ]1\.[123])?"), ("odbl", r"(?:ODbL|Open Database License)(?:[- ]1\.0)?"),
    ("python", r"(?:PSF|Python Software Foundation)(?: License)?"), ("php", r"PHP(?: License)?(?: v?3\.01?)?"), ("ruby", r"Ruby(?: License)?"),
    ("openssl", r"OpenSSL"), ("postgresql", r"PostgreSQL"), ("ncsa", r"(?:NCSA|University of Illinois/NCSA)"), ("ms-pl", r"(?:MS-PL|Microsoft Public License)"),
    ("proprietary", r"(?:proprietary|commercial|closed[- ]source)"),
)

#: Characters of a piece, and of its margins; no detection of a rule with words between blanks is longer than a margin.
PIECE = 1000
MARGIN = 200

#: How a name is put, with the keyword that any match holds, priority, and confidence.
FORMS = (
    (r"SPDX-License-Identifier:\s*{}", "spdx", 90, 1.0),
    (r"licen[sc]ed under (?:the |a )?(?:terms of (?:the )?)?{}", "licen", 80, 0.95),
    (r"(?:released|distributed|published|provided) under (?:the |a )?(?:terms of (?:the )?)?{}", "d under", 75, 0.9),
    (r"available under (?:the |a )?(?:terms of (?:the )?)?{}", "available under", 75, 0.9),
    (r"(?:under|with|by) (?:the |a )?{} licen[sc]e", "licen", 70, 0.9),
    (r"licen[sc]e\s*[:=]\s*[\"']?{}", "licen", 70, 0.9),
    (r"{} licen[sc]e\b", "licen", 50, 0.7),
    (r"licen[sc]e[sd]? \(?{}\)?", "licen", 45, 0.6),
)

#: Notices without a name.
NOTICES = (
    (r"cc[^0-9A-Za-z]+by", "cc-by", "cc", 40, 0.6),
    (r"general[^0-9A-Za-z]+public[^0-9A-Za-z]+license", "gpl", "general", 40, 0.6),
    (r"all[^0-9A-Za-z]+rights[^0-9A-Za-z]+reserved", "reserved", "reserved", 40, 0.6),
    (r"permission is hereby granted, free of charge", "mit", "permission", 60, 0.9),
    (r"redistribution and use in source and binary forms", "bsd", "redistribution", 60, 0.9),
    (r"(?:dedicated to|in|into) the public domain", "public-domain", "public domain", 60, 0.8),
    (r"(?:may not|must not|do not) (?:copy|reproduce|redistribute|distribute)", "proprietary", "not", 30, 0.5),
    (r"(?:©|\(c\)|copyright)\s*(?:©|\(c\))?\s*(?:19|20)\d\d", "copyright", "20", 20, 0.4),
    (r"(?:©|\(c\)|copyright)\s*(?:©|\(c\))?\s*19\d\d", "copyright", "19", 20, 0.4),
    (r"creative commons attribution", "cc-by", "creative commons", 60, 0.8),
)


def rules() -> list[tuple[int, str, str, str, int, float]]:
    """(rank, label, keyword, pattern, priority, confidence): every form of every name, then the notices."""
    out = []
    for form, keyword, priority, confidence in FORMS:
        for label, name in NAMES:
            pattern = r"(?i)(?<![0-9A-Za-z])" + form.replace("{}", name) + r"(?![0-9A-Za-z])"
            out.append((len(out), label, keyword, pattern, priority, confidence))
    for pattern, label, keyword, priority, confidence in NOTICES:
        out.append((len(out), label, keyword, r"(?i)(?<![0-9A-Za-z])(?:" + pattern + ")", priority, confidence))
    return out


def _phrase(phrase: str) -> str:
    return rf"(?i)(?<!{WORD})" + GAP.join(phrase.split(" ")) + rf"(?!{WORD})"


def _n_words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(EDGES))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, GAP))).cast("long")


def base_counts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, th, n_words, n_base, first_word, last_word, base`` (labels) from whole texts.

    ``contains`` on the lower-cased text decides whether a phrase's expression runs at all; the number of a word is
    the number of words before it.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("th"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    low = own.select("*", F.lower("t").alias("low"))
    found = low.select(
        "doc_id", "th", "t", _n_words(F.col("t")).alias("n_words"),
        *[
            F.when(
                F.expr(" AND ".join(f"contains(low, '{w}')" for w in phrase.split(" "))) & F.col("t").rlike(_phrase(phrase)),
                F.struct(
                    F.regexp_count("t", F.lit(_phrase(phrase))).cast("long").alias("n"),
                    F.expr("substring(t, 1, regexp_instr(t, pattern) - 1)".replace("pattern", "r'" + _phrase(phrase) + "'")).alias("before"),
                    F.regexp_extract("t", "(?s)^(.*)" + _phrase(phrase), 1).alias("until"),
                ),
            ).alias(f"p{k}")
            for k, (phrase, _) in enumerate(PHRASES)
        ],
    )
    ps = [F.col(f"p{k}") for k in range(len(PHRASES))]
    total = sum((F.coalesce(p["n"], F.lit(0).cast("long")) for p in ps), F.lit(0).cast("long"))
    return found.select(
        "doc_id", "th", "n_words", total.alias("n_base"),
        F.least(*[F.when(p.isNotNull(), _n_words(p["before"])) for p in ps]).alias("first_word"),
        F.greatest(*[F.when(p.isNotNull(), _n_words(p["until"])) for p in ps]).alias("last_word"),
        F.array_compact(F.array(*[F.when(p.isNotNull(), F.lit(label)) for p, (_, label) in zip(ps, PHRASES)])).alias("base"),
    )


def rule_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rules(), "rank int, label string, keyword string, pattern string, priority int, confidence double")


def detections(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, th, piece, hits`` with hits an array of (label, start, end, priority, confidence, rank) that survive."""
    spark = docs.sparkSession
    keywords = sorted({r[2] for r in rules()})
    own = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("th"), F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ").alias("t"))
    cut = own.select("doc_id", "th", F.regexp_extract_all("t", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)).alias("c"))
    around = f"transform(c, (x, i) -> concat(coalesce(right(get(c, i - 1), {MARGIN}), ''), x, coalesce(left(get(c, i + 1), {MARGIN}), '')))"
    each = cut.select("doc_id", "th", F.posexplode(F.expr(around)).alias("piece", "l"))
    low = each.select("*", F.lower("l").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.col("low").contains(k), F.lit(k)) for k in keywords]))
    keyed = low.select("doc_id", "th", "piece", "l", F.explode_outer(held).alias("keyword"))
    met = keyed.join(F.broadcast(rule_table(spark)), "keyword").filter(F.expr("l RLIKE pattern"))
    spans = met.select(
        "doc_id", "th", "piece", "rank", "label", "priority", "confidence",
        F.expr("regexp_extract_all(l, pattern, 0)").alias("m"), F.expr("split(l, pattern, -1)").alias("s"),
    )
    lengths = "aggregate(slice({}, 1, {}), 0, (a, x) -> a + char_length(x))"
    starts = lengths.format("s", "i") + " + " + lengths.format("m", "i - 1")
    hits = spans.select(
        "doc_id", "th", "piece",
        F.explode(F.expr(
            f"transform(sequence(1, size(m)), i -> named_struct('label', label, 'start', {starts}, 'end', {starts}"
            " + char_length(m[i - 1]), 'priority', priority, 'confidence', confidence, 'rank', rank))"
        )).alias("hit"),
    )
    per = hits.groupBy("doc_id", "th", "piece").agg(F.collect_set("hit").alias("h"))
    survive = (
        "filter(h, x -> NOT exists(h, y -> y.rank <> x.rank AND y.start <= x.start AND y.end >= x.end AND (y.priority > x.priority"
        " OR (y.priority = x.priority AND (y.end - y.start > x.end - x.start OR y.rank < x.rank)))))"
    )
    begin = f"if(piece = 0, 0, {MARGIN})"
    inside = f"filter({survive}, x -> x.start >= {begin} AND x.start < {begin} + {PIECE})"
    return per.select("doc_id", "th", "piece", F.expr(inside).alias("hits"))


def license_labels(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: words, base places and labels, all labels, and the confidence of the surest detection."""
    base = base_counts(docs, doc_id, text)
    each = detections(docs, doc_id, text).select(F.col("doc_id").alias("d"), F.col("th").alias("h"), F.explode("hits").alias("x"))
    per = each.groupBy("d", "h").agg(F.collect_set("x.label").alias("more"), F.max("x.confidence").alias("surest"))
    both = base.join(per, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("h")), "left")
    empty = F.array().cast("array<string>")
    joined = lambda a: F.array_join(F.array_sort(a), ",")
    return both.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        joined(F.array_distinct("base")).alias("base_labels"),
        joined(F.array_union("base", F.coalesce("more", empty))).alias("labels"),
        F.greatest(F.coalesce("surest", F.lit(0.0)), F.when(F.size("base") > 0, 0.6).otherwise(0.0)).alias("score"),
    )
