"""Each operator against a plain version of the same definition, on the smallest tables and on odd rows."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from tributary.llm import bpe, graph, hashing, language, licenses, lines, mixing, near, quality, secrets, substrings, suffixes

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK = r"[^\x20\x09-\x0D]+"


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def tuples(df, *names):
    return sorted(map(tuple, df.select(*names).collect()), key=repr)


def shingles(words, width=5):
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) or frozenset([tuple(words)])


def alike(a, b):
    n = len(a & b)
    return 100 * n >= 75 * (len(a) + len(b) - n)


# 1


def test_nearest_recall_and_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = hashing.nearest(df, lambda i: i % 50 == 0).toPandas()
    rows = df.collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], float)
    hit = 0
    for q, g in got.groupby("query_id"):
        i = int(np.flatnonzero(ids == q)[0])
        score = x @ x[i] / (np.linalg.norm(x, axis=1) * np.linalg.norm(x[i]))
        score[i] = -9
        best = ids[np.lexsort((ids, -score))[:5]]
        hit += len(set(best) & set(g.vec_id))
        assert sorted(g["rank"]) == [1, 2, 3, 4, 5]
        for v, s in zip(g.vec_id, g.score):
            assert abs(score[np.flatnonzero(ids == v)[0]] - s) < 1e-12
    assert hit >= 0.9 * 5 * (ids % 50 == 0).sum()


def test_nearest_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = tuples(hashing.nearest(df, lambda i: i % 50 == 0), "query_id", "rank", "vec_id", "score")
    assert got == [(0, 1, 1, 1.0), (0, 2, 50, 1.0), (0, 3, 2, 0.0), (50, 1, 0, 1.0), (50, 2, 1, 1.0), (50, 3, 2, 0.0)]
    assert hashing.nearest(df.limit(0), lambda i: i % 50 == 0).count() == 0


def test_nearest_of_repeated_rows(spark):
    """Repeated rows change nothing; an id with several vectors takes one place."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(60)]
    rows += [(0, [x + 0.001 * j for x in rows[0][1]]) for j in range(1, 9)] + [(i, rows[50][1]) for i in range(60, 64)]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = {}
    for q in (0, 50):
        score = (x @ x[ids == q].T).max(axis=1)
        best = {i: score[ids == i].max().round(12) for i in set(ids.tolist()) - {q}}
        want[q] = sorted(best, key=lambda i: (-best[i], i))[:5]
    for times in (1, 2, 6):
        df = spark.createDataFrame(rows * times, "vec_id long, embedding array<double>")
        got = tuples(hashing.nearest(df, lambda i: i % 50 == 0), "query_id", "rank", "vec_id")
        assert got == sorted(((q, r, i) for q, w in want.items() for r, i in enumerate(w, 1)), key=repr)


# 2


def plain_lines(rows):
    """Removed line numbers by document; documents with one id and one text are one."""
    seen, gone, total = [], collections.Counter(), collections.Counter()
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        for line in (text or "").lower().split("\n"):
            words = re.findall(BLANK, line)
            if words:
                s = shingles(words)
                total[doc_id, text] += 1
                gone[doc_id, text] += any(alike(s, t) for t in seen)
                seen.append(s)
    return sorted(((d, total[d, t], gone[d, t]) for d, t in rows), key=repr)


def test_lines(docs):
    some = docs.filter("doc_id < 120")
    assert tuples(lines.line_counts(some), "doc_id", "n_lines", "n_removed") == plain_lines(texts(some))


def test_lines_odd(odd, nothing):
    unique = odd.filter("doc_id IS NOT NULL OR text IS NOT NULL")
    assert tuples(lines.line_counts(unique), "doc_id", "n_lines", "n_removed") == plain_lines(texts(unique))
    cut = lines.without_repeats(unique)
    assert cut.columns == unique.columns
    kept = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert kept[None].startswith("Caf") and kept[3] is None and kept[4] == ""
    assert "\n" not in (kept.get(1) or "") and 2 not in kept
    assert lines.without_repeats(nothing).count() == 0 and lines.line_counts(nothing).count() == 0


def test_lines_in_crowds(spark, monkeypatch):
    """Many classes that share a shingle: those beyond the near ones are found too."""
    monkeypatch.setattr(lines, "NEAR", 2)
    base = [f"w{i}" for i in range(20)]
    rows = []
    for k in range(40):
        words = list(base)
        words[k % 20] = f"x{k}"
        if k % 3 == 0:
            words[(k * 7 + 3) % 20] = f"y{k}"
        rows.append((k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert tuples(lines.line_counts(df), "doc_id", "n_lines", "n_removed") == plain_lines(rows)


def test_lines_of_shared_passages(spark):
    """Every line holds two of six passages, so crowds share passages without being alike; some lines are near copies."""
    passages = [[f"p{p}w{i}" for i in range(20)] for p in range(6)]
    rows = []
    for k in range(360):
        own = [f"o{k // 2 if k % 5 == 0 else k}x{i}" for i in range(4)]
        rows.append((k, " ".join(passages[k % 6] + own + passages[(k * 7 // 6 + 1) % 6])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert tuples(lines.line_counts(df), "doc_id", "n_lines", "n_removed") == plain_lines(rows)
    # A passage that all lines share, in lines that are alike only now and then.
    rows = [(k, " ".join(passages[0] + [f"o{k * k % 97}x{i}" for i in range(3 + k % 9)])) for k in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert tuples(lines.line_counts(df), "doc_id", "n_lines", "n_removed") == plain_lines(rows)


def test_line_ranks_tell_counts_apart(spark):
    """Buckets whose counts have the same number of binary digits differ in rank: a passage need not double its bucket to stand out."""
    rows = [(k, "a b c d e") for k in range(7)] + [(k, "f g h i j") for k in range(7, 12)]
    each = lines._lines(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    ranks = spark.range(1).select(lines._ranks(each).alias("r")).first()["r"]
    assert len(ranks) == lines.BUCKETS and len({r for r in ranks if r}) == 2 and min(ranks) == 0 and max(ranks) > 0


def test_lines_settled_by_their_words_make_no_sets(spark):
    """Equal lines and lines with nothing near them are settled by words; a match survives any lost quarter, repeated words and blanks."""
    base = [f"word{i:02}" for i in range(40)]
    lost = [" ".join(base[k:k + 31]) for k in range(0, 10, 3)] + [" ".join(base)]
    few = ["la de la de la de la de", "la de la de  la de la de", "de la de la de la de la", "a b c d", "a b\tc d ", "a b c e"]
    alone = [" ".join(f"only{k}x{i}" for i in range(30)) for k in range(20)]
    rows = list(enumerate(lost + few + alone + alone))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert tuples(lines.line_counts(df), "doc_id", "n_lines", "n_removed") == plain_lines(rows)
    classes, near = lines.near_lines(df, "doc_id", "text")
    assert classes.count() == len(lost + few + alone)
    assert len(lost) + 5 <= near.count() <= len(lost + few)


def test_lines_of_repeated_rows_in_crowds(spark, monkeypatch):
    """Rows of documents that occur twice do not count twice where crowded shingles are ordered anew."""
    monkeypatch.setattr(lines, "NEAR", 2)
    rows = [(k, " ".join([f"w{i}" if i != k % 20 else f"x{k}" for i in range(20)] + ["\x00" * (k % 3 + 1)])) for k in range(24)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert tuples(lines.line_counts(df), "doc_id", "n_lines", "n_removed") == plain_lines(rows)


# 3


def test_mix_meets_targets(docs):
    got = mixing.mix(docs).toPandas()
    assert len(got) == docs.count()
    per = got.groupby("source", dropna=False).agg(size=("size", "sum"), own=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    assert (per["size"] == per.own).all()
    assert (got.taken <= 3 * got["size"]).all()
    assert (abs(per.taken - per.target) <= got["size"].max()).all()
    assert abs(per.target.sum() - got["size"].sum()) < 1e-6 or (per.target <= 3 * per.own + 1e-6).all()
    again = mixing.mix(docs.repartition(7)).toPandas()
    assert sorted(map(tuple, got[["doc_id", "taken"]].values)) == sorted(map(tuple, again[["doc_id", "taken"]].values))


def test_targets_by_hand(spark):
    df = spark.createDataFrame([("a", 100, 1), ("b", 10, 1), (None, 1000, 1)], "source string, size long, n long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    # a is held to 300 and b to 30, which leaves 780 of 1110 for the source that comes last
    assert got == {"a": 300.0, "b": 30.0, None: pytest.approx(780.0)}


def test_blocks_and_odd_rows(spark, odd, nothing):
    df = spark.range(3000).selectExpr("id AS doc_id", "concat('s', id % 2) AS source", "repeat('w ', CAST(1 + id % 37 AS INT)) AS text")
    sized = df.select("doc_id", "source", mixing.text_size(df.text).alias("size"))
    got = mixing.copies(sized, block=64).toPandas()
    per = got.assign(t=got.copies * got["size"]).groupby("source").agg(t=("t", "sum"), g=("target", "first"))
    assert (abs(per.t - per.g) <= 5).all()
    assert mixing.mix(odd).count() == odd.count()
    out = mixing.mixed(odd)
    assert out.columns == odd.columns
    assert out.count() == mixing.mix(odd).agg({"copies": "sum"}).first()[0]
    assert mixing.mix(nothing).count() == 0 and mixing.mixed(nothing).count() == 0


def test_flight_keeps_sums():
    rng = np.random.default_rng(1)
    p, size = rng.uniform(0.1, 0.9, 200), rng.integers(0, 50, 200).astype(float)
    q = mixing.flight(p, size, rng.uniform(size=500))
    assert ((q > 0) & (q < 1)).sum() <= 2
    assert abs(q.sum() - p.sum()) < 1e-6 and abs(q @ size - p @ size) < 1e-4


# 4


def plain_repeats(rows, length=200):
    count = collections.Counter()
    raw = [(d, (t or "").encode()) for d, t in rows]
    for _, b in raw:
        count.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for d, b in raw:
        cover = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                cover[i + 1 : i + 1 + length] = True
        keep = bytes(c for c, gone in zip(b, cover[1:-1]) if not gone)
        out.append((d, len(b), int(cover.sum()), int((cover[1:] & ~cover[:-1]).sum()), hashlib.sha256(keep).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("crowd", [20_000, 1])
def test_repeated_strings(docs, monkeypatch, crowd):
    monkeypatch.setattr(substrings, "CROWD", crowd)
    some = docs.filter("doc_id < 60")
    got = tuples(substrings.without_repeats(some), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == plain_repeats(texts(some))


def test_repeated_strings_odd(odd, nothing, spark):
    small = odd.filter("doc_id <> 5 OR doc_id IS NULL")
    own = spark.createDataFrame([(1, "ab" * 300), (2, "x" * 199 + "y" * 150), (3, "z" + "x" * 199 + "y" * 150 + "q"), (4, "a" * 200)], "doc_id long, text string")
    for df in (small, own):
        assert tuples(substrings.without_repeats(df), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == plain_repeats(texts(df))
    assert substrings.without_repeats(nothing).count() == 0


def test_suffix_arrays():
    rng = np.random.default_rng(3)
    for _ in range(100):
        t = rng.integers(0, rng.integers(2, 6), rng.integers(1, 60)).astype(np.uint16)
        b = t.tolist()
        assert suffixes.suffix_array(t, 100).tolist() == sorted(range(len(b)), key=lambda i: b[i:])


# 5


def test_secrets(docs, odd, nothing):
    for df in (docs, odd):
        for r in secrets.secret_spans(df).join(df.select("doc_id", "text").distinct(), "doc_id").collect():
            t = r["text"] or ""
            key = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password")
            assert re.fullmatch(key, "PassWord")
            pattern = re.compile(r"""(?a:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
            spans = [(m.start(), 0, "assign", m.end()) for m in pattern.finditer(t) if len(m[1]) >= 6]
            spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
            spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
            listed = ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(spans))
            assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
            assert set(filter(None, listed.split(","))) <= set(r["spans"].split(","))
    assert secrets.secret_spans(odd).count() == odd.count() and secrets.secret_spans(nothing).count() == 0


def test_novel_strings():
    coder = secrets.Novelty()
    key = "q7Zx2LmP9vRt4KsW8nYb3HdJ"
    found = secrets.scan(f"the private signing value is {key} and no more", coder)
    assert f"novel:29:{29 + len(key)}" in found[4]
    assert secrets.scan("the private thing is aaaaaaaaaaaaaaaaaaaaaa1 and no more", coder)[5] == 0
    assert secrets.scan(f"plain words are here, then {key} and no more", coder)[5] == 0
    assert secrets.scan("", coder)[:3] == (0, 0, 0)


# 6


def test_language(spark, odd, nothing):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(df)
    got = language.predict(df, model).join(df.select("doc_id", "lang"), "doc_id").filter("held_out AND lang IS NOT NULL").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.97
    rows = {(r["doc_id"], r["lang_pred"], r["score"]) for r in language.predict(odd, model).collect()}
    assert {(3, "und", 0.0), (4, "und", 0.0), (6, "und", 0.0)} <= rows
    assert all(0 <= s <= 1 for _, _, s in rows)
    assert language.fit(nothing) is None
    assert {r["lang_pred"] for r in language.predict(odd, None).collect()} == {"und"}


def test_language_of_short_and_unspaced_texts(spark):
    """Languages whose texts all have six words, one without spaces, and one with blank texts alone."""
    rng = np.random.default_rng(8)
    letters = {"aa": "abcdefg", "bb": "hijklmn", "cc": "opqrstu", "zh": "天地玄黄宇宙洪荒日月盈昃", "ja": "いろはにほへとちりぬるを"}
    lexicon = {k: ["".join(rng.choice(list(v), rng.integers(2, 6))) for _ in range(60)] for k, v in letters.items()}
    rows = []
    for i in range(1000):
        lang = list(letters)[i % 5]
        words = rng.choice(lexicon[lang], 40 if lang == "cc" else 6)
        rows.append((i, ("" if lang in ("zh", "ja") else " ").join(words), lang))
    rows += [(1000 + i, " ", "none") for i in range(10)] + [(None, "abc", "aa")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df)
    assert model[0] == sorted(letters)
    got = language.predict(df, model).join(df.select("doc_id", "lang"), "doc_id").filter("held_out AND lang <> 'none'").toPandas()
    right = (got.lang == got.lang_pred).groupby(got.lang).mean()
    assert len(right) == 5 and right.min() > 0.95
    assert language.predict(df, model).filter("held_out IS NULL").isEmpty()
    long = spark.createDataFrame([(1, "x" * 300_000, "aa"), (2, "天地" * 100_000, "zh")], df.schema)
    assert {r["lang_pred"] for r in language.predict(long, model).collect()} <= set(letters)


def test_chunks_equal_one_chain():
    rng = np.random.default_rng(5)
    move, emit = rng.normal(size=(3, 3)), rng.normal(size=(150, 3))
    first = np.array([0, 97, 97, 150])
    got = language.posteriors(emit, first, move)
    for k, (a, b) in enumerate(zip(first, first[1:])):
        if a == b:
            assert not got[k].any()
            continue
        up, down = np.exp(emit[a:b]), np.exp(move)
        f = [np.ones(3) @ down * up[0]]
        for e in up[1:]:
            f.append(f[-1] @ down * e)
        g = [np.ones(3)]
        for e in up[:0:-1]:
            g.append(down @ (e * g[-1]))
        post = np.array(f) * np.array(g[::-1])
        assert np.allclose(got[k], (post / post.sum(axis=1, keepdims=True)).mean(axis=0))


# 7


def test_quality_counts(docs, odd, nothing):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for df in (docs, odd):
        want = []
        for d, t in texts(df):
            t = t or ""
            w = re.findall(BLANK, t)
            c = collections.Counter(zip(w, w[1:], w[2:]))
            cover = {k for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
            own = [x for x in t.split("\n") if re.search(BLANK, x)]
            failed = len(w) < 50 or 100 * len(cover) > 50 * len(w)
            want.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(own) - len(set(own)), len(cover), failed))
        assert tuples(quality.scored(df), *names) == sorted(want, key=repr)
    assert quality.scored(nothing).count() == 0
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert kept.count() == quality.scored(docs).filter("kept").count()


def test_weak_supervision_finds_good_rules():
    rng = np.random.default_rng(2)
    good = rng.uniform(size=4000) < 0.8
    right = (0.95, 0.9, 0.85)
    votes = [tuple(int(v) for v in np.where(rng.uniform(size=3) < right, 1, -1) * (1 if g else -1)) for g in good]
    model = quality.fit(sorted(collections.Counter(votes).items()), ["a", "b", "c"])
    assert abs(model.prior - 0.8) < 0.05
    assert all(abs(model.right_if_good[k] - r) < 0.05 for k, r in zip("abc", right))


# 8


def test_license_base(docs, odd, nothing):
    for df in (docs, odd):
        want = []
        for d, t in texts(df):
            w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UP))
            at, labels = [], set()
            for phrase, label in licenses.PHRASES:
                p = phrase.split()
                hits = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
                at += hits
                labels |= {label} if hits else set()
            want.append((d, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))))
        assert tuples(licenses.license_labels(df), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == sorted(want, key=repr)
    assert licenses.license_labels(nothing).count() == 0


def test_license_rules(spark):
    rows = [
        (1, "Licensed under the Apache License, Version 2.0 (the License)"), (2, "x\nSPDX-License-Identifier: GPL-3.0-or-later"),
        (3, "CC BY-NC 4.0 license. cc-by\ncc, by"), (4, "General  Public\nLicense; all rights reserved"), (5, "nothing here"),
        (6, "Permission is hereby granted, free of charge"),
    ]
    got = {r["doc_id"]: r for r in licenses.license_labels(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["labels"] == "apache" and got[2]["labels"] == "gpl" and got[6]["labels"] == "mit"
    assert "cc-by-nc" in got[3]["labels"].split(",") and (got[3]["n_base"], got[3]["first_word"], got[3]["last_word"]) == (3, 0, 8)
    assert got[4]["base_labels"] == "gpl,reserved" and got[5]["labels"] == "" and got[5]["score"] == 0.0
    assert len(licenses.rules()) > 200


def test_license_rules_in_whole_texts(spark):
    """Every keyword lets its rules in, line ends are blanks, and pieces do not cut a notice."""
    rows = [
        (1, "Released under MIT", "mit"), (2, "Distributed under GPL-3.0", "gpl"), (3, "available under a BSD thing", "bsd"),
        (4, "You may not copy this", "proprietary"), (5, "do not\ndistribute", "proprietary"), (6, "Released under the\nMozilla Public License 2.0", "mpl"),
        (7, "It is distributed\n  under the\n terms of\r\nthe Eclipse\nPublic\nLicense", "epl"), (8, "wunder bar", ""),
    ]
    for k, n in enumerate(range(970, 1010, 3)):
        rows.append((100 + k, "z" * n + " published under the Mozilla Public License 2.0 " + "z" * 1500, "mpl"))
    got = licenses.license_labels(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"))
    assert {r["doc_id"]: r["labels"] for r in got.collect()} == {d: label for d, _, label in rows}


# 9


def plain_components(rows):
    sets = [(d, shingles(re.findall(BLANK, (t or "").translate(UP)))) for d, t in rows]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and alike(a, b):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, s) in enumerate(sets):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(s), least.get(root(i))) for i, (d, s) in enumerate(sets)), key=repr)


def test_near_duplicates(docs, odd, nothing, monkeypatch):
    for df in (docs, odd):
        assert tuples(near.near_groups(df), "doc_id", "n_shingles", "component_id") == plain_components(texts(df))
    assert near.near_groups(nothing).count() == 0
    kept = near.keep_first(odd)
    assert kept.columns == odd.columns
    # One of the two equal rows, not 8 or the row without id (near copies of 2), every row without words.
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "4", "5", "6", "7", "None"]


def test_near_copies_in_one_group(spark, monkeypatch):
    """A group larger than a block is cut and joined again."""
    monkeypatch.setattr(near, "GROUP", 8)
    monkeypatch.setattr(near, "BLOCK", 4)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for k in range(60):
        words = list(base)
        words[(k * 3) % 200] = f"x{k}"
        rows.append((k + 10, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert tuples(near.near_groups(df), "doc_id", "n_shingles", "component_id") == plain_components(rows)


def test_keep_first_of_shared_ids(spark):
    """Several null ids, and one id with two texts, of which one may be a near copy of another document."""
    text = lambda k: " ".join(f"{k}{i}" for i in range(60))
    rows = [
        (None, text("a")), (None, text("b")), (None, text("b")), (None, text("c") + " x"), (3, text("c")), (7, text("d")),
        (7, text("e")), (7, text("c") + " y"), (9, text("e") + " z"), (None, None), (None, None),
    ]
    kept = [(r["doc_id"], r["text"]) for r in near.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    want = [(None, text("a")), (None, text("b")), (3, text("c")), (7, text("d")), (7, text("e")), (None, None), (None, None)]
    assert sorted(kept, key=repr) == sorted(want, key=repr)


def test_near_star(spark):
    """1,000 variants of one text, most of them similar to it alone."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(200)]
    rows = [(5000, " ".join(base))]
    for k in range(1000):
        words = list(base)
        for j, at in enumerate(rng.choice(np.arange(4, 196, 8), 5, replace=False)):
            words[at] = f"x{k}_{j}"
        rows.append((k, " ".join(words)))
    want = plain_components(rows)
    assert len({c for _, _, c in want}) == 1
    assert tuples(near.near_groups(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "n_shingles", "component_id") == want


def test_near_in_crowded_regions(spark):
    """Pairs whose copies share a long passage with 300 unrelated documents."""
    passage = [f"p{i}" for i in range(150)]
    rows = []
    for k in range(300):
        own = [f"d{k // 2 if k < 100 else k}_{i}" for i in range(90)]
        if k < 100 and k % 2:
            own[10], own[45], own[80] = f"y{k}", f"y{k}b", f"y{k}c"
        rows.append((k, " ".join(own[:45] + passage + own[45:])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert tuples(near.near_groups(df), "doc_id", "n_shingles", "component_id") == plain_components(rows)


# 10


def test_tokens(docs, odd, nothing):
    name = "byte_bpe_multi_50k.tiktoken"
    own = bpe.codec(*bpe.tokenizer(name))
    for df in (docs, odd):
        want = []
        for d, t in texts(df):
            ids = own.encode_leaf(t or "")
            want.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
        assert tuples(bpe.token_digests(df, name), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    assert bpe.token_digests(nothing, name).count() == 0
    back = bpe.from_tokens(bpe.with_tokens(odd, name), name)
    assert all(bytes(r["decoded"]) == (r["row"]["text"] or "").encode() for r in back.collect())


def test_joins_at_every_cut():
    own = bpe.codec(*bpe.tokenizer("byte_bpe_multi_50k.tiktoken"), leaf=3)
    for t in ("a  b   c\n\n d's'll  中文 x1y2   ", "nospaceatall" * 9, "   ", " \n\t a", "don't  '  's    end", "\U0001f600\U0001f600 ́e"):
        assert own.encode(t) == own.encode_leaf(t)
        assert own.decode(own.encode(t)) == t.encode()
        for cut in range(len(t) + 1):
            assert own.join(t, 0, cut, len(t), own.encode_leaf(t[:cut]), own.encode_leaf(t[cut:])) == own.encode_leaf(t)


def test_components_of_any_shape(spark, monkeypatch):
    chain = [(f"c{i:03}", f"c{i + 1:03}") for i in range(70)]
    star = [("hub", f"s{i:03}") for i in range(90)]
    rng = random.Random(5)
    loose = [(f"n{rng.randrange(300):03}", f"n{rng.randrange(300):03}") for _ in range(170)]
    rows = [(a.encode(), b.encode()) for a, b in chain + star + loose]
    around = {x: {x} for ab in rows for x in ab if ab[0] != ab[1]}
    for a, b in rows:
        if a != b and around[a] is not around[b]:
            both = around[a] | around[b]
            around.update(dict.fromkeys(both, both))
    want = {x: min(s) for x, s in around.items()}
    df = spark.createDataFrame(rows + [(None, b"x"), (b"x", None), (b"y", b"y")], "a binary, b binary")
    for chunk in (graph.CHUNK, 40):
        monkeypatch.setattr(graph, "CHUNK", chunk)
        assert {bytes(r.node): bytes(r.label) for r in graph.components(df).collect()} == want
    assert graph.components(df.limit(0)).count() == 0
