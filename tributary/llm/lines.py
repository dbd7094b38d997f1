"""Line deduplication by an exact set-similarity join.

A line is the set of its five-word shingles, A-Z and other letters lower-cased; a line of fewer words is one shingle.
A line is removed if an earlier line (by doc_id, then line number) has a Jaccard similarity of 0.75 or more with it.

Equal lines are one class, represented by the first line. Most classes have no match, which their words alone tell: the
shingles of a line are put in descending order of their first words, and two lines of similarity t share a shingle that
starts with one of the first |x| - ceil(t |x|) + 1 different words. Classes that share none of these with another one are
settled; neither sets nor ranks are made for them. The others, near classes, go through the join.

The shingles of a near class are ordered by rarity; two sets of similarity t must share one of the first
|x| - ceil(t |x|) + 1 (prefix filter). Classes that share one are candidates if their sizes (length filter) and the
places of the shared shingle (positional filter) still allow t; candidates are verified on the shingles of their
whole lines.

Rarity. All places of shingles in the near classes are counted in ``BUCKETS`` buckets; shingles are ordered by their
bucket's count, in steps of 0.6 %, then by hash. Any fixed order gives the exact join; this one keeps the shingles of
frequent passages out of the prefixes, also where a passage adds a fraction to its bucket only. The table has
BUCKETS entries whatever the size of the corpus.

A shingle that very many classes share. Only the existence of an earlier match counts, so each class is first
verified against the first class with its shingle and the few before it, a number of pairs in proportion to the
rows. Classes that match none of these, in shingles with more classes than that, go through a second join with all
earlier ones there, whose shingles are ordered by their exact counts among the classes concerned. A passage too rare
to stand out in its bucket is ordered behind the rest then, and no longer brings all its classes together.

Only DataFrame functions are used. Defined cases: a null text has no lines; lines without a word are never
compared and stay; rows with one doc_id and one text are one document and are treated alike; of rows with one
doc_id and different texts the one with the smaller text hash comes first; a null doc_id comes before all others;
an empty table gives an empty result; columns of the input, whatever their names, are kept apart from added ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import BLANKS, only_where, pack, stage

WIDTH = 5
BUCKETS = 1 << 16
NEAR = 8

#: A line's words and its place.
PLACE = ["doc", "th", "line"]


def _words(line: Column) -> Column:
    """A line's words. All blanks become spaces first: splitting at one character needs no pattern matching."""
    for blank in BLANKS.replace(" ", "").replace("\n", ""):
        line = F.replace(line, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(line, " "), "")


def _hashes(line: Column) -> Column:
    return F.transform(_words(line), lambda w: F.xxhash64(w))


def _lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc, th, line, l, h``: one row per line with a word; ``l`` is the line, ``h`` are the hashes of its words."""
    own = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(F.col(text)).alias("th"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("t"))
    each = own.select("doc", "th", F.posexplode(F.split("t", "\n", -1)).alias("line", "l"))
    # Trimmed on the left only: that stops at the first word, while btrim walks the whole line.
    filled = each.filter(F.ltrim("l", F.lit(BLANKS)) != "")
    return filled.select("doc", "th", "line", "l", _hashes(F.col("l")).alias("h"))


#: The shingle that starts at word i, whose hash is x; words past the end of a short line are null and left out.
GRAM = "xxhash64(" + ", ".join(["x", *[f"get(h, i + {j})" for j in range(1, WIDTH)]]) + ")"
STARTS = f"greatest(size(h) - {WIDTH - 1}, 1)"


def _shingles(lines: DataFrame, keep: list[str]) -> DataFrame:
    """Replace ``h`` by ``g``, the distinct shingle hashes. ``h`` is used several times, so Spark computes it once."""
    return lines.select(*keep, F.expr(f"array_distinct(transform(slice(h, 1, {STARTS}), (x, i) -> {GRAM}))").alias("g"))


def _near(whole: DataFrame) -> DataFrame:
    """``id`` of the lines that share a shingle with another line where every match shares one: at their greatest first words.

    Common shingles of a match start at a word that at most a quarter of either set's shingles come before, in descending
    order of first words, so at most as many different words. Longer words are greater, as they repeat less often.
    """
    half = lambda w: F.shiftrightunsigned(F.xxhash64(w), 1)
    worth = F.transform(_words(F.col("l")), lambda w: F.when(F.octet_length(w) > 4, half(w)).otherwise(-half(w)))
    split = whole.select("id", worth.alias("h")).select("id", "h", F.expr(STARTS).alias("m"))
    last = "get(sort_array(array_distinct(slice(h, 1, m)), false), m DIV 4)"
    cut = split.select("id", "h", "m", F.expr(f"coalesce({last}, {-(1 << 63) + 1}L)").alias("last"))
    each = cut.select("id", "h", "m", "last", F.posexplode_outer("h").alias("i", "x")).filter("i < m AND x >= last")
    first = each.select(F.expr(GRAM).alias("key"), "id")
    # A line that repeats a shingle stands twice at its key.
    by_key = Window.partitionBy("key")
    both = first.withColumn("a", F.min("id").over(by_key)).withColumn("b", F.max("id").over(by_key))
    return stage(both.filter("a < b").select("id").distinct(), "line-near")


def _ranks(lines: DataFrame) -> Column:
    """A constant array: per bucket the size of its count, 120 steps for each doubling, moved to the top twelve bits; 0 if it is empty."""
    # posexplode_outer: for posexplode Spark would add a filter that computes the words a second time.
    each = lines.select("h", F.posexplode_outer("h").alias("i", "x")).filter(f"i < {STARTS}")
    counted = each.select((F.expr(GRAM).bitwiseAND(BUCKETS - 1)).cast("int").alias("k")).groupBy("k").count()
    steps = dict(map(tuple, counted.select("k", F.floor(120 * F.log2(F.col("count") + 1)).cast("long")).collect()))
    # One constant text that the optimizer turns into an array; BUCKETS separate constants would take seconds.
    return F.split(F.lit(",".join(str(steps.get(k, 0) << 51) for k in range(BUCKETS))), ",").cast("array<bigint>")


def _prefix_size(n: str) -> str:
    """|x| - ceil(0.75 |x|) + 1 in whole numbers."""
    return f"({n} - CAST((3 * {n} + 3) DIV 4 AS INT) + 1)"


def _possible(na: str, nb: str, pa: str, pb: str) -> str:
    """Length and positional filters for a shingle at places pa and pb (from 0) of sets of sizes na and nb."""
    return f"4 * least({na}, {nb}) >= 3 * greatest({na}, {nb}) AND 7 * (1 + least({na} - {pa}, {nb} - {pb}) - 1) >= 3 * ({na} + {nb})"


def near_lines(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Line classes ``c``, named by their first lines, and ``c, h`` of those that may have a match in another class."""
    each = _lines(docs, doc_id, text).groupBy(F.xxhash64("l").alias("id"))
    whole = stage(each.agg(F.min(F.struct(*PLACE)).alias("c"), F.first("l").alias("l")), "line-texts")
    # Only the near ids are held to be looked up; the texts stream past them unsorted.
    found = whole.join(_near(whole).hint("shuffle_hash"), "id", "left_semi").select("c", _hashes(F.col("l")).alias("h"))
    return whole.select("c"), stage(found, "line-near-words")


def postings_of(lines: DataFrame) -> DataFrame:
    """The places of shared prefix shingles of classes (c, h): ``key, c, n, at, nth, many``."""
    order = _ranks(lines)
    # Every bucket of a shingle is in the table; coalesce tells Spark so, which then sorts plain longs.
    steps = lambda h: F.coalesce(F.get(order, h.bitwiseAND(BUCKETS - 1).cast("int")), F.lit(0).cast("bigint"))
    ranked = _shingles(lines, ["c"]).select(
        "c",
        F.size("g").alias("n"),
        F.sort_array(F.transform("g", lambda h: steps(h).bitwiseOR(F.shiftrightunsigned(h, 13)))).alias("r"),
    )
    rows = ranked.select("c", "n", F.posexplode_outer(F.expr(f"slice(r, 1, {_prefix_size('n')})")).alias("at", "key"))
    by_key = Window.partitionBy("key")
    # Most shingles belong to one class: they go before the order within a shingle is sought.
    shared = rows.withColumn("many", F.count(F.lit(1)).over(by_key)).filter("many > 1")
    return stage(shared.withColumn("nth", F.row_number().over(by_key.orderBy("c"))), "line-postings")


def _verified(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """Pairs (later class a, earlier class b) with a similarity of 0.75 or more."""
    a = tokens.select(F.col("c").alias("a"), F.col("g").alias("ga"))
    b = tokens.select(F.col("c").alias("b"), F.col("g").alias("gb"))
    both = pairs.join(a, "a").join(b, "b")
    shared = F.size(F.array_intersect("ga", "gb"))
    return both.filter(7 * shared >= 3 * (F.size("ga") + F.size("gb"))).select("a", "b")


def removed_classes(lines: DataFrame, postings: DataFrame) -> DataFrame:
    """``a``: classes whose first line has an earlier match in another class; ``lines`` are their words (c, h)."""
    by_key = Window.partitionBy("key").orderBy("nth")
    seen = F.struct("c", "n", "at")
    near = F.collect_list(seen).over(by_key.rowsBetween(-NEAR, -1))
    first = F.first(seen).over(by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    close = postings.filter("many > 1").withColumn("o", F.when(F.col("nth") > NEAR + 1, F.concat(near, F.array(first))).otherwise(near))
    close = close.select(F.col("c").alias("a"), "n", "at", F.explode("o").alias("o")).filter(_possible("n", "o.n", "at", "o.at"))
    pairs = stage(close.select("a", F.col("o.c").alias("b")).distinct(), "line-pairs")

    rest = postings.filter(f"many > {NEAR + 1}").select("c").distinct()
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("c")).union(rest).distinct()
    tokens = stage(_shingles(lines.join(wanted.hint("shuffle_hash"), "c", "left_semi"), ["c"]), "line-tokens")

    matched = stage(_verified(pairs, tokens).select("a").distinct(), "line-matched")
    return matched.union(_verified(_crowd_pairs(postings, matched, tokens), tokens).select("a")).distinct()


def _crowd_pairs(postings: DataFrame, matched: DataFrame, tokens: DataFrame) -> DataFrame:
    """Pairs (open class a, earlier class b) that share a prefix shingle, classes being those of the shingles with an open class.

    The shingles of these classes are ordered anew, by their exact counts: the classes of a passage that is common
    here, but looked rare beside the whole corpus, no longer meet in its shingles.
    """
    late = postings.filter(f"nth > {NEAR + 1}").join(matched, F.col("c") == F.col("a"), "left_anti")
    open_ = stage(late.select("key", "c"), "line-open")
    members = postings.join(open_.select("key").distinct(), "key", "left_semi").select("c").distinct()
    grams = tokens.join(members, "c", "left_semi")
    grams = grams.select("c", F.size("g").alias("n"), F.explode("g").alias("s"))
    counts = grams.groupBy("s").count().filter("count > 1")
    # Shingles of one class come first in the order: they take their places in the prefix, but are never met.
    ranked = grams.join(counts, "s").groupBy("c", "n").agg(F.sort_array(F.collect_list(F.struct("count", "s"))).alias("r"))
    alone = ranked.withColumn("alone", F.col("n") - F.size("r"))
    cut = alone.select("c", "n", "alone", F.posexplode(F.expr(f"slice(r, 1, greatest({_prefix_size('n')} - alone, 0))")).alias("i", "x"))
    rows = stage(cut.select(F.col("x.s").alias("key"), "c", "n", (F.col("alone") + F.col("i")).alias("at")), "line-crowds")
    far = rows.join(open_.select("c").distinct(), "c", "left_semi")
    far = far.select("key", F.col("c").alias("a"), F.col("n").alias("na"), F.col("at").alias("pa"))
    old = rows.select("key", F.col("c").alias("b"), F.col("n").alias("nb"), F.col("at").alias("pb"))
    return far.join(old, "key").filter(f"b < a AND {_possible('na', 'nb', 'pa', 'pb')}").select("a", "b").distinct()


def _stays(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc, th, line, stays``: the first line of every class, and once more with ``stays`` false if it has an earlier match."""
    classes, lines = near_lines(docs, doc_id, text)
    gone = stage(removed_classes(lines, postings_of(lines)), "line-removed")
    return classes.select("c.*", F.lit(True).alias("stays")).union(gone.select("a.*", F.lit(False)))


def kept_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc, th, kept``: per document that keeps any, the numbers of its lines that stay (those with a word)."""
    of = lambda stays: F.collect_list(F.when(F.col("stays") == stays, F.col("line")))
    per = _stays(docs, doc_id, text).groupBy("doc", "th").agg(F.array_except(of(True), of(False)).alias("kept"))
    return per.filter(F.size("kept") > 0)


def _with_kept(docs: DataFrame, doc_id: str, text: str, **own) -> DataFrame:
    kept = kept_lines(docs, doc_id, text).select(F.col("doc").alias("d"), F.col("th").alias("h"), "kept")
    rows = pack(docs, i=F.col(doc_id), th=F.xxhash64(F.col(text)), **own)
    return rows.join(kept, F.col("i").eqNullSafe(F.col("d")) & (F.col("th") == F.col("h")), "left").drop("d", "h")


def line_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: lines with a word, how many go and how many stay."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    n = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(r"[^\x20\x09-\x0D][^\n]*+"))
    counted = own.select("doc_id", F.xxhash64("text").alias("th"), n.cast("long").alias("n_lines"))
    stays = F.sum(F.when(F.col("stays"), 1).otherwise(-1))
    kept = _stays(own, "doc_id", "text").groupBy(F.col("doc").alias("d"), F.col("th").alias("h")).agg(stays.alias("k"))
    both = counted.join(kept, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("h")), "left")
    stay = F.coalesce("k", F.lit(0).cast("long"))
    return both.select("doc_id", "n_lines", (F.col("n_lines") - stay).alias("n_removed"), stay.alias("n_kept"))


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with the removed lines cut out of their texts; lines that stay are joined as they were.

    A document that loses its last line with a word goes; one that never had any stays as it is.
    """
    names = docs.columns
    rows = _with_kept(docs, doc_id, text, t=F.col(text))
    split = rows.select("row", "kept", "t", F.split("t", "\n", -1).alias("l"))
    split = split.select(
        "row", "kept", "l", "t",
        F.expr("filter(sequence(0, size(l) - 1), i -> l[i] RLIKE '[^\\\\x20\\\\x09-\\\\x0D]')").alias("full"),
    )
    cut = split.select(
        "row", "kept", "l", "t", F.size("full").alias("n"),
        F.array_except("full", F.coalesce("kept", F.array().cast("array<int>"))).alias("gone"),
    )
    rest = F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size("l") - 1), F.col("gone")), lambda i: F.get("l", i)), "\n")
    stays = F.col("t").isNull() | (F.col("n") == 0) | (F.size("gone") < F.col("n"))
    new = F.when(F.size("gone") == 0, F.col("t")).otherwise(rest)
    done = only_where(cut, stays, F.struct("row", new.alias("new")), "x").select("x.row", "x.new")
    return done.select(*[F.col("new").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in names])
