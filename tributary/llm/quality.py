"""Quality rules as weak supervision.

Each rule looks at a few counts of a text and votes that it is good (1), bad (-1) or abstains (0). No rule
decides alone: expectation-maximisation over the counts of vote patterns estimates how often each rule is right
for good and for bad documents, and a document is judged by its posterior probability of being good. The patterns
number at most 3 ** len(RULES), whatever the size of the corpus, and are counted over all documents; only they
reach the driver.

Only DataFrame functions are used. Defined cases: a null text counts as empty; an empty text has zero in every
count and fails the base rules; an empty table gives an empty result; repeated rows are judged alike; extra
columns of any name are kept as they are.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import only_where, pack, stage, text_or_empty, words

MIN_WORDS = 50
SYMBOLS = r"[#*$%&|<>]+"
HAS_WORD = r"[^\x20\x09-\x0D]"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_letters", "n_lines", "n_dup_lines", "n_repeat_words")


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts of COUNTS to rows that have the column ``text``.

    Repeated three-word windows are found without leaving the row: the hash of every window is packed with its
    position into one integer, the integers are sorted, and equal hashes then stand side by side. The packed hash
    is a prefix; the full 64-bit hashes are compared before a window counts.

    Every intermediate column is used more than once by the next projection, which keeps Spark from copying its
    expression into the per-element functions.
    """
    keep = [c for c in df.columns if c != text]
    d = df.select(*keep, text_or_empty(text).alias("_t"))
    d = d.select(
        *keep,
        words(F.col("_t")).alias("_w"),
        F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(HAS_WORD)).alias("_l"),
        (F.char_length("_t") - F.char_length(F.regexp_replace("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.char_length(F.regexp_replace("_t", r"\P{L}+", "")).cast("long").alias("n_letters"),
    )
    keep += ["n_symbols", "n_letters"]
    d = d.select(
        *keep,
        F.size("_w").cast("long").alias("n_words"),
        F.char_length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.transform("_w", lambda x: F.xxhash64(x)).alias("_h"),
    )
    keep += ["n_words", "word_chars", "n_lines", "n_dup_lines"]
    d = d.select(
        *keep,
        # bits that a position needs
        F.expr("CAST(length(bin(size(_h))) AS INT)").alias("_b"),
        F.expr(
            "slice(zip_with(zip_with(_h, slice(_h, 2, size(_h)), (a, b) -> struct(a, b)), slice(_h, 3, size(_h)),"
            " (p, c) -> coalesce(xxhash64(p.a, p.b, c), 0L)), 1, greatest(size(_h) - 2, 0))"
        ).alias("_g"),
    )
    d = d.select(
        *keep,
        "_b",
        "_g",
        F.expr("sort_array(transform(_g, (h, i) -> coalesce(shiftleft(shiftright(h, _b), _b) | CAST(i AS BIGINT), 0L)))").alias("_s"),
    )
    d = d.select(
        *keep,
        F.expr(
            "sort_array(array_distinct(flatten(filter(zip_with(_s, slice(_s, 2, size(_s)), (x, y) -> CASE WHEN"
            " shiftright(x, _b) = shiftright(y, _b)"
            " AND _g[CAST(x - shiftleft(shiftright(x, _b), _b) AS INT)] = _g[CAST(y - shiftleft(shiftright(y, _b), _b) AS INT)]"
            " THEN array(x - shiftleft(shiftright(x, _b), _b), y - shiftleft(shiftright(y, _b), _b)) END), p -> p IS NOT NULL))))"
        ).alias("_p"),
    )
    return d.select(
        *keep,
        F.expr("aggregate(zip_with(_p, slice(_p, 2, size(_p)), (x, y) -> least(3L, coalesce(y - x, 3L))), 0L, (s, x) -> s + x)").alias("n_repeat_words"),
    )


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("int")


def rules() -> dict[str, Column]:
    """Votes from the counts. Thresholds are shares per hundred, so they hold at any length."""
    n, c = F.col("n_words"), F.col("word_chars")
    sym, dup, rep, lines = F.col("n_symbols"), F.col("n_dup_lines"), F.col("n_repeat_words"), F.col("n_lines")
    return {
        "length": _vote(n >= 80, n < 30),
        "word_length": _vote((c >= 3 * n) & (c <= 10 * n), (c < 2 * n) | (c > 15 * n) | (n == 0)),
        "symbols": _vote(100 * sym <= 2 * c, 100 * sym > 8 * c),
        "letters": _vote(100 * F.col("n_letters") >= 93 * c, (100 * F.col("n_letters") < 90 * c) | (n == 0)),
        "lines": _vote(100 * dup <= 5 * lines, 100 * dup > 40 * lines),
        "repeats": _vote(100 * rep <= 10 * n, 100 * rep > 40 * n),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class LabelModel:
    """How often each rule is right, given that it votes, and the share of good documents."""

    prior: float
    right_if_good: dict[str, float]
    right_if_bad: dict[str, float]

    def log_odds(self, votes: dict[str, Column]) -> Column:
        total = F.lit(log(self.prior / (1 - self.prior)))
        for name, vote in votes.items():
            g, b = self.right_if_good[name], self.right_if_bad[name]
            total = total + F.when(vote == 1, log(g / (1 - b))).when(vote == -1, log((1 - g) / b)).otherwise(0.0)
        return total

    def posterior(self, votes: dict[str, Column]) -> Column:
        return 1.0 / (1.0 + F.exp(-self.log_odds(votes)))


def fit(patterns: list[tuple[tuple[int, ...], int]], names: list[str], rounds: int = 200) -> LabelModel:
    """Expectation-maximisation for a two-class model with conditionally independent votes.

    ``patterns`` are distinct vote tuples with their numbers of documents. The start says that most documents are
    good, that rules rarely err on good ones, and that a bad document trips some rules but passes others. Estimates
    are smoothed by one document on either side; none is certain, and a rule speaks for what it votes for, however
    weakly. An empty corpus keeps the start values.
    """
    good = [0.95] * len(names)
    bad = [0.4] * len(names)
    prior = 0.9
    total = sum(n for _, n in patterns)
    for _ in range(rounds if total else 0):
        sums = [[1.0, 2.0, 1.0, 2.0] for _ in names]
        weight = 0.0
        for votes, n in patterns:
            odds = log(prior / (1 - prior))
            for k, v in enumerate(votes):
                odds += log(good[k] / (1 - bad[k])) if v > 0 else log((1 - good[k]) / bad[k]) if v < 0 else 0.0
            p = 1 / (1 + exp(-odds))
            weight += n * p
            for k, v in enumerate(votes):
                if v:
                    sums[k][0] += n * p * (v > 0)
                    sums[k][1] += n * p
                    sums[k][2] += n * (1 - p) * (v < 0)
                    sums[k][3] += n * (1 - p)
        was = (prior, *good, *bad)
        prior = min(0.99, max(0.5, weight / total))
        good = [min(0.99, max(0.6, s[0] / s[1])) for s in sums]
        # A bad vote is likelier, and a good vote less likely, for a bad document than for a good one.
        bad = [min(0.99, max(1.0 - g + 0.01, s[2] / s[3])) for g, s in zip(good, sums)]
        if max(abs(x - y) for x, y in zip(was, (prior, *good, *bad))) < 1e-7:
            break
    return LabelModel(prior, dict(zip(names, good)), dict(zip(names, bad)))


def fit_on(measured: DataFrame) -> LabelModel:
    """Fit on the vote patterns of all measured documents."""
    votes = rules()
    counted = measured.select(*[v.alias(k) for k, v in votes.items()]).groupBy(*votes).count().collect()
    # Sorted, so that sums of floats come out the same in every run.
    return fit(sorted((tuple(r[k] for k in votes), r["count"]) for r in counted), list(votes))


def judge(measured: DataFrame, model: LabelModel, keep_from: float = 0.5) -> DataFrame:
    """Add ``base_failed``, ``quality`` (posterior) and ``kept`` to measured rows."""
    d = measured.withColumn("base_failed", base_failed()).withColumn("quality", model.posterior(rules()))
    return d.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= keep_from))


def scored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and verdict of every document. The counts are staged, as the fit and the verdict both need them."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    measured = stage(measure(own), "quality")
    return judge(measured, fit_on(measured))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with a passing verdict, all columns as they were."""
    model = fit_on(measure(docs.select(F.col(text).alias("text"))))
    judged = judge(measure(pack(docs, text=F.col(text))), model)
    return only_where(judged, F.col("kept"), F.col("row"), "row").select("row.*")
