"""Language identification with a linear-chain conditional random field.

Every word of a text has a hidden language. Emissions sum weights of hashed features: the character trigrams of the
word with its borders, its first and last three bytes (affixes), and the whole word (a lexicon learned from data).
Transitions are learned, so code-switched text may change language where the words ask for it. Forward-backward gives
each word's posterior; a text's language is the one with the largest mean posterior, which is its score.

Training maximises the likelihood of label sequences by stochastic gradient steps. It uses at most ``PER_LANGUAGE``
texts of each language, chosen by the hash of their ids, and at most ``SEGMENTS`` runs of ``RUN`` words of each;
runs of different texts are joined into sequences, which is where the model sees switches. A text of fewer words is
gone through again until it fills a run, so every chosen text trains. Prediction reads whole
texts of all documents, in numpy over Arrow batches, in the tasks that read them; nothing is shuffled.

Texts of any length are cut into chunks; a chunk's transition matrices are multiplied first, so all chunks of a batch
are worked on side by side and the result is exactly that of one long chain.

Scripts without spaces are cut into pieces of up to two characters, which then count as words, in training and in
prediction. Words of a training run are cut into parts of ``PART`` characters, which bounds the model's input.

Defined cases: a text that is null or has no letter is ``und`` with score 0; so is every text if nothing can be
learned; rows with a null id are never training rows and never held out; a label without a word in its chosen texts,
or one seen only in held-out rows, cannot be predicted; ties go to the label that sorts first; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.shingles import BLANK, BYTE_VALUE, LOWER, PLACE, U, mixed, text_chunks, word_hashes

BUCKETS = 1 << 16
PER_LANGUAGE = 400
SEGMENTS = 8
RUN = 16
SEQUENCE = 64
EPOCHS = 6
PART = 64
CHUNK = 32
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
#: Thai, Lao, Tibetan, Burmese, Khmer, kana and Han characters.
UNSPACED = r"[\x{0E00}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]"


def spaced(texts: pa.Array) -> pa.Array:
    """The texts with blanks around pieces of up to two characters of scripts that write none."""
    return pc.replace_substring_regex(texts, f"({UNSPACED}{{1,2}})", r" \1 ")


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the trigram around each byte of a word, first of these per word, three more buckets per word
    (prefix, suffix, whole word), and the number of each text's first word (one more at the end)."""
    whole, first = word_hashes(data, offsets)
    n = len(data)
    if not len(whole):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 3), np.int64), first
    inside = ~BLANK[data]
    value = np.where(inside, BYTE_VALUE[LOWER[data]], U(0))
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < n)]
    before, after = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    before[1:], after[:-1] = value[:-1], value[1:]
    before[edge], after[edge - 1] = 0, 0
    at = np.flatnonzero(inside)
    gram = mixed(before[at] * PLACE[20] + value[at] * PLACE[21] + after[at] * PLACE[22])
    start = before[at] == 0
    begin = np.flatnonzero(start)
    end = np.append(begin[1:], len(at)) - 1
    # The trigrams at the second and at the last but one byte hold the first and last three bytes.
    prefix = mixed(gram[np.minimum(begin + 1, end)] + PLACE[23])
    suffix = mixed(gram[np.maximum(end - 1, begin)] + PLACE[24])
    mask = U(BUCKETS - 1)
    three = np.stack([prefix & mask, suffix & mask, mixed(whole + PLACE[25]) & mask], axis=1).astype(np.int64)
    return (gram & mask).astype(np.int64), begin, three, first


def emissions(weights: np.ndarray, grams: np.ndarray, begin: np.ndarray, three: np.ndarray) -> np.ndarray:
    if not len(begin):
        return np.zeros((0, weights.shape[1]), weights.dtype)
    e = np.add.reduceat(weights[grams], begin, axis=0)
    for k in range(3):
        e += weights[three[:, k]]
    return e


def _forward_backward(emit: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of labels (n, t, l) and expected transitions (l, l) of sequences of one length."""
    n, t, l = emit.shape
    up, down = np.exp(emit - emit.max(axis=2, keepdims=True)), np.exp(move)
    a, b = np.empty_like(up), np.empty_like(up)
    a[:, 0] = up[:, 0] / up[:, 0].sum(axis=1, keepdims=True)
    for k in range(1, t):
        x = (a[:, k - 1] @ down) * up[:, k]
        a[:, k] = x / x.sum(axis=1, keepdims=True)
    b[:, t - 1] = 1.0
    for k in range(t - 2, -1, -1):
        x = (b[:, k + 1] * up[:, k + 1]) @ down.T
        b[:, k] = x / x.sum(axis=1, keepdims=True)
    post = a * b
    post /= post.sum(axis=2, keepdims=True)
    pair = a[:, :-1, :, None] * down * (up * b)[:, 1:, None, :]
    pair /= pair.sum(axis=(2, 3), keepdims=True)
    return post, pair.sum(axis=(0, 1))


def train(texts: list[str], labels: list[int], n_labels: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Weights (BUCKETS, labels) and transitions (labels, labels) from runs of words with one label each."""
    rng = np.random.default_rng(seed)
    weights, move = np.zeros((BUCKETS, n_labels)), np.zeros((n_labels, n_labels))
    per = SEQUENCE // RUN
    known = np.array(labels)
    data, sizes = " ".join(texts).encode(), [len(t.encode()) + 1 for t in texts]
    offsets = np.minimum(np.concatenate([[0], np.cumsum(sizes)]), len(data))
    grams, begin, three, first = features(np.frombuffer(data, np.uint8), offsets)
    have = np.diff(first)
    full = np.flatnonzero(have)
    if not len(full):
        return weights, move
    length = np.diff(np.append(begin, len(grams)))
    seen = np.full(BUCKETS, 1e-6)[:, None]
    for epoch in range(EPOCHS):
        order = rng.permutation(full)
        order = np.concatenate([order, order[: -len(order) % per]]) if len(order) % per and len(order) >= per else np.resize(order, -(-len(order) // per) * per)
        for part in np.array_split(order.reshape(-1, per), max(1, len(order) // per // 64)):
            # A short run is gone through again and again until it has RUN words.
            words = (first[part][:, :, None] + np.arange(RUN) % have[part][:, :, None]).reshape(len(part), SEQUENCE)
            gold = np.repeat(known[part], RUN, axis=1)
            flat = words.ravel()
            spans = length[flat]
            gram = grams[np.repeat(begin[flat] - np.concatenate([[0], np.cumsum(spans)[:-1]]), spans) + np.arange(spans.sum())]
            e = emissions(weights, gram, np.concatenate([[0], np.cumsum(spans)[:-1]]), three[flat]).reshape(len(part), SEQUENCE, n_labels)
            post, moved = _forward_backward(e, move)
            error = np.eye(n_labels)[gold] - post
            flat_error = error.reshape(-1, n_labels)
            grad = np.zeros_like(weights)
            for c in range(n_labels):
                grad[:, c] = np.bincount(gram, np.repeat(flat_error[:, c], spans), BUCKETS)
                for k in range(3):
                    grad[:, c] += np.bincount(three[flat, k], flat_error[:, c], BUCKETS)
            true = np.zeros_like(move)
            np.add.at(true, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1.0)
            # Steps adapt to how often a bucket has moved (Adagrad); weights decay a little.
            seen += (grad**2).sum(axis=1, keepdims=True)
            weights += 0.3 * grad / np.sqrt(seen) - 1e-5 * weights
            move += 0.5 * (true - moved) / max(1, len(part) * SEQUENCE) * 4 - 1e-3 * move
    return weights, move


def posteriors(emit: np.ndarray, first: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Mean posterior of each label over the words of each text; zeros for a text without words.

    ``emit`` has a row per word, ``first`` each text's first word and the end. Texts are padded to whole chunks.
    """
    labels = emit.shape[1]
    words = np.diff(first)
    out = np.zeros((len(words), labels))
    live = np.flatnonzero(words)
    if not len(live):
        return out
    chunks = -(-words[live] // CHUNK)
    total = int(chunks.sum())
    text_of = np.repeat(np.arange(len(live)), chunks)
    begin = np.concatenate([[0], np.cumsum(chunks)[:-1]])
    nth = np.arange(total) - begin[text_of]
    at = first[live][text_of][:, None] + nth[:, None] * CHUNK + np.arange(CHUNK)
    real = at < first[live + 1][text_of][:, None]
    up = np.exp(emit - emit.max(axis=1, keepdims=True))[np.where(real, at, 0)]
    down = np.exp(move - move.max())
    # What a whole chunk does to the vector before it.
    m = np.broadcast_to(np.eye(labels), (total, labels, labels)).copy()
    for k in range(CHUNK):
        x = (m.reshape(-1, labels) @ down).reshape(total, labels, labels) * up[:, k, None, :]
        x /= x.max(axis=(1, 2), keepdims=True)
        m = np.where(real[:, k, None, None], x, m)
    enter, leave = np.ones((total, labels)), np.ones((total, labels))
    for k in range(1, int(chunks.max())):
        i = begin[chunks > k] + k
        x = np.einsum("ni,nij->nj", enter[i - 1], m[i - 1])
        enter[i] = x / x.max(axis=1, keepdims=True)
    for k in range(int(chunks.max()) - 2, -1, -1):
        i = begin[chunks > k + 1] + k
        x = np.einsum("nij,nj->ni", m[i + 1], leave[i + 1])
        leave[i] = x / x.max(axis=1, keepdims=True)
    a = np.empty((CHUNK, total, labels))
    now = enter
    for k in range(CHUNK):
        x = (now @ down) * up[:, k]
        x /= x.max(axis=1, keepdims=True)
        now = np.where(real[:, k, None], x, now)
        a[k] = now
    sums = np.zeros((total, labels))
    now = leave
    for k in range(CHUNK - 1, -1, -1):
        post = a[k] * now
        post /= post.sum(axis=1, keepdims=True)
        sums += np.where(real[:, k, None], post, 0.0)
        x = (now * up[:, k]) @ down.T
        x /= x.max(axis=1, keepdims=True)
        now = np.where(real[:, k, None], x, now)
    np.add.at(out, live[text_of], sums)
    out[live] /= words[live][:, None]
    return out


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Up to SEGMENTS runs of RUN words, spread evenly over each text."""
    for b in batches:
        out = []
        for label, text, seed in zip(b.lang, spaced(pa.array(b.text, pa.string())).to_pylist(), b.seed):
            words = re.findall(r"[^\x20\x09-\x0D]{1,%d}" % PART, text)
            if not words:
                continue
            n = max(1, min(SEGMENTS, len(words) // RUN))
            for k in range(n):
                at = k * len(words) // n
                out.append((label, " ".join(words[at : at + RUN]), seed, k))
        yield pd.DataFrame(out, columns=["lang", "run", "seed", "nth"])


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(5)) == 0, F.lit(False))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray] | None:
    """Labels, weights and transitions from the documents that are not held out, or None without any."""
    own = docs.select(F.col(doc_id).alias("i"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    own = own.filter(~held_out(F.col("i")) & F.col("i").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in own.groupBy("lang").count().collect()}
    if not counts:
        return None
    # Twice what is wanted passes the filter on the id's hash, then the limit takes the smallest hashes.
    chance = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(int(min(1.0, 2 * PER_LANGUAGE / n) * 1e6)))])
    own = own.withColumn("seed", F.xxhash64("i", F.lit("language"))).filter(F.pmod("seed", F.lit(1_000_000)) < chance[F.col("lang")])
    best = F.row_number().over(Window.partitionBy("lang").orderBy("seed", "i"))
    picked = own.withColumn("place", best).filter(F.col("place") <= PER_LANGUAGE).select("lang", "text", "seed")
    runs = picked.mapInPandas(_runs, "lang string, run string, seed long, nth int").toPandas()
    runs = runs.sort_values(["lang", "seed", "nth", "run"])
    labels = sorted(set(runs.lang))
    if not labels:
        return None
    place = {k: i for i, k in enumerate(labels)}
    weights, move = train(runs.run.tolist(), [place[k] for k in runs.lang], len(labels))
    return labels, weights.astype(np.float32), move


def predict(docs: DataFrame, model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every document; the prediction sees the text alone."""
    names = ["doc_id", "lang_pred", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = spaced(batch.column(1))
            for first, data, offsets in text_chunks(texts):
                n = len(offsets) - 1
                said, score = [UNKNOWN] * n, np.zeros(n)
                if model is not None:
                    labels, weights, move = model
                    grams, begin, three, start = features(data, offsets)
                    means = posteriors(emissions(weights, grams, begin, three).astype(float), start, move)
                    best = means.argmax(axis=1)
                    raw = data.tobytes()
                    for i in range(n):
                        if start[i] < start[i + 1] and LETTER.search(raw[offsets[i] : offsets[i + 1]].decode("utf-8", "replace")):
                            said[i], score[i] = labels[best[i]], min(1.0, float(means[i, best[i]]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n).cast(pa.int64()), pa.array(said, pa.string()), pa.array(score, pa.float64())], names=names
                )

    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    got = own.mapInArrow(run, "doc_id long, lang_pred string, score double")
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
