"""Toxicity by averaged subword vectors under a linear softmax.

A word is the bag of its character n-grams (3 to 5, with marks at both ends) and itself, each hashed to a row of an
embedding table. A document is the mean of all its subword vectors; a linear softmax scores it. Table and softmax
are trained together in numpy on a bounded sample of labelled documents. A misspelt or unseen word
shares most n-grams with the words it stems from, and so their vectors.

Every subword of the sample has a vector; others have the zero vector, and count in the mean like the rest. What keeps thousands of subwords that
say nothing from drowning the few that do is shrinkage: a vector begins at the log odds of the label where the subword
occurs, shrunk by how weak the evidence for them is, and its steps are shrunk by the same factor.

Scoring is linear up to the softmax, so a distinct word of a slice is worked out once and counted as often as it occurs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import label_sample, remainder, sampled_texts, slices, written

SIZES = (3, 4, 5)
BUCKETS = 1 << 17
DIM = 2
TRAIN_ROWS = 1500  # labelled documents of each class at most
TRAIN_PAIRS = 4_000_000  # of (document, distinct subword) in the sample; whole documents, of any length, are taken up to it
SHRINK = 16.0  # likelihood ratio (twice its logarithm) at which a subword's vector is shrunk to a quarter
ROUNDS = 25
SEED = 23
EDGES = " .,;:!?\"'()[]{}#*$%&|<>=/-"  # cut off at both ends of a word


def word_counts(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words in lower case, the word of each place, and the words per text. Null texts have none."""
    parts = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    sizes = np.diff(np.asarray(parts.offsets)).astype(np.int64)
    bare = pc.utf8_trim(parts.flatten(), EDGES)
    coded = bare.dictionary_encode()
    return coded.dictionary.to_pylist(), np.asarray(coded.indices).astype(np.int64), sizes


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords of the words, one word after another, and how many each has; an empty word has none."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    full = np.where(sizes > 0, sizes + 2, 0)
    joined = "".join([f"\2{w}\3" for w in words if w])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    first = np.cumsum(full) - full
    depth = np.arange(len(points)) - np.repeat(first, full)
    left = np.repeat(full, full) - depth
    of = np.repeat(np.arange(len(words)), full)
    found_word, found = [], []
    with np.errstate(over="ignore"):
        h = np.zeros(len(points), np.uint64)
        for n in range(1, max(SIZES) + 1):
            h = h[: len(points) - n + 1] * np.uint64(0x100000001B3) + points[n - 1 :] + np.uint64(n)
            if n in SIZES:
                at = np.flatnonzero(left[: len(h)] >= n)
                mixed = (h[at] ^ (h[at] >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
                found.append((mixed >> np.uint64(64 - 17)).astype(np.int64))
                found_word.append(of[at])
        # The whole word: a sum of place-weighted points, mixed.
        some = np.flatnonzero(full)
        power = (depth.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        spread = points * power
        spread ^= spread >> np.uint64(31)
        whole = np.add.reduceat(spread, first[some]) if len(some) else np.zeros(0, np.uint64)
        whole = (whole ^ (whole >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
        found.append((whole >> np.uint64(64 - 17)).astype(np.int64))
        found_word.append(some)
    word, bucket = np.concatenate(found_word), np.concatenate(found)
    order = np.argsort(word, kind="stable")
    return bucket[order], np.bincount(word, minlength=len(words))


class Model:
    """Embedding table and softmax."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.table = np.zeros((BUCKETS, DIM))
        self.out = rng.normal(0, 0.1, (DIM, 2))
        self.out[0] = -0.5, 0.5
        self.bias = np.zeros(2)

    def margins(self) -> np.ndarray:
        """What one occurrence of a subword adds to the margin of label 1 over 0."""
        return self.table @ (self.out[:, 1] - self.out[:, 0])


def evidence(column: np.ndarray, doc: np.ndarray, y: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of the label for the documents with each of `n` subwords against those without, and their shrinkage factor, 0 to 1.

    Half a document is added to each count for the odds. The factor grows with twice the log likelihood ratio of the four
    counts against independence: far below SHRINK it is about nothing, far above about one.
    """
    seen = np.bincount(column, minlength=n).astype(np.float64)
    inside = np.bincount(column, weights=y[doc], minlength=n)
    toxic, clean = y.sum(), (1 - y).sum()
    counts = np.stack([inside, toxic - inside, seen - inside, clean - seen + inside])
    odds = np.log((counts[0] + 0.5) * (counts[3] + 0.5) / ((counts[1] + 0.5) * (counts[2] + 0.5)))
    part = toxic / (toxic + clean)
    without = toxic + clean - seen
    expected = np.stack([seen * part, without * part, seen * (1 - part), without * (1 - part)])
    ratio = 2 * (counts * np.log(np.maximum(counts, 1e-9) / np.maximum(expected, 1e-9))).sum(axis=0)
    ratio = np.maximum(0.0, ratio)
    return odds, (ratio / (ratio + SHRINK)) ** 2


def fit(doc: np.ndarray, bucket: np.ndarray, count: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, rate: float = 1.0, seed: int = SEED) -> Model:
    """Trains on documents given as (document, bucket, count); both classes weigh the same.

    Without both classes the score is the same for all.
    """
    model = Model(seed)
    n = len(y)
    if n == 0 or y.min() == y.max():
        model.bias = np.array([0.0, 0.0 if not n else (4.0 if y[0] else -4.0)])
        return model
    names, column = np.unique(bucket, return_inverse=True)
    length = np.maximum(1.0, np.bincount(doc, weights=count, minlength=n))
    share = count / length[doc]
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    target = np.stack([1 - y, y], axis=1)

    def means(table: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(doc, weights=share * table[column, d], minlength=n) for d in range(DIM)], axis=1)

    odds, factor = evidence(column, doc, y, len(names))
    table = np.random.default_rng(seed).uniform(-0.01, 0.01, (len(names), DIM)) * factor[:, None]
    table[:, 0] += odds * factor
    first = means(table)[:, 0]
    centre = np.average(first, weights=weight)
    spread = max(1e-9, np.sqrt(np.average((first - centre) ** 2, weights=weight)))
    table /= spread
    model.bias = np.array([0.5, -0.5]) * centre / spread

    def errors(h: np.ndarray) -> np.ndarray:
        z = h @ model.out + model.bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return (p / p.sum(axis=1, keepdims=True) - target) * weight[:, None]

    # The softmax alone first, or the table would make up for its being off.
    h = means(table)
    for _ in range(200):
        g = errors(h)
        model.out -= 0.5 * h.T @ g
        model.bias -= 0.5 * g.sum(axis=0)
    # A subword's step is scaled by its own share of the corpus, so rare ones do not stand still, and by the evidence for it.
    scale = factor / (np.sqrt(np.bincount(column, weights=share**2 * weight[doc], minlength=len(names))) + 1e-4)
    state = [np.zeros_like(table), np.zeros_like(model.out), np.zeros_like(model.bias)]
    for step in range(rounds):
        h = means(table)
        g = errors(h)
        back = g @ model.out.T
        grad = np.stack([np.bincount(column, weights=share * back[doc, d], minlength=len(names)) for d in range(DIM)], axis=1)
        now = rate * (1 - step / rounds)
        state = [0.9 * held + move for held, move in zip(state, [grad * scale[:, None], h.T @ g, g.sum(axis=0)], strict=True)]
        table -= now * state[0]
        model.out -= now * state[1]
        model.bias -= now * state[2]
    model.table[names] = table
    return model


def bags(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets and their counts for each text."""
    words, codes, sizes = word_counts(texts)
    bucket, each = subwords(words)
    start = np.cumsum(each) - each
    out, at = [], 0
    for n in sizes.tolist():
        own = codes[at : at + n]
        k = each[own]
        step = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
        out.append(np.unique(bucket[np.repeat(start[own], k) + step], return_counts=True))
        at += n
    return out


def chosen(order: list[tuple[int, int, int]], most: int) -> list[int]:
    """Ids taken from (id, label, pairs) in their order, the classes in turn, while their pairs are `most` or fewer together."""
    queues = [[r for r in order if r[1] == label] for label in (0, 1)]
    out, total = [], 0
    for i in range(max(map(len, queues))):
        for queue in queues:
            if i < len(queue) and total + queue[i][2] <= most:
                out.append(queue[i][0])
                total += queue[i][2]
    return out


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, pairs: int = TRAIN_PAIRS) -> Model:
    """Fits on at most `rows` documents of each class and `pairs` subwords in them, none held out. Texts are whole, whatever their length."""
    ids = label_sample(docs, labels, "toxic", rows, remainder("doc_id", 3) != 1, SEED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = bags(part.column("text"))
            names = pa.array([b.astype(np.int32).tobytes() for b, _ in found], pa.binary())
            counts = pa.array([c.astype(np.int32).tobytes() for _, c in found], pa.binary())
            columns = [part.column("doc_id"), part.column("label"), names, counts]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "buckets", "counts"])

    bagged = written(sampled_texts(docs, ids).mapInArrow(run, "doc_id long, label int, buckets binary, counts binary"), "subword-bags")
    size = (F.octet_length("buckets") / 4).cast("long").alias("pairs")
    thin = bagged.select("doc_id", "label", size).orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").collect()
    taken = bagged.where(F.col("doc_id").isin(chosen([tuple(r) for r in thin], pairs)))
    got = taken.orderBy("doc_id").toArrow()
    doc = np.repeat(np.arange(len(got)), [len(x) // 4 for x in got.column("buckets").to_pylist()])
    bucket, count = (np.frombuffer(b"".join(got.column(c).to_pylist()), np.int32) for c in ("buckets", "counts"))
    return fit(doc, bucket.astype(np.int64), count.astype(np.float64), np.asarray(got.column("label")).astype(np.float64))


def score_texts(texts: pa.Array, margins: np.ndarray, bias: float) -> np.ndarray:
    words, codes, sizes = word_counts(texts)
    bucket, each = subwords(words)
    of = np.repeat(np.arange(len(words)), each)
    value = np.bincount(of, weights=margins[bucket], minlength=len(words))
    doc = np.repeat(np.arange(len(sizes)), sizes)
    total = np.bincount(doc, weights=value[codes], minlength=len(sizes))
    length = np.bincount(doc, weights=each[codes], minlength=len(sizes))
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(1.0, length) + bias, -50, 50)))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """`doc_id`, `held_out`, `score` (0 to 1, higher: label 1 likelier) and `predicted` of every document.

    A text without words, null or empty, has the score of the bias alone. A null doc_id is not held out.
    """
    return scored(docs, train(docs, labels), threshold)


def scored(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    margins, bias = model.margins(), float(model.bias[1] - model.bias[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            score = np.round(score_texts(part.column("text"), margins, bias), 12)
            columns = [part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    thin = docs.select(F.col("doc_id").cast("long"), held.alias("held_out"), F.col("text").cast("string"))
    return thin.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
