"""Toxicity scores by non-negative positive-unlabelled learning.

A classifier is trained on confirmed toxic texts and on unlabelled ones, in numpy, on bounded samples;
texts labelled clean are unlabelled to it. The risk of the unlabelled texts is corrected by the class
prior, prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)]); where the second part falls below
zero, which only overfitting can do, its gradient is followed backwards. Features of the whole text are
the presence of words and the rate of word beginnings, chosen by how much stronger they are in toxic
texts; scoring is one pass over all documents without a shuffle.
"""

from __future__ import annotations

import sys
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOLDS, HELD_OUT = 3, 1

# Bytes to lower case, with ASCII marks and digits as separators; other bytes belong to words.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


@dataclass(frozen=True)
class Training:
    """Bounds and settings of the training.

    `positives` and `unlabelled` bound the samples (the rows of smallest digest of their id), `features`
    the vocabulary. Only these rows reach the driver; everything else is done for all documents.
    """

    positives: int = 3000
    unlabelled: int = 6000
    features: int = 2000
    support: int = 5
    least_z: float = 4.0
    steps: int = 400
    rate: float = 0.05
    penalty: float = 1e-4
    seed: int = 11


@dataclass
class Model:
    weights: dict[bytes, float]
    bias: float
    prior: float


# Lengths in bytes of the word beginnings that are features, and the words per beginning at which its
# feature is full.
BEGINNINGS = (3, 4, 5, 6, 7, 8)
FULL_RATE = 50


def features(text: bytes) -> dict[bytes, float]:
    """Feature values of a text: 1 for each word it holds, and how often its words begin alike.

    A beginning is written with a star, which no word holds.
    """
    words = text.translate(_TABLE).split()
    counts = Counter(words)
    begun: Counter = Counter()
    for word, n in counts.items():
        for k in BEGINNINGS:
            if len(word) > k:
                begun[word[:k] + b"*"] += n
    return _values(counts, begun, len(words))


def _values(words, begun: dict[bytes, int], n_words: int) -> dict[bytes, float]:
    scale = FULL_RATE / max(n_words, FULL_RATE)
    out = dict.fromkeys(words, 1.0)
    out.update((name, min(1.0, n * scale)) for name, n in begun.items())
    return out


class Finder:
    """Values of given features only."""

    def __init__(self, names):
        self.words = frozenset(w for w in names if w[-1:] != b"*")
        self.beginnings = [
            (k, short) for k in BEGINNINGS
            if (short := frozenset(w[:-1] for w in names if w[-1:] == b"*" and len(w) == k + 1))
        ]

    def __call__(self, text: bytes) -> dict[bytes, float]:
        words = text.translate(_TABLE).split()
        begun: Counter = Counter()
        for k, short in self.beginnings:
            begun.update([w[:k] + b"*" for w in words if w[:k] in short and len(w) > k])
        return _values(self.words.intersection(words), begun, len(words))


def fold_of(id_column: str):
    return F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(FOLDS))


def choose_features(toxic: list[bytes], other: list[bytes], settings: Training) -> list[bytes]:
    """Features that are stronger in toxic texts, by the z-value of the difference of their means."""
    held: Counter = Counter()
    for text in toxic:
        held.update(features(text).keys())
    frequent = [name for name, k in held.items() if k >= settings.support]
    del held
    find, sums = Finder(frequent), []
    for texts in (toxic, other):
        total, square = Counter(), Counter()
        for text in texts:
            for name, value in find(text).items():
                total[name] += value
                square[name] += value * value
        sums.append((total, square))
    (total, square), (total_u, square_u) = sums
    n, m = max(1, len(toxic)), max(1, len(other))
    rated = []
    for name in frequent:
        a, b = total[name] / n, total_u[name] / m
        spread = (square[name] + square_u[name]) / (n + m) - ((total[name] + total_u[name]) / (n + m)) ** 2
        rated.append(((b - a) / (max(spread, 1e-12) * (1 / n + 1 / m)) ** 0.5, name))
    rated.sort()
    return [name for z, name in rated[: settings.features] if z < -settings.least_z]


def _matrix(texts: list[bytes], index: dict[bytes, int]) -> np.ndarray:
    out, find = np.zeros((len(texts), len(index)), dtype=np.float32), Finder(index)
    for i, text in enumerate(texts):
        for name, value in find(text).items():
            out[i, index[name]] = value
    return out


def train(toxic: list[bytes], other: list[bytes], prior: float, settings: Training) -> Model:
    """Fit a linear classifier by the non-negative risk."""
    words = choose_features(toxic, other, settings)
    if not toxic or not other or not words:
        return Model({}, float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))), prior)
    index = {w: i for i, w in enumerate(words)}
    p, u = _matrix(toxic, index), _matrix(other, index)
    weights, bias = np.zeros(len(words)), 0.0
    first, second = np.zeros(len(words) + 1), np.zeros(len(words) + 1)

    def sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))

    for step in range(1, settings.steps + 1):
        fp, fu = p @ weights + bias, u @ weights + bias
        # Logistic loss: l(f) = log(1 + exp(-f)); its slope is -sigmoid(-f), that of l(-f) is sigmoid(f).
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        slope_u, slope_p = sigmoid(fu) / len(fu), sigmoid(fp) / len(fp)
        part = np.append(u.T @ slope_u - prior * (p.T @ slope_p), slope_u.sum() - prior * slope_p.sum())
        if negative < 0:
            gradient = -part
        else:
            up = -sigmoid(-fp) / len(fp)
            gradient = part + prior * np.append(p.T @ up, up.sum())
        gradient[:-1] += settings.penalty * weights
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        change = settings.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - change[:-1], bias - change[-1]
    return Model({w: float(weights[i]) for w, i in index.items()}, float(bias), prior)


def fit(docs: DataFrame, labels: DataFrame, settings: Training = Training(), id_column: str = "doc_id", text_column: str = "text") -> Model:
    """Train on the documents outside the held-out fold; labels of that fold are never read.

    The class prior is the share of toxic among the labelled rows of the training folds. The unlabelled
    sample is drawn from all rows of those folds, confirmed toxic ones included, so the prior holds for it.
    An id with several labels is toxic if any of them says so; null labels do not count. Of rows that
    repeat an id one is taken, the one whose text has the smallest hash.
    """
    ids = F.col(id_column).cast("long").alias("doc_id")
    known = labels.where((fold_of("doc_id") != HELD_OUT) & F.col("toxic").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    counted = known.agg(F.sum((F.col("toxic") == 1).cast("long")), F.count(F.lit(1))).first()
    prior = min(0.5, max(1e-3, (counted[0] or 0) / max(1, counted[1])))
    light = docs.select(ids).where((fold_of("doc_id") != HELD_OUT) & F.col("doc_id").isNotNull()).distinct()
    rank = F.md5(F.concat_ws(":", F.lit(str(settings.seed)), F.col("doc_id").cast("string")).cast("binary"))
    tagged = light.join(known.where("toxic = 1"), "doc_id", "left").select(
        "doc_id", (F.col("toxic") == 1).alias("confirmed"), rank.alias("rank"))
    first = [(tagged.where("confirmed"), settings.positives), (tagged, settings.unlabelled)]
    picked = [of.orderBy("rank").limit(n).select("doc_id", F.lit(i).alias("sample")) for i, (of, n) in enumerate(first)]
    chosen = picked[0].union(picked[1]).groupBy("doc_id").agg(F.collect_set("sample").alias("samples"))
    texts = docs.select(ids, F.col(text_column).cast("binary").alias("text")).join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.min_by(F.struct("samples", "text"), F.xxhash64("text")).alias("x")).select("doc_id", "x.*")

    sample = sorted((r["doc_id"], sorted(r["samples"]), bytes(r["text"] or b"")) for r in texts.collect())
    toxic = [text for _, samples, text in sample if 0 in samples]
    other = [text for _, samples, text in sample if 1 in samples]
    return train(toxic, other, prior, settings)


def score(docs: DataFrame, model: Model, threshold: float = 0.7, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row, from its whole text alone.

    A null or empty text has the score of no words. Repeated rows, and rows without an id, are scored as
    they stand (held_out is false without an id). Other columns are not read. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        known, bias = shared.value.weights, shared.value.bias
        find = Finder(known)
        for batch in batches:
            scores = []
            for text in batch.column("text").to_pylist():
                found = find(text or b"")
                scores.append(bias + sum(known[name] * found[name] for name in sorted(found)))
            scores = 1 / (1 + np.exp(-np.clip(np.array(scores, dtype=np.float64), -40, 40)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    scored = source.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id", F.coalesce(fold_of("doc_id") == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
