"""Operator 5: quality scores from pairwise preferences (Bradley-Terry).

A document's strength is a weighted sum of text features; the probability that
one document is preferred to another is the logistic function of the difference
of their strengths. Weights are fitted by logistic loss on feature differences
of (label 1, label 0) pairs. The cut is a quantile of the training documents'
strengths; scores put the cut at the wanted threshold.

Fitting takes a bounded, documented sample of labelled rows (``max_labelled``);
scoring covers every document in one pass without a shuffle.
"""

import math
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import importable, pick, slices

MAX_LABELLED = 20_000   # labelled rows used for fitting, chosen by a hash of the id
PARTNERS = 16           # preference pairs drawn for each labelled row of the rarer label
RIDGE = 1e-2

UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = bytes(range(48, 58))
MARKS = b".,;:'\"()-?"
SYMBOLS = bytes(b for b in range(33, 127) if b not in UPPER + LOWER + DIGITS + MARKS)
CONTROL = bytes([*range(0, 9), *range(14, 32), 127])

FEATURES = ("length", "upper", "lower", "digits", "marks", "symbols", "top symbol", "control", "non-ascii",
            "replacement", "word length", "distinct words", "top word", "repeated bigrams", "odd words",
            "upper words", "one-character words", "distinct lines", "line length", "longest word", "stuttered words", "symbol lines")


def features(text: str) -> list[float]:
    """Numbers between about 0 and 1 that say nothing of a document but its text."""
    raw = text.encode("utf-8", "replace")
    n = len(raw)
    if not n:
        return [0.0] * len(FEATURES)
    share = lambda chars: (n - len(raw.translate(None, chars))) / n
    words = raw.split()
    k = max(1, len(words))
    counts = Counter(words)
    bigrams = set(zip(words, words[1:]))
    symbols = share(SYMBOLS)
    top = max((raw.count(bytes([b])) for b in SYMBOLS), default=0) / n if symbols else 0.0
    odd = sum(1 for w in words if w[-1:].translate(None, SYMBOLS) == b"")
    lines = [x for x in raw.split(b"\n") if x]
    letters = share(UPPER)
    return [
        math.log1p(n) / 12, letters, share(LOWER), share(DIGITS), share(MARKS), symbols, top, share(CONTROL),
        (n - len(raw.translate(None, bytes(range(128, 256))))) / n,
        min(1.0, 20 * raw.count(b"\xef\xbf\xbd") / n),
        min(1.0, n / k / 20), len(counts) / k, max(counts.values(), default=0) / k,
        1 - len(bigrams) / max(1, len(words) - 1) if len(words) > 1 else 0.0, odd / k,
        sum(1 for w in words if w.isupper()) / k, sum(1 for w in words if len(w) == 1) / k,
        len(set(lines)) / max(1, len(lines)), min(1.0, n / max(1, len(lines)) / 2000),
        min(1.0, max(map(len, words), default=0) / 100),
        sum(map(eq, words, words[1:])) / k,
        sum(1 for x in lines if len(x) - len(x.translate(None, SYMBOLS)) > len(x) / 50) / max(1, len(lines)),
    ]


@dataclass(frozen=True)
class Ranking:
    """Feature means, scales and weights; ``cut`` is the strength at the threshold."""

    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    cut: float
    threshold: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        s = ((x - np.array(self.mean)) / np.array(self.scale)) @ np.array(self.weights)
        t = min(max(self.threshold, 1e-6), 1 - 1e-6)
        return 1 / (1 + np.exp(-np.clip(s - self.cut + math.log(t / (1 - t)), -60, 60)))


def fit(x: np.ndarray, y: np.ndarray, threshold: float = 0.3) -> Ranking:
    """Fit on features and 0/1 labels. With fewer than one row of either label
    there is no preference: all weights are 0 and every score is above the threshold."""
    mean = x.mean(axis=0) if len(x) else np.zeros(len(FEATURES))
    scale = np.maximum(x.std(axis=0), 1e-3) if len(x) else np.ones(len(FEATURES))
    w = np.zeros(len(FEATURES))
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Ranking(tuple(mean), tuple(scale), tuple(w), -1.0, threshold)
    z = np.clip((x - mean) / scale, -8, 8)
    # Every row takes part: the rarer label's rows meet PARTNERS rows each, and
    # further rounds reach all rows of the other label.
    rounds = max(PARTNERS, -(-max(len(good), len(bad)) // min(len(good), len(bad))))
    few, many = (bad, good) if len(bad) <= len(good) else (good, bad)
    i = np.tile(few, rounds)
    j = many[np.arange(len(i)) % len(many)]
    diff = z[j] - z[i] if few is bad else z[i] - z[j]
    for _ in range(30):  # Newton steps on the regularised logistic loss
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
        gradient = diff.T @ (p - 1) / len(diff) + RIDGE * w
        hessian = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + RIDGE * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    s = ((x - mean) / scale) @ w
    # The quantile of the training strengths that separates the labels best.
    order = np.argsort(s, kind="stable")
    wrong = np.concatenate([[0], np.cumsum(y[order] == 1)]) + np.concatenate(
        [[0], np.cumsum(y[order[::-1]] == 0)])[::-1]
    best = np.flatnonzero(wrong == wrong.min())
    quantile = best[len(best) // 2] / len(s)
    return Ranking(tuple(mean), tuple(scale), tuple(w), float(np.quantile(s, quantile)), threshold)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", threshold: float = 0.3, max_labelled: int = MAX_LABELLED) -> Ranking:
    """Fit from labelled documents. Rows with a null id or label are ignored, an
    id with conflicting labels too; ids without a document do not matter. An id of
    several rows counts once, with the mean of their features."""
    kept = (pick(labels, {"id": id_col, "label": label_col}).where("id is not null and label is not null")
            .groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
            .where("label = other").orderBy(F.xxhash64("id"), "id").limit(max_labelled).select("id", "label"))
    rows = pick(docs, {"id": id_col, "text": text_col}).join(F.broadcast(kept), "id")  # at most max_labelled rows

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([features(t or "") for t in batch.column(0).to_pylist()], pa.list_(pa.float64())),
                 batch.column(1).cast(pa.int32()), batch.column(2)], ["x", "label", "h"])

    each = rows.select("text", "label", F.xxhash64("id").alias("h")).mapInArrow(run, "x array<double>, label int, h long")
    mean = F.array(*[F.avg(F.get("x", F.lit(i))) for i in range(len(FEATURES))])
    got = each.groupBy("h", "label").agg(mean.alias("x")).collect()  # a row for each labelled id: at most max_labelled
    got.sort(key=lambda r: (r.h, r.x))
    x = np.array([r.x for r in got], float).reshape(len(got), len(FEATURES))
    return fit(x, np.array([r.label for r in got]), threshold)


def score(docs: DataFrame, ranking: Ranking, text_col: str = "text",
          names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """Every input row with its columns and ``score`` (0 to 1), ``predicted``
    (1 from the ranking's threshold on). Null and empty texts score alike, null ids
    like any. Other ``names`` keep input columns that are called so."""
    importable(docs.sparkSession)

    @F.arrow_udf("double")
    def strength(texts: pa.Array) -> pa.Array:
        # One text at a time becomes a Python string.
        x = np.array([features(t.as_py() or "") for t in texts], float).reshape(len(texts), len(FEATURES))
        return pa.array(ranking.scores(x), pa.float64())

    value, mark = names
    return (docs.withColumn(value, strength(F.col(f"`{text_col}`")))
            .withColumn(mark, F.when(F.col(value) >= ranking.threshold, 1).otherwise(0)))
