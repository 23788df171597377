"""Quality classifier from trusted positives and unlabelled text.

Each text is described by shares of byte classes and of their successions, by the
shares of repeated words and lines, and by lengths. A logistic model minimises the
non-negative unbiased risk

    prior * R+(positive) + max(0, R-(unlabelled) - prior * R-(positive))

where the positives are rows with quality 1 and the unlabelled are web text whose
labels are not looked at. The share of positives among the unlabelled (``prior``)
is estimated first: a classifier of positive against unlabelled ranks a held-back
half of both, and the prior is the smallest ratio of unlabelled to positive mass
above a score, with a margin for small samples ("best bin").

Training takes up to ``rows`` positives and as many unlabelled rows, chosen by
hash; scoring covers whole texts of all rows. Null and empty texts are scored like
any text of no bytes. Without positives every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.llm import words as W
from balcao.llm.tables import bounded_rows

ROWS = 12_000

# Byte classes: 0 other control, 1 space, 2 line end, 3 lower, 4 upper, 5 digit,
# 6 non-ASCII, 7 full stop and comma, 8 quotes and dashes, 9 brackets, 10 other marks.
_CLASSES = 11
_CLASS = np.full(256, 10, dtype=np.uint8)
_CLASS[:32] = 0
_CLASS[[9, 32]] = 1
_CLASS[[10, 13]] = 2
_CLASS[97:123] = 3
_CLASS[65:91] = 4
_CLASS[48:58] = 5
_CLASS[128:] = 6
_CLASS[[44, 46]] = 7
_CLASS[[34, 39, 45]] = 8
_CLASS[[40, 41, 91, 93, 123, 125]] = 9
_NOT_LINE_END = np.ones(256, dtype=bool)
_NOT_LINE_END[[10, 13]] = False

FEATURES = _CLASSES + _CLASSES**2 + 7


def features(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` numbers per text."""
    out = np.zeros((len(texts), FEATURES), dtype=np.float32)
    for begin, end, raw, offsets in W.pieces(texts):
        n = end - begin
        size = np.diff(offsets)
        doc = np.repeat(np.arange(n, dtype=np.int64), size)
        kind = _CLASS[raw].astype(np.int64)
        one = np.bincount(doc * _CLASSES + kind, minlength=n * _CLASSES).reshape(n, -1)
        same = doc[1:] == doc[:-1]
        pair = (doc[1:] * _CLASSES + kind[:-1]) * _CLASSES + kind[1:]
        two = np.bincount(pair[same], minlength=n * _CLASSES**2).reshape(n, -1)
        scale = 1 / np.maximum(size, 1)[:, None]
        word, line = W.cut(raw, offsets, W.NON_SPACE), W.cut(raw, offsets, _NOT_LINE_END)
        rest = [
            np.log1p(size),
            np.log1p(word.per_doc),
            _distinct_share(word),
            _distinct_share(line),
            W.add_per_doc(word.lengths.astype(np.float64), word.per_doc) / np.maximum(word.per_doc, 1),
            np.log1p(size / np.maximum(line.per_doc, 1)),
            W.add_per_doc((word.lengths == 1).astype(np.float64), word.per_doc) / np.maximum(word.per_doc, 1),
        ]
        out[begin:end] = np.hstack([np.sqrt(one * scale), np.sqrt(two * scale), np.stack(rest, axis=1)])
    return out


def _distinct_share(words: W.Words) -> np.ndarray:
    distinct = W.distinct_per_doc(words.hashes, words.per_doc)[1]
    return np.where(words.per_doc > 0, distinct / np.maximum(words.per_doc, 1), 1.0)


@dataclass
class QualityModel:
    """A standardised linear model; ``prior`` is the estimated share of good texts."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        x = (rows - self.centre) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


def _sample(rows: DataFrame, bound: int) -> np.ndarray:
    @F.arrow_udf("array<float>")
    def described(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = features(texts)
            ends = np.arange(0, found.size + 1, FEATURES, dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(found.reshape(-1)))

    table = bounded_rows(rows, bound, "doc_id", "text").select(described("text").alias("x")).toArrow()
    flat = table.column("x").combine_chunks().flatten().to_numpy() if table.num_rows else np.empty(0)
    return np.asarray(flat, dtype=np.float64).reshape(-1, FEATURES)


def train(documents: DataFrame, labels: DataFrame, rows: int = ROWS) -> QualityModel:
    """Learn from documents (doc_id, text) and labels (doc_id, quality) of training rows only."""
    good = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("of_doc")).distinct()
    texts = documents.select("doc_id", "text")
    trusted = F.broadcast(bounded_rows(good, rows, "of_doc"))
    positive = texts.join(trusted, F.col("doc_id") == F.col("of_doc"), "left_semi")
    return fit(_sample(positive, rows), _sample(texts, rows))


def fit(positive: np.ndarray, unlabelled: np.ndarray, seed: int = 7) -> QualityModel:
    if not len(positive) or not len(unlabelled):
        return QualityModel(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), 0.0, 0.5)
    both = np.vstack([positive, unlabelled])
    centre, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    p, u = (positive - centre) / scale, (unlabelled - centre) / scale
    rng = np.random.default_rng(seed)
    p, u = p[rng.permutation(len(p))], u[rng.permutation(len(u))]
    prior = _prior(p, u)
    weights, bias = _descend(p, u, prior)
    return QualityModel(centre, scale, weights, bias, prior)


def _prior(p: np.ndarray, u: np.ndarray) -> float:
    """Share of positives among the unlabelled, from halves that the ranking did not see."""
    half_p, half_u = max(1, len(p) // 2), max(1, len(u) // 2)
    weights, _ = _descend(p[:half_p], u[:half_u], None)
    seen_p = np.sort((p[half_p:] if len(p) > 1 else p) @ weights)[::-1]
    seen_u = np.sort((u[half_u:] if len(u) > 1 else u) @ weights)[::-1]
    tops = seen_p[np.unique(np.linspace(0, len(seen_p) - 1, 200).astype(int))]
    mass_p = np.searchsorted(-seen_p, -tops, side="right") / len(seen_p)
    mass_u = np.searchsorted(-seen_u, -tops, side="right") / len(seen_u)
    margin = np.sqrt(np.log(4 / 0.1) / 2) * (1 / np.sqrt(len(seen_p)) + 1 / np.sqrt(len(seen_u)))
    best = np.argmin((mass_u + margin) / np.maximum(mass_p, 1e-9))
    return float(np.clip(mass_u[best] / mass_p[best], 0.01, 0.99))


def _descend(p: np.ndarray, u: np.ndarray, prior: float | None, steps: int = 300) -> tuple[np.ndarray, float]:
    """Adam on the non-negative risk; without a prior, on plain positive against unlabelled."""
    one = np.hstack([p, np.ones((len(p), 1))])
    two = np.hstack([u, np.ones((len(u), 1))])
    w = np.zeros(one.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        at_p = 1 / (1 + np.exp(-np.clip(one @ w, -30, 30)))
        at_u = 1 / (1 + np.exp(-np.clip(two @ w, -30, 30)))
        as_good = one.T @ (at_p - 1) / len(p)
        as_bad_u = two.T @ at_u / len(u)
        if prior is None:
            slope = as_good + as_bad_u
        else:
            as_bad_p = one.T @ at_p / len(p)
            risk = -np.log(1 - at_u + 1e-12).mean() + prior * np.log(1 - at_p + 1e-12).mean()
            # Where the unbiased risk of bad text turns negative, step back from it.
            slope = prior * as_good + (as_bad_u - prior * as_bad_p) if risk >= 0 else prior * as_bad_p - as_bad_u
        slope = slope + 1e-3 * np.append(w[:-1], 0.0)
        m = 0.9 * m + 0.1 * slope
        v = 0.999 * v + 0.001 * slope**2
        w = w - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


class QualityColumn:
    """Turns a text column into its score, the probability of quality 1."""

    def __init__(self, model: QualityModel, spark):
        self.model = spark.sparkContext.broadcast(model)

    def __call__(self, text: Column) -> Column:
        model = self.model

        @F.arrow_udf("double")
        def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                yield pa.array(model.value.scores(features(texts)))

        return score(text)
