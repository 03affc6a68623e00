"""Quality by a regularised quadratic discriminant over statistics of the whole text.

Good and bad texts each get a mean and a covariance, shrunk towards the pooled one and its diagonal. A score is the
difference of the two log densities, from Mahalanobis distances with Cholesky factors that are computed once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm import common
from tillwise.session import materialise

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))
_SENTENCE = b".,;:'\"!?-()"
_SIGNS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in _SENTENCE)
_WIDE = bytes(range(128, 256))

NAMES = (
    "words", "word_length", "upper", "digits", "signs", "punctuation", "wide", "distinct", "same_lines", "commonest", "lines", "stops", "shouts",
)


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of a text: logarithms of counts, square roots of shares; all zero without words."""
    words = text.split()
    if not words:
        return [0.0] * len(NAMES)
    counts = Counter(words)
    n, w = len(text), len(words)
    share = lambda signs: (n - len(text.translate(None, signs))) / n
    upper, lower = share(_UPPER), share(_LOWER)
    lines = [x for x in text.split(b"\n") if x.strip()]
    shouts = text.count(b"!")
    return [
        np.log1p(w),
        np.log(sum(map(len, words)) / w),
        np.sqrt(upper / (upper + lower)) if upper + lower else 0.0,
        np.sqrt(share(_DIGITS)),
        np.sqrt(share(_SIGNS)),
        np.sqrt(share(_SENTENCE)),
        np.sqrt(share(_WIDE)),
        np.log1p(len(counts)) / np.log1p(w),
        np.sqrt(1 - len(set(lines)) / len(lines)),
        np.sqrt(max(counts.values()) / w),
        np.sqrt(len(lines) / w),
        np.sqrt((text.count(b".") + text.count(b"?")) / w),
        np.sqrt(shouts / w),
    ]


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and log determinants of both classes, over standardised statistics."""

    centre: np.ndarray
    spread: np.ndarray
    means: tuple[np.ndarray, np.ndarray]
    factors: tuple[np.ndarray, np.ndarray]
    offset: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.spread
        bad, good = (((z - m) @ f.T) ** 2 for m, f in zip(self.means, self.factors))
        return 1 / (1 + np.exp(-np.clip(self.offset + 0.5 * (bad.sum(axis=1) - good.sum(axis=1)), -500, 500)))


def discriminant(counts, sums, products, shrink: float = 0.1, floor: float = 0.05) -> Discriminant:
    """From both classes' row counts, sums and sums of outer products.

    A class covariance goes a part ``shrink`` of the way to the pooled one; ``floor`` of a pooled variance is added to each.
    A class without rows takes the pooled moments; then only the smoothed class shares tell.
    """
    n = sum(counts)
    d = len(sums[0])
    if not n:
        return Discriminant(np.zeros(d), np.ones(d), (np.zeros(d),) * 2, (np.eye(d),) * 2, 0.0)
    centre = (sums[0] + sums[1]) / n
    spread = np.sqrt(np.maximum(np.diag(products[0] + products[1]) / n - centre**2, 1e-12))
    spread[spread < 1e-5] = 1.0
    scale = np.outer(spread, spread)
    means, covariances = [], []
    for k, s, p in zip(counts, sums, products):
        mean = s / k if k else centre
        means.append((mean - centre) / spread)
        covariances.append((p / k - np.outer(mean, mean)) / scale if k else None)
    pooled = sum(k * c for k, c in zip(counts, covariances) if k) / n
    factors, offset = [], float(np.log((counts[1] + 1) / (counts[0] + 1)))
    for sign, c in zip((1, -1), covariances):
        whole = (pooled if c is None else (1 - shrink) * c + shrink * pooled) + floor * np.eye(d)
        lower = np.linalg.cholesky(whole)
        offset += sign * float(np.log(np.diag(lower)).sum())
        factors.append(np.linalg.inv(lower))
    return Discriminant(centre, spread, tuple(means), tuple(factors), offset)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and ``x``, the statistics of the whole text, of every row; null texts are empty."""

    def make():
        return lambda texts: [pa.array([list(map(float, statistics(t))) for t in texts], pa.list_(pa.float64()))]

    return common.over_texts(common.documents(docs), make, "x array<double>")


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality") -> Discriminant:
    """Learn from all labelled rows that are not held out; only sums reach the driver."""
    ids = common.labelled_ids(labels, label)
    d = len(NAMES)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            y = batch.column("label").to_numpy(zero_copy_only=False)
            for k in (0, 1):
                own = x[y == k]
                total[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        place = np.arange(total.size)
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(total.ravel())], names=["place", "value"])

    parts = stats.join(ids, "doc_id").select("x", "label").mapInArrow(moments, "place int, value double")
    total = np.zeros(2 * (1 + d + d * d))
    for row in parts.groupBy("place").agg(F.sum("value").alias("value")).collect():
        total[row["place"]] = row["value"]
    total = total.reshape(2, -1)
    return discriminant(
        [int(t[0]) for t in total], [t[1 : 1 + d] for t in total], [t[1 + d :].reshape(d, d) for t in total]
    )


def score(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """doc_id and score (0 to 1, higher: the label's 1 likelier) of every row; empty and null texts too.

    Without labelled rows every score is a half. Texts are read once; their statistics go to the shared folder.
    """
    stats = materialise(measured(docs), "statistics")
    model = fit(stats, labels, label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.scores(x))], names=["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double")
