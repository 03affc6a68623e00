"""Toxicity scores from a logistic model that must not change its mind when a group's name is swapped.

The model sees which words and beginnings of words, of a bounded vocabulary, a text holds. For labelled sentences that name a group, other
names of the same kind are swapped in, and every difference in score is penalised beside the usual loss. What is
said about a group then decides, not that the group is named.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm import common
from tillwise.session import materialise

#: Names of groups, by kind; within a kind they are swapped for one another.
IDENTITIES = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "locals", "natives"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("femmes", "hommes", "filles", "garçons"),
    ("mujeres", "hombres", "chicas", "chicos"),
)
#: Labelled rows that the fit reads at most, about; words that the model knows at most (and all identity terms).
SAMPLE, VOCABULARY = 20_000, 4_096
#: Documents that must hold a word of the vocabulary.
LEAST = 4

_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else 32 if c < 48 or 58 <= c <= 64 or 91 <= c <= 96 or 123 <= c <= 127 else c for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Words of the whole text: A-Z in lower case, other ASCII signs than letters and digits separate."""
    return text.translate(_PLAIN).split()


def features_of(words: list[bytes]) -> set[bytes]:
    """The distinct words, and their first four and six bytes with a star: abuse is often inflected or compounded."""
    own = set(words)
    return own.union([w[:4] + b"*" for w in own if len(w) > 4], [w[:6] + b"*" for w in own if len(w) > 6])


def kinds_of(identities=IDENTITIES) -> dict[bytes, list[bytes]]:
    """Every group name with all names of its kind."""
    return {name.encode(): [n.encode() for n in kind] for kind in identities for name in kind}


def swap(words: list[bytes], kinds: dict[bytes, list[bytes]]) -> list[list[bytes]]:
    """The sentence with its group names swapped: a version for each step around their kinds; none if it names no group."""

    def other(word: bytes, step: int) -> bytes:
        kind = kinds.get(word)
        return kind[(kind.index(word) + step) % len(kind)] if kind else word

    longest = max((len(kinds[w]) for w in words if w in kinds), default=1)
    return [[other(w, step) for w in words] for step in range(1, longest)]


@dataclass
class Model:
    weights: dict[bytes, float]
    bias: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        known = self.weights.keys()
        total = [self.bias + sum(self.weights[w] for w in sorted(known & features_of(words_of(t)))) for t in texts]
        return 1 / (1 + np.exp(-np.clip(np.array(total, dtype=float), -500, 500)))


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", identities=IDENTITIES, penalty: float = 1.0, ridge: float = 1.0
) -> Model:
    """Learn from the rows of ``docs`` that ``labels`` marks and that are not held out (see ``common.labelled_ids``).

    The fit reads a sample of about ``SAMPLE`` labelled rows at most. Without labelled rows every score is a half; with
    labels of one kind only it is that kind's smoothed share. Repeated ids count as they are repeated in ``docs``.
    """
    ids = F.broadcast(common.labelled_ids(labels, label, bound=SAMPLE))
    sample = materialise(common.documents(docs).join(ids, "doc_id").select("doc_id", "label", "text"), "labelled")

    def words() -> object:
        return lambda texts: [pa.array([list(features_of(words_of(t))) for t in texts], pa.list_(pa.binary()))]

    counted = (
        common.over_texts(sample, words, "words array<binary>")
        .select("label", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.sum("label").alias("with"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= LEAST)
    )
    totals = sample.select("label").agg(F.count(F.lit(1)), F.sum("label")).first()
    n, positive = int(totals[0]), int(totals[1] or 0)
    if not n or positive in (0, n):
        share = (positive + 1) / (n + 2)
        return Model({}, float(np.log(share / (1 - share))))
    # how far each word's share of toxic texts lies from the share of all, in standard deviations
    share = positive / n
    told = F.abs(F.col("with") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share))
    chosen = common.largest(materialise(counted, "features"), told, VOCABULARY).select("word").collect()
    names = sorted({bytes(r[0]) for r in chosen} | features_of(list(kinds_of(identities))))
    place, kinds = {w: i for i, w in enumerate(names)}, kinds_of(identities)

    def held() -> object:
        def of(texts: list[bytes]) -> list:
            rows, versions = [], []
            for text in texts:
                bag, pairs = features_of(words_of(text)), []
                rows.append(sorted(place[w] for w in place.keys() & bag))
                for sentence in text.replace(b"!", b".").replace(b"?", b".").replace(b"\n", b".").split(b"."):
                    plain = words_of(sentence)
                    own = {place[w] for w in features_of(plain) if w in place}
                    for other in swap(plain, kinds):
                        # only what differs matters: a linear score changes by the words that come less those that go
                        new = {place[w] for w in features_of(other) if w in place}
                        pairs.append(sorted(new - own) + [-1 - i for i in sorted(own - new)])
                versions.append(pairs)
            return [pa.array(rows, pa.list_(pa.int32())), pa.array(versions, pa.list_(pa.list_(pa.int32())))]

        return of

    got = common.over_texts(sample, held, "held array<int>, swaps array<array<int>>").toArrow().sort_by("doc_id")
    rows = [np.array(x, dtype=np.int64) for x in got.column("held").to_pylist()]
    swaps = [np.array(x, dtype=np.int64) for doc in got.column("swaps").to_pylist() for x in doc if x]
    weights, bias = descend(rows, got.column("label").to_numpy().astype(float), swaps, len(names), penalty, ridge)
    return Model({w: float(v) for w, v in zip(names, weights) if v}, float(bias))


def descend(rows, label, swaps, width: int, penalty: float, ridge: float, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Adam on the logistic loss, the ridge, and the squared score changes under swaps."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.concatenate(rows) if len(at) else np.zeros(0, np.int64)
    pair_at = np.repeat(np.arange(len(swaps)), [len(s) for s in swaps])
    signed = np.concatenate(swaps) if len(pair_at) else np.zeros(0, np.int64)
    sign, pair_col = np.where(signed < 0, -1.0, 1.0), np.where(signed < 0, -1 - signed, signed)
    n = len(rows)
    share = label.mean()
    w, bias = np.zeros(width), np.log(share / (1 - share))
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, rounds + 1):
        z = np.bincount(at, w[col], n) + bias
        gap = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - label
        grad = np.bincount(col, gap[at], width) + ridge * w
        if len(swaps):
            change = np.bincount(pair_at, sign * w[pair_col], len(swaps))
            grad += penalty * n / len(swaps) * np.bincount(pair_col, sign * change[pair_at], width)
        g = np.r_[grad, gap.sum()] / n
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        w, bias = w - step[:-1], bias - step[-1]
    return w, bias


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every document; empty and null texts get the score of no words."""
    return common.over_texts(common.documents(docs), lambda: lambda texts: [model.scores(texts)], "score double")


def clean(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The documents that score below ``threshold``, with all their columns."""
    return common.keep_texts(docs, lambda: lambda texts: (model.scores(texts) < threshold).tolist())
