"""Many fits of k-means and of Gaussian mixtures at once.

A step of such a fit is one pass over the rows and a few sums. All fits that are not done yet share each pass, so a sweep
over k with restarts costs as many passes as its longest fit, not the sum over all fits. Tasks hold a block of rows
and the sums of all fits; the driver holds the sums alone, a few numbers per cluster.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from tillwise.ml.prepare import SCALED
from tillwise.session import few_at_once, materialise

#: Rows that are compared with all centres at once.
ROWS = 2048
#: Rounds of drawing first centres, and draws per round and cluster.
DRAWS, OVER = 2, 2
EPSILON = np.finfo(float).eps


def packed(vectors: DataFrame) -> DataFrame:
    """The scaled vectors as stored blocks of doubles (block, width)."""
    width = len(vectors.select(SCALED).first()[0])
    v = vector_to_array(SCALED)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                block = np.column_stack([part.column(i).to_numpy() for i in range(width)])
                yield pa.RecordBatch.from_arrays([pa.array([block.tobytes()], pa.binary()), pa.array([width], pa.int32())], ["block", "width"])

    return materialise(vectors.select(*[v[i].alias(f"x{i}") for i in range(width)]).mapInArrow(pack, "block binary, width int"), "blocks")


def _pass(blocks: DataFrame, work: Callable[[np.ndarray, np.random.Generator], list[np.ndarray]], merge: Callable, seed: int = 0) -> list[np.ndarray]:
    """``work`` of every block, merged within tasks and then over them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a repeated task draws the same
        random, total = np.random.default_rng([seed, TaskContext.get().partitionId()]), None
        for batch in batches:
            # one block after the other is looked at where it lies: a batch may hold many
            for block, width in zip(batch.column("block"), batch.column("width").to_pylist()):
                found = work(np.frombuffer(block.as_buffer()).reshape(-1, width), random)
                total = found if total is None else [merge(a, b) for a, b in zip(total, found)]
        if total is not None:
            parts = [[x.tobytes() for x in total], [x.shape[-1] if x.ndim > 1 else 0 for x in total]]
            yield pa.RecordBatch.from_arrays([pa.array([parts[0]], pa.list_(pa.binary())), pa.array([parts[1]], pa.list_(pa.int32()))], ["parts", "width"])

    total = None
    with few_at_once(blocks.sparkSession):
        summed = blocks.mapInArrow(run, "parts array<binary>, width array<int>").toArrow()
    for row in summed.to_pylist():
        found = [np.frombuffer(x).reshape(-1, w) if w else np.frombuffer(x) for x, w in zip(row["parts"], row["width"])]
        total = found if total is None else [merge(a, b) for a, b in zip(total, found)]
    return total or []


def _drawn(blocks: DataFrame, wanted: list[int], seed: int) -> list[np.ndarray]:
    """For each number wanted as many rows at random: those of the least of evenly drawn numbers."""

    def work(x: np.ndarray, random: np.random.Generator) -> list[np.ndarray]:
        out = []
        for n in wanted:
            numbers = random.random(len(x))
            first = np.argsort(numbers)[:n]
            out.append(np.column_stack([numbers[first], x[first]]))
        return out

    def least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        both = np.concatenate([a, b])
        return both[np.argsort(both[:, 0])[: max(wanted)]]

    return [part[:n, 1:] for part, n in zip(_pass(blocks, work, least, seed), wanted)]


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] + (centres * centres).sum(axis=1) - 2 * x @ centres.T, 0)


def _spread(points: np.ndarray, weights: np.ndarray, k: int, random: np.random.Generator, rounds: int = 30) -> np.ndarray:
    """``k`` centres of a few weighted points: drawn one by one, far ones likelier, and then moved to the means."""
    kept = weights > 0
    points, weights = points[kept], weights[kept]
    if len(points) <= k:
        return points
    centres = points[[random.choice(len(points), p=weights / weights.sum())]]
    while len(centres) < k:
        chance = weights * _squares(points, centres).min(axis=1)
        if not chance.sum() > 0:
            break
        centres = np.concatenate([centres, points[[random.choice(len(points), p=chance / chance.sum())]]])
    for _ in range(rounds):
        one = np.equal.outer(np.arange(len(centres)), _squares(points, centres).argmin(axis=1)) * weights
        size = one.sum(axis=1, keepdims=True)
        moved = np.where(size > 0, one @ points / np.where(size > 0, size, 1), centres)
        if np.array_equal(moved, centres):
            break
        centres = moved
    return centres


@dataclass
class Fit:
    k: int
    seed: int
    centres: np.ndarray
    cost: float = np.inf
    done: bool = False


def _first_centres(blocks: DataFrame, settings: list[tuple[int, int]]) -> list[np.ndarray]:
    """Starts of k-means: rows drawn in rounds, each by its distance to those drawn before, weighted by the rows nearest to them."""
    seed = sum(s for _, s in settings)
    points = _drawn(blocks, [1] * len(settings), seed)
    for turn in range(DRAWS):

        def costs(x, random, points=points):
            return [np.array([_squares(x, p).min(axis=1).sum() for p in points])]

        whole = _pass(blocks, costs, np.add)[0]

        def draw(x, random, points=points, whole=whole):
            out = []
            for (k, _), p, cost in zip(settings, points, whole):
                chance = OVER * k * _squares(x, p).min(axis=1) / cost if cost > 0 else np.zeros(len(x))
                out.append(x[random.random(len(x)) < chance].reshape(-1, x.shape[1]))
            return out

        more = _pass(blocks, draw, lambda a, b: np.concatenate([a, b]), seed + turn + 1)
        points = [np.unique(np.concatenate([p, m]), axis=0) for p, m in zip(points, more)]

    def near(x, random, points=points):
        return [np.bincount(_squares(x, p).argmin(axis=1), minlength=len(p)).astype(float) for p in points]

    weights = _pass(blocks, near, np.add)
    return [_spread(p, w, k, np.random.default_rng(s)) for p, w, (k, s) in zip(points, weights, settings)]


def kmeans(blocks: DataFrame, settings: list[tuple[int, int]], steps: int = 300, close: float = 1e-4) -> list[Fit]:
    """A fit for each k and seed. The cost is that of the rows before the centres move for the last time; a fit is done when
    no centre moves further than ``close``."""
    fits = [Fit(k, seed, c) for (k, seed), c in zip(settings, _first_centres(blocks, settings))]
    for _ in range(steps):
        open_ = [f for f in fits if not f.done]
        if not open_:
            break
        every = np.concatenate([f.centres for f in open_])
        ends = np.cumsum([len(f.centres) for f in open_])

        def sums(x, random, every=every, ends=ends):
            far, squares = (every * every).sum(axis=1) - 2 * x @ every.T, (x * x).sum()
            with_one, total, costs = np.column_stack([x, np.ones(len(x))]), [], []
            for begin, end in zip(np.r_[0, ends[:-1]], ends):
                own = far[:, begin:end]
                nearest = own.argmin(axis=1)
                costs.append(own[np.arange(len(x)), nearest].sum() + squares)
                total.append(np.equal.outer(np.arange(end - begin), nearest).astype(float) @ with_one)
            return [np.concatenate(total), np.array(costs)]

        total, costs = _pass(blocks, sums, np.add)
        for fit, begin, end, cost in zip(open_, np.r_[0, ends[:-1]], ends, costs):
            size = total[begin:end, -1:]
            moved = np.where(size > 0, total[begin:end, :-1] / np.where(size > 0, size, 1), fit.centres)
            fit.done = bool((((moved - fit.centres) ** 2).sum(axis=1) <= close * close).all())
            fit.centres, fit.cost = moved, float(cost)
    return fits


def with_cluster(vectors: DataFrame, centres: np.ndarray, column: str = SCALED, name: str = "cluster") -> DataFrame:
    """Every row with its ``cluster``: the nearest centre, of equal ones the first."""
    v = vector_to_array(column)
    squares = F.array(*[sum(((v[i] - float(x)) * (v[i] - float(x)) for i, x in enumerate(c)), F.lit(0.0)) for c in centres])
    return vectors.withColumn(name, (F.array_position(squares, F.array_min(squares)) - 1).cast("int"))


class Centres(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """A fit of k-means as a stage of a pipeline: every row gets its nearest centre. ``cost`` is that of the fit."""

    centres = Param(Params._dummy(), "centres", "coordinates of the centres", TypeConverters.toListListFloat)
    cost = Param(Params._dummy(), "cost", "sum of squares around the centres", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, centres=None, cost=None, featuresCol=SCALED, predictionCol="cluster"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self._setDefault(featuresCol=SCALED, predictionCol="cluster")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return with_cluster(dataset, np.array(self.getOrDefault("centres")), self.getFeaturesCol(), self.getPredictionCol())


@dataclass
class Mixture:
    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    likelihood: float = -np.inf
    done: bool = False

    def roots(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each component the map to standard scale and the logarithm of its weight and density at the mean; flat directions are left out."""
        values, axes = np.linalg.eigh(self.covariances)
        kept = values > EPSILON * values.max(axis=1, keepdims=True) * values.shape[1]
        whole = np.where(kept, values, 1.0)
        scale = np.where(kept, 1 / np.sqrt(whole), 0.0)
        peak = np.log(self.weights) - 0.5 * (np.log(whole).sum(axis=1) + values.shape[1] * np.log(2 * np.pi))
        return axes * scale[:, None, :], peak


def with_component(vectors: DataFrame, fitted: Mixture) -> DataFrame:
    """Every row with its ``cluster``: the likeliest component, of equal ones the first."""
    means, (roots, peak) = fitted.means, fitted.roots()

    @F.pandas_udf("int")
    def likeliest(rows):
        import pandas as pd

        x = np.stack(rows.to_list()) if len(rows) else np.zeros((0, means.shape[1]))
        logs = [p - 0.5 * (((x - m) @ r) ** 2).sum(axis=1) for m, r, p in zip(means, roots, peak)]
        return pd.Series(np.argmax(logs, axis=0).astype(np.int32))

    return vectors.withColumn("cluster", likeliest(vector_to_array(SCALED)))


def mixtures(blocks: DataFrame, ks: list[int], seed: int, steps: int = 100, close: float = 0.01, drawn: int = 5) -> list[Mixture]:
    """Gaussian mixtures with full covariances by expectation and maximisation, one for each k; each begins at the means of a few drawn rows.

    The likelihood is that of the rows before the last step; a fit is done when it rises by less than ``close``.
    """
    fits = []
    for k, rows in zip(ks, _drawn(blocks, [k * drawn for k in ks], seed)):
        groups = [rows[i::k] if len(rows[i::k]) else rows for i in range(k)]
        spread = [np.diag(g.var(axis=0) if len(g) > 1 and g.var(axis=0).any() else np.ones(g.shape[1])) for g in groups]
        fits.append(Mixture(np.full(k, 1 / k), np.array([g.mean(axis=0) for g in groups]), np.array(spread)))
    for _ in range(steps):
        open_ = [f for f in fits if not f.done]
        if not open_:
            break
        terms = [(f.means, *f.roots()) for f in open_]

        def sums(x, random, terms=terms):
            out, likelihood = [], []
            with_one = np.column_stack([np.ones(len(x)), x])
            for means, roots, peak in terms:
                logs = np.column_stack([p - 0.5 * (((x - m) @ r) ** 2).sum(axis=1) for m, r, p in zip(means, roots, peak)])
                shares = EPSILON + np.exp(logs)
                whole = shares.sum(axis=1, keepdims=True)
                likelihood.append(np.log(whole).sum())
                shares /= whole
                # of each component the sum of shares, of shares times x, and of shares times x times x
                out += [((with_one * s[:, None]).T @ with_one) for s in shares.T]
            return [np.concatenate(out), np.array(likelihood)]

        total, likelihoods = _pass(blocks, sums, np.add)
        d = total.shape[1]
        total = total.reshape(-1, d, d)
        begin = 0
        for fit, likelihood in zip(open_, likelihoods):
            own = total[begin : begin + len(fit.weights)]
            begin += len(fit.weights)
            size = own[:, 0, 0]
            fit.weights, fit.means = size / size.sum(), own[:, 0, 1:] / size[:, None]
            fit.covariances = own[:, 1:, 1:] / size[:, None, None] - fit.means[:, :, None] * fit.means[:, None, :]
            fit.done = bool(abs(likelihood - fit.likelihood) <= close)
            fit.likelihood = float(likelihood)
    return fits
