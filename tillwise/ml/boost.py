"""Boosted trees of each class against the rest, all classes of which share each pass over the rows.

As Spark's boosted trees under the logistic loss: the first tree fits the sides, 1 and -1, every further one the slopes of the loss, by least squares,
and counts by the step size. Values are cut into bins once, so that a level of the next trees of all classes costs one pass that adds up sums per
node and bin; of two children only the smaller one is counted, as the other is what is left of their parent. The driver holds these sums, a number
set by depth, bins, features and classes. What the trees before say of a row is stored with it every ``KEPT`` rounds.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasRawPredictionCol, HasStepSize, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from tillwise.ml.forest import BLOCK, _blocks, _cuts
from tillwise.session import materialise

#: Rounds after which the sums of the trees are stored anew; rows that are scored at once.
KEPT, ROWS = 10, 1 << 14
#: A cut that sends all rows of a node to the left.
NEVER = 255

COLUMNS = "x binary, y binary, w binary, f binary"


def places(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, steps: int) -> np.ndarray:
    """Where every row (a column of ``x``) is after so many levels, from 0. Nodes are numbered as in a heap: the children of i are 2 i and 2 i + 1."""
    n = x.shape[1]
    flat, begin, rows = x.ravel(), feature.astype(np.int64) * n, np.arange(n)
    node = np.ones(n, np.int64)
    for _ in range(steps):
        right = flat.take(begin.take(node) + rows) > cut.take(node)
        node <<= 1
        node += right
    return node - (1 << steps)


def slopes(side: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """How the loss ``2 log(1 + exp(-2 side margin))`` falls with the margin."""
    return 4 * side / (1 + np.exp(np.clip(2 * side * margin, -500, 500)))


def best_splits(sums: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per node the feature, the last bin to the left, whether the split lessens the squares, and the sums to the left and of all.

    ``sums`` holds, per node, feature and bin, the weighted targets, the weights and the number of rows.
    """
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    whole = sums[:, 0].sum(axis=1)
    right = whole[:, None, None] - left

    def explained(s: np.ndarray) -> np.ndarray:
        return s[..., 0] ** 2 / np.where(s[..., 1] > 0, s[..., 1], np.inf)

    gain = explained(left) + explained(right) - explained(whole)[:, None, None]
    # the number of rows is whole, but for what is lost in differences
    gain = np.where((left[..., 2] > 0.5) & (right[..., 2] > 0.5), gain, -np.inf).reshape(len(sums), -1)
    if not gain.shape[1]:  # every feature is constant
        none = np.zeros(len(sums), np.int64)
        return none, none, np.zeros(len(sums), bool), np.zeros_like(whole), whole
    best, rows = gain.argmax(axis=1), np.arange(len(sums))
    at, last = np.divmod(best, left.shape[2])
    return at, last, gain[rows, best] > 1e-12 * whole[:, 1], left[rows, at, last], whole


def _added(rows: DataFrame, work: Callable[[dict], np.ndarray]) -> np.ndarray:
    """The sum of ``work`` over all blocks, within tasks and then over them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in batch.to_pylist():
                found = work(row)
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    return sum(np.frombuffer(s) for s in rows.mapInArrow(run, "sums binary").toArrow().column("sums").to_pylist())


class _Trees:
    """The next tree of one class while it grows."""

    def __init__(self, depth: int):
        self.feature, self.cut = np.zeros(1 << depth, np.uint8), np.full(1 << depth, NEVER, np.uint8)
        self.value = np.zeros(1 << depth)
        self.depth = depth
        #: Nodes to count in the next pass; and nodes whose sums are those of their parent less those of another.
        self.counted: list[int] = [1]
        self.left_over: dict[int, tuple[np.ndarray, int]] = {}

    def slots(self, level: int) -> np.ndarray:
        out = np.full(1 << level, -1)
        out[np.array(self.counted, np.int64) - (1 << level)] = np.arange(len(self.counted))
        return out

    def end(self, node: int, level: int, sums: np.ndarray) -> None:
        place = (node << (self.depth - level)) - (1 << self.depth)
        self.value[place] = sums[0] / sums[1] if sums[1] > 0 else 0.0

    def split(self, level: int, found: np.ndarray) -> None:
        """Split the nodes of a level, given the sums of those that were counted."""
        sums = dict(zip(self.counted, found))
        sums |= {node: parent - sums[other] for node, (parent, other) in self.left_over.items()}
        self.counted, self.left_over = [], {}
        if not sums:
            return
        nodes = sorted(sums)
        splits = best_splits(np.stack([sums[n] for n in nodes]))
        for node, at, last, better, left, whole in zip(nodes, *splits):
            if level == self.depth or not better:
                self.end(node, level, whole)
                continue
            self.feature[node], self.cut[node] = at, last
            sides = {2 * node: left, 2 * node + 1: whole - left}
            if level + 1 == self.depth:
                for child, own in sides.items():
                    self.end(child, level + 1, own)
            else:
                small, large = sorted(sides, key=lambda c: sides[c][2])
                self.counted.append(small)
                self.left_over[large] = (sums[node], small)


def grow(blocks: DataFrame, classes: int, width: int, bins: int, rounds: int, depth: int, step: float) -> tuple[np.ndarray, ...]:
    """Features, cuts and values of the nodes of all trees, by round and class. ``blocks`` are stored rows with their bins, classes and weights."""

    def columns(row: dict) -> Iterator[tuple[np.ndarray, ...]]:
        """Bins, classes, weights, and margins or slopes, a cache's worth of rows at a time."""
        x, f = np.frombuffer(row["x"], np.uint8).reshape(width, -1), np.frombuffer(row["f"], np.float32).reshape(classes, -1)
        y, w = np.frombuffer(row["y"], np.int32), np.frombuffer(row["w"])
        for start in range(0, f.shape[1], ROWS):
            own = slice(start, start + ROWS)
            yield x[:, own], y[own], w[own], f[:, own]

    def with_margins(state: DataFrame, trees: list, target: bool) -> DataFrame:
        """The rows with what further trees say added to their margins; or with the slopes there instead."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    found = []
                    for x, y, _, before in columns(row):
                        margin = before.astype(float)
                        for c in range(classes):
                            for feature, cut, value in trees:
                                margin[c] += value[c].take(places(x, feature[c], cut[c], depth))
                            if target:
                                side = np.where(y == c, 1.0, -1.0)
                                margin[c] = side if first else slopes(side, margin[c])
                        found.append(margin.astype(np.float32))
                    # the slopes are all that a pass needs of the classes
                    cells = [row["x"], b"" if target else row["y"], row["w"], np.concatenate(found, axis=1).tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], ["x", "y", "w", "f"])

        return state.mapInArrow(run, COLUMNS)

    state = blocks.select("x", "y", "w", F.expr(f"cast(repeat('\\0', cast(n * {4 * classes} as int)) as binary)").alias("f"))
    whole, pending = [], []
    for turn in range(rounds):
        first = turn == 0
        now = with_margins(state, pending, True).persist()
        try:
            trees = _next_trees(now, columns, classes, width, bins, depth)
        finally:
            now.unpersist()
        by = 1.0 if first else step
        pending.append(tuple(np.stack(t) for t in zip(*[(t.feature, t.cut, by * t.value) for t in trees])))
        whole.append(pending[-1])
        if len(pending) == KEPT and turn + 1 < rounds:
            state, pending = materialise(with_margins(state, pending, False), "boosted"), []
    return tuple(np.stack(part) for part in zip(*whole))


def _next_trees(now: DataFrame, columns: Callable, classes: int, width: int, bins: int, depth: int) -> list[_Trees]:
    """One tree for each class on the targets that stand beside the rows."""
    trees = [_Trees(depth) for _ in range(classes)]
    for level in range(max(1, depth)):
        counts = [len(t.counted) for t in trees]
        if not any(counts):
            break
        plans = [(c, t.feature, t.cut, t.slots(level), len(t.counted)) for c, t in enumerate(trees) if t.counted]

        def sums(row: dict, plans=plans, level=level) -> np.ndarray:
            out = [np.zeros((n, width, bins, 3)) for *_, n in plans]
            for x, _, w, target in columns(row):
                even = bool((w == w[0]).all())
                for whole, (c, feature, cut, slots, n) in zip(out, plans):
                    slot = slots.take(places(x, feature, cut, level))
                    kept = np.flatnonzero(slot >= 0)
                    weight, goal, slot = w.take(kept), target[c].take(kept) * w.take(kept), slot.take(kept) * bins
                    for j in range(width):
                        cell = slot + x[j].take(kept)
                        number = np.bincount(cell, minlength=n * bins)
                        # rows of one weight are only counted
                        weights = number * w[0] if even else np.bincount(cell, weight, n * bins)
                        found = np.column_stack([np.bincount(cell, goal, n * bins), weights, number])
                        whole[:, j] += found.reshape(n, bins, 3)
            return np.concatenate([whole.ravel() for whole in out])

        found = _added(now, sums).reshape(-1, width, bins, 3)
        for tree, n, end in zip(trees, counts, np.cumsum(counts)):
            tree.split(level, found[end - n : end])
    return trees


class _BoostedParams(HasFeaturesCol, HasPredictionCol, HasRawPredictionCol):
    maxDepth = Param(Params._dummy(), "maxDepth", "deepest level of a tree", TypeConverters.toInt)


class Boosted(Estimator, _BoostedParams, HasLabelCol, HasWeightCol, HasMaxIter, HasStepSize):
    """Boosted trees for each class against the rest, on numeric features."""

    maxBins = Param(Params._dummy(), "maxBins", "most bins of a feature", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", weightCol=None, maxIter=20, maxDepth=5, maxBins=32, stepSize=0.1, predictionCol="prediction", rawPredictionCol="rawPrediction"):
        super().__init__()
        self._setDefault(maxIter=20, maxDepth=5, maxBins=32, stepSize=0.1)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> BoostedModel:
        weight = F.col(self.getWeightCol()).cast("double") if self.isSet("weightCol") else F.lit(1.0)
        rows = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("int").alias("y"), weight.alias("w"))
        rows = materialise(rows, "boosted-rows")  # they may be dear, and are read several times
        seen = rows.agg(F.max("y"), F.max(F.size("x")), F.min("y"), F.count("*")).first()
        if seen[0] is None or seen[2] < 0:
            raise ValueError("boosted trees need rows, with labels from 0 on")
        cuts = _cuts(rows, seen[1], self.getOrDefault("maxBins"))
        # a pass over few rows costs what its tasks cost, so each has a block at least
        tasks = min(math.ceil(seen[3] / BLOCK), dataset.sparkSession.sparkContext.defaultParallelism)
        blocks = _blocks(rows.repartition(tasks), cuts, "y", "w", name="boosted-blocks")
        depth = self.getOrDefault("maxDepth")
        bins = max(len(c) for c in cuts) + 1
        grown = grow(blocks, seen[0] + 1, seen[1], bins, self.getMaxIter(), depth, self.getStepSize())
        feature, cut, value = [part.reshape(len(part) * (seen[0] + 1), -1).tolist() for part in grown]
        names = {c: self.getOrDefault(c) for c in ("featuresCol", "predictionCol", "rawPredictionCol")}
        return BoostedModel(cuts=cuts, feature=feature, cut=cut, value=value, classes=seen[0] + 1, maxDepth=depth, **names)


class BoostedModel(Model, _BoostedParams, DefaultParamsReadable, DefaultParamsWritable):
    """The class whose trees give most, and what those of each give."""

    cuts = Param(Params._dummy(), "cuts", "of each feature the last values of its bins", TypeConverters.toListListFloat)
    feature = Param(Params._dummy(), "feature", "of each tree the features of its nodes", TypeConverters.identity)
    cut = Param(Params._dummy(), "cut", "of each tree the last bins to the left of its nodes", TypeConverters.identity)
    value = Param(Params._dummy(), "value", "of each tree what the nodes of the last level give", TypeConverters.toListListFloat)
    classes = Param(Params._dummy(), "classes", "number of classes; trees follow each other by round and class", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, cuts=None, feature=None, cut=None, value=None, classes=None, maxDepth=None, featuresCol=None, predictionCol=None, rawPredictionCol=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cuts = [np.array(c) for c in self.getOrDefault("cuts")]
        trees = list(zip(np.array(self.getOrDefault("feature"), np.uint8), np.array(self.getOrDefault("cut"), np.uint8), np.array(self.getOrDefault("value"))))
        classes, depth = self.getOrDefault("classes"), self.getOrDefault("maxDepth")

        @F.pandas_udf("array<double>")
        def margins(vectors):
            import pandas as pd

            out = []
            for start in range(0, len(vectors), ROWS):
                values = np.stack(vectors.iloc[start : start + ROWS])
                x = np.stack([np.searchsorted(c, values[:, i]) for i, c in enumerate(cuts)]).astype(np.uint8)
                total = np.zeros((len(values), classes))
                for i, (feature, cut, value) in enumerate(trees):
                    total[:, i % classes] += value[places(x, feature, cut, depth)]
                out.extend(total)
            return pd.Series(out)

        scored = dataset.withColumn(self.getRawPredictionCol(), array_to_vector(margins(vector_to_array(self.getFeaturesCol()))))
        raw = vector_to_array(self.getRawPredictionCol())
        return scored.withColumn(self.getPredictionCol(), (F.array_position(raw, F.array_max(raw)) - 1).cast("double"))
