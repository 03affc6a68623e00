"""Linear large-margin classifiers, all classes of which share each pass over the rows.

The loss of a machine (class against the rest) is the weighted mean of ``max(0, 1 - y f(x))`` plus half ``regParam`` times the squared length of its
coefficients in standard scale, as of Spark's LinearSVC. Its corners are rounded by ever smaller arcs; on each the machine goes by Newton steps
to the least loss, and on to the next. Every rounded optimum also gives a bound from below for the true loss, so a machine ends by its gap, or
with the last arc. Tasks add up losses, gradients and curvatures of their blocks; the driver holds these sums, a square of the number of features
for each class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasRawPredictionCol, HasRegParam, HasWeightCol
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from tillwise.ml.together import _pass as summed
from tillwise.session import materialise

#: Bytes of a block of rows. A writer would hold a hundred before it asks how large they are, and a reader holds a page and a group of them, for each core.
BLOCK_BYTES = 512 << 10
GROUP = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 4, "parquet.enable.dictionary": "false", "compression": "none"}
#: Half widths of the arcs, and most steps on one.
ARCS, STEPS = [3.0, 1.0, 0.3, 0.1, 0.03, 0.01, 0.003, 0.001], 25
#: Lengths of a Newton step that are tried at once.
LENGTHS = np.r_[1.5, 1.25, 1.0, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.5 ** np.arange(2, 24)]
#: A machine ends when its loss is within this share of the least, and an arc when a step gains less than a tenth of it.
CLOSE = 1e-4


def rounded_loss(gap: np.ndarray, arc: float) -> np.ndarray:
    """``max(0, gap)`` with an arc from -``arc`` to ``arc``; nowhere less, and at most ``arc`` / 4 more."""
    return np.where(gap >= arc, gap, np.maximum(gap + arc, 0) ** 2 / (4 * arc))


@dataclass
class Machine:
    """One class against the rest: coefficients in standard scale and intercept, and how far it is."""

    at: np.ndarray
    level: int = 0
    steps: int = 0
    done: bool = False

    @property
    def arc(self) -> float:
        return ARCS[self.level]

    def onward(self) -> None:
        self.done, self.level, self.steps = self.level + 1 == len(ARCS), min(self.level + 1, len(ARCS) - 1), 0


def _blocks(rows: DataFrame, width: int, total: float, means: np.ndarray, scale: np.ndarray) -> DataFrame:
    """Stored blocks of the rows: features in standard scale (0 where ``scale`` is), a one, the label, and the share of the weights."""
    most = max(1, BLOCK_BYTES // (8 * (width + 3)))
    by = np.where(scale > 0, 1 / np.where(scale > 0, scale, 1), 0)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, most):
                part = batch.slice(start, most)
                z = (part.column("x").flatten().to_numpy().reshape(-1, width) - means) * by
                block = np.column_stack([z, np.ones(len(z)), part.column("y").to_numpy(), part.column("w").to_numpy() / total])
                yield pa.RecordBatch.from_arrays([pa.array([block.tobytes()], pa.binary()), pa.array([width + 3], pa.int32())], ["block", "width"])

    return materialise(rows.mapInArrow(pack, "block binary, width int"), "margin-rows", GROUP)


def fit(blocks: DataFrame, classes: int, width: int, penalty: float, close: float = CLOSE) -> np.ndarray:
    """For each class a row of coefficients in standard scale, and the intercept."""
    width += 1
    ridge = np.r_[np.full(width - 1, penalty), 0.0]
    machines = [Machine(np.zeros(width)) for _ in range(classes)]

    def rows(x):
        return x[:, :-2], x[:, -2], x[:, -1]

    while any(not m.done for m in machines):
        open_ = [c for c in range(classes) if not machines[c].done]
        points, arcs = np.array([machines[c].at for c in open_]), [machines[c].arc for c in open_]

        def slopes(x, random, points=points, arcs=arcs, open_=open_):
            z, y, w = rows(x)
            out = []
            for c, at, arc in zip(open_, points, arcs):
                side = np.where(y == c, 1.0, -1.0)
                gap = 1 - side * (z @ at)
                share = w * np.clip((gap + arc) / (2 * arc), 0, 1)
                bent = np.flatnonzero(abs(gap) < arc)
                curve = z[bent].T @ (z[bent] * (w[bent] / (2 * arc))[:, None])
                losses = np.r_[w @ np.maximum(gap, 0), w @ rounded_loss(gap, arc), share.sum()]
                out.append(np.concatenate([curve.ravel(), -(share * side) @ z, losses]))
            return [np.array(out)]

        steps, losses = [], []
        for c, at, sums in zip(open_, points, summed(blocks, slopes, np.add)[0]):
            curve = sums[: width * width].reshape(width, width) + np.diag(ridge + 1e-9)
            slope = sums[width * width : -3] + ridge * at
            half = 0.5 * float(ridge @ at**2)
            # the shares are a point of the dual problem as far as the slope is none
            gap = sums[-3] + 2 * half - sums[-1]
            step = -np.linalg.solve(curve, slope)
            gain = -float(slope @ step) / 2
            # without rows on the arc the curvature says little
            step *= min(1.0, 10 * (1 + np.linalg.norm(at)) / max(np.linalg.norm(step), 1e-300))
            machine, loss = machines[c], sums[-3] + half
            settled = gain <= max(close, machine.arc / 10) / 10 * loss
            if gain <= close / 10 * loss and abs(gap) <= close * loss:
                machine.done = True
            elif settled or machine.steps == STEPS:
                machine.onward()
            machine.steps += 1
            steps.append(np.zeros(width) if settled else step)
            losses.append(sums[-2] + half)
        moving = [i for i, s in enumerate(steps) if s.any()]
        if not moving:
            continue

        def along(x, random, points=points, arcs=arcs, open_=open_, steps=steps, moving=moving):
            z, y, w = rows(x)
            out = []
            for i in moving:
                side = np.where(y == open_[i], 1.0, -1.0)
                gap, change = 1 - side * (z @ points[i]), side * (z @ steps[i])
                out.append([w @ rounded_loss(gap - t * change, arcs[i]) for t in LENGTHS])
            return [np.array(out)]

        for i, found in zip(moving, summed(blocks, along, np.add)[0]):
            whole = found + [0.5 * float(ridge @ (points[i] + t * steps[i]) ** 2) for t in LENGTHS]
            machine = machines[open_[i]]
            if whole.min() < losses[i]:
                machine.at = points[i] + LENGTHS[whole.argmin()] * steps[i]
            else:
                machine.onward()
    return np.array([m.at for m in machines])


class Margin(Estimator, HasFeaturesCol, HasLabelCol, HasWeightCol, HasRegParam, HasPredictionCol, HasRawPredictionCol):
    """A linear large-margin classifier of each class against the rest; features are standardised for the penalty."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", weightCol=None, regParam=0.0, predictionCol="prediction", rawPredictionCol="rawPrediction"):
        super().__init__()
        self._setDefault(regParam=0.0)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> MarginModel:
        weight = F.col(self.getWeightCol()).cast("double") if self.isSet("weightCol") else F.lit(1.0)
        column = self.getFeaturesCol()
        rows = dataset.select(F.col(column).alias("v"), F.col(self.getLabelCol()).cast("double").alias("y"), weight.alias("w"))
        spread = Summarizer.metrics("mean", "std").summary(F.col("v"), F.col("w")).alias("spread")
        seen = rows.agg(spread, F.max("y").alias("last"), F.sum("w").alias("total")).first()
        if seen.last is None:
            raise ValueError("a margin classifier needs rows")
        means, scale = seen.spread.mean.toArray(), seen.spread.std.toArray()
        blocks = _blocks(rows.select(vector_to_array("v").alias("x"), "y", "w"), len(means), seen.total, means, scale)
        at = fit(blocks, int(seen.last) + 1, len(means), self.getRegParam())
        coefficients = np.where(scale > 0, at[:, :-1] / np.where(scale > 0, scale, 1), 0.0)
        intercepts = at[:, -1] - coefficients @ means
        names = {c: self.getOrDefault(c) for c in ("featuresCol", "predictionCol", "rawPredictionCol")}
        return MarginModel(coefficients=coefficients.ravel().tolist(), intercepts=intercepts.tolist(), **names)


class MarginModel(Model, HasFeaturesCol, HasPredictionCol, HasRawPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """The class whose machine gives most, and what each gives. Built-in expressions only."""

    coefficients = Param(Params._dummy(), "coefficients", "coefficients of the classes, one after the other", TypeConverters.toListFloat)
    intercepts = Param(Params._dummy(), "intercepts", "intercept of each class", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, coefficients=None, intercepts=None, featuresCol=None, predictionCol=None, rawPredictionCol=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        intercepts = self.getOrDefault(self.intercepts)
        table = np.column_stack([np.reshape(self.getOrDefault(self.coefficients), (len(intercepts), -1)), intercepts])
        x = F.concat(vector_to_array(self.getFeaturesCol()), F.array(F.lit(1.0)))
        one = lambda t, x: F.aggregate(F.zip_with(t, x, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
        # the row's features become a variable, so that they are made once
        every = F.transform(F.array(x), lambda x: F.transform(F.lit(table.tolist()), lambda t: one(t, x)))[0]
        scored = dataset.withColumn(self.getRawPredictionCol(), array_to_vector(every))
        raw = vector_to_array(self.getRawPredictionCol())
        return scored.withColumn(self.getPredictionCol(), (F.array_position(raw, F.array_max(raw)) - 1).cast("double"))
