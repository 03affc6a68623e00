"""Random forests whose trees are grown, kept and applied by tasks.

Values are cut into bins once, so that a split needs sums per bin only. The upper levels of all trees are split together, from sums over
all rows, until a node has at most ``PIECE`` rows; the rows of such a node meet in one task, which grows the rest of its tree. A forest
is a stored table of pieces, a few per tree; the driver knows the upper levels alone, a number of nodes of about trees x rows / ``PIECE``.
Rows meet the pieces of a few trees at a time to be scored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasSeed, HasWeightCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise.session import materialise

#: Rows of a node that one task grows to the end, rows of a block, and nodes whose sums a task holds at once.
PIECE, BLOCK, SLOTS = 1 << 17, 1 << 16, 1 << 14
#: Nodes of a piece that are split at once; trees, and blocks of rows, that meet in one task to score.
CHUNK, TREES, SCORED = 1024, 4, 32
#: In place of a feature: a leaf (``child`` is the place of its sums), or a node that goes on in piece ``child``.
LEAF, ONWARD = 255, 254

NODES = "tree int, piece int, feature binary, bin binary, child binary, sums binary"


@dataclass
class Shape:
    """What all trees of a forest have in common."""

    trees: int
    depth: int
    leaf: int
    seed: int
    classes: int
    cuts: list[list[float]]

    @property
    def bins(self) -> int:
        return max(len(c) for c in self.cuts) + 1

    @property
    def tried(self) -> int:
        """Features tried per node: the root of their number."""
        return math.ceil(math.sqrt(len(self.cuts))) if self.trees > 1 else len(self.cuts)

    def drawn(self, nodes: int, random: np.random.Generator) -> np.ndarray:
        return random.random((nodes, len(self.cuts))).argsort(axis=1)[:, : self.tried]

    def copies(self, tree: int, block: int, n: int) -> np.ndarray:
        """How often each row of a block is drawn for a tree; the same in a repeated task."""
        if self.trees == 1:
            return np.ones(n, np.uint8)
        return np.minimum(np.random.default_rng([self.seed, tree, block]).poisson(1.0, n), 255).astype(np.uint8)


@dataclass
class Upper:
    """The upper levels of one tree, and the nodes to split next (node, depth)."""

    feature: list[int] = field(default_factory=lambda: [ONWARD])
    bin: list[int] = field(default_factory=lambda: [0])
    child: list[int] = field(default_factory=lambda: [0])
    sums: list[np.ndarray] = field(default_factory=list)
    open: list[tuple[int, int]] = field(default_factory=list)
    depths: dict[int, int] = field(default_factory=dict)

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.array(self.feature, np.uint8), np.array(self.bin, np.uint8), np.array(self.child, np.int32)

    def end(self, node: int, sums: np.ndarray) -> None:
        self.feature[node], self.child[node] = LEAF, len(self.sums)
        self.sums.append(sums)

    def onward(self, node: int, depth: int) -> None:
        self.child[node] = len(self.depths) + 1
        self.depths[self.child[node]] = depth


def walk(x: np.ndarray, feature: np.ndarray, bin: np.ndarray, child: np.ndarray) -> np.ndarray:
    """The last node that every row (a column of ``x``) reaches."""
    node, rows = np.zeros(x.shape[1], np.int32), np.arange(x.shape[1])
    while len(rows):
        at = node[rows]
        inner = feature[at] < ONWARD
        rows, at = rows[inner], at[inner]
        node[rows] = child[at] + (x[feature[at], rows] > bin[at])
    return node


def histogram(x, y, w, copies, slot, tried, bins: int, classes: int) -> np.ndarray:
    """Per node, feature tried and bin: weight of every class, and number of rows drawn."""
    nodes, rows = len(tried), np.arange(len(y))
    out = np.empty((nodes, tried.shape[1], bins, classes + 1))
    for j in range(tried.shape[1]):
        cell = slot * bins + x[tried[slot, j], rows]
        out[:, j, :, :classes] = np.bincount(cell * classes + y, w, nodes * bins * classes).reshape(nodes, bins, classes)
        out[:, j, :, classes] = np.bincount(cell, copies, nodes * bins).reshape(nodes, bins)
    return out


def _shares(sums: np.ndarray) -> np.ndarray:
    """Of each class; even ones if no row has a weight."""
    weight = sums.sum(axis=-1, keepdims=True)
    return np.where(weight > 0, sums / np.where(weight > 0, weight, 1), 1 / sums.shape[-1])


def _purity(sums: np.ndarray) -> np.ndarray:
    weight = sums.sum(axis=-1)
    return np.square(sums).sum(axis=-1) / np.where(weight > 0, weight, 1)


def best_splits(sums: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per node the place of the best feature, the last bin to the left, whether it lessens the Gini impurity, and the sums to the left."""
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    whole = sums[:, 0].sum(axis=1)
    right = whole[:, None, None] - left
    gain = _purity(left[..., :-1]) + _purity(right[..., :-1]) - _purity(whole[:, :-1])[:, None, None]
    gain = np.where((left[..., -1] >= leaf) & (right[..., -1] >= leaf), gain, -np.inf).reshape(len(sums), -1)
    if not gain.shape[1]:  # every feature is constant
        none = np.zeros(len(sums), np.int64)
        return none, none, np.zeros(len(sums), bool), np.zeros_like(whole)
    best = gain.argmax(axis=1)
    at, cut = np.divmod(best, left.shape[2])
    rows = np.arange(len(sums))
    return at, cut, gain[rows, best] > 1e-12 * whole[:, :-1].sum(axis=1), left[rows, at, cut]


def grow(x, y, w, copies, depth: int, shape: Shape, random: np.random.Generator) -> dict[str, np.ndarray]:
    """The subtree over the given rows, level by level, from ``depth`` on."""
    k, parts, slot, nodes, base = shape.classes, [], np.zeros(len(y), np.int64), 1, 0
    while nodes:
        sums = np.bincount(slot * k + y, w, nodes * k).reshape(nodes, k)
        drawn = np.bincount(slot, copies, nodes)
        feature, cut = np.full(nodes, LEAF, np.uint8), np.zeros(nodes, np.uint8)
        maybe = (drawn >= 2 * shape.leaf) & (np.count_nonzero(sums, axis=1) > 1) if depth < shape.depth else np.zeros(nodes, bool)
        kept = np.flatnonzero(maybe[slot])
        # rows of the same node side by side, for chunks of nodes
        kept = kept[np.argsort(slot[kept], kind="stable")]
        x, y, w, copies, slot = x[:, kept], y[kept], w[kept], copies[kept], slot[kept]
        tried, open_nodes = shape.drawn(nodes, random), np.flatnonzero(maybe)
        place = np.cumsum(maybe) - 1
        ends = np.searchsorted(slot, open_nodes, side="right")
        for first in range(0, len(open_nodes), CHUNK):
            some = open_nodes[first : first + CHUNK]
            rows = slice(ends[first - 1] if first else 0, ends[first + len(some) - 1])
            own = place[slot[rows]] - first
            found = histogram(x[:, rows], y[rows], w[rows], copies[rows], own, tried[some], shape.bins, k)
            at, last, better, _ = best_splits(found, shape.leaf)
            feature[some] = np.where(better, tried[some, at], LEAF)
            cut[some] = np.where(better, last, 0)
        split = feature != LEAF
        rank = np.cumsum(split) - 1
        parts.append((feature, cut, (base + nodes + 2 * rank).astype(np.int32), sums))
        kept = np.flatnonzero(split[slot])
        x, y, w, copies, slot = x[:, kept], y[kept], w[kept], copies[kept], slot[kept]
        slot = 2 * rank[slot] + (x[feature[slot], np.arange(len(slot))] > cut[slot])
        base, nodes, depth = base + nodes, 2 * int(split.sum()), depth + 1
    starts = np.cumsum([0, *[len(p[0]) for p in parts]])
    return _pruned(*map(np.concatenate, zip(*parts)), starts)


def _pruned(feature, cut, child, sums, starts) -> dict[str, np.ndarray]:
    """Without splits whose leaves all name the same class, as Spark prunes; ``starts`` are those of the levels."""
    named, alive = sums.argmax(axis=1), np.arange(len(feature)) == 0
    levels = [np.arange(a, b) for a, b in zip(starts, starts[1:])]
    for level in reversed(levels):
        inner = level[feature[level] != LEAF]
        a, b = child[inner], child[inner] + 1
        feature[inner[(feature[a] == LEAF) & (feature[b] == LEAF) & (named[a] == named[b])]] = LEAF
    for level in levels:
        inner = level[alive[level] & (feature[level] != LEAF)]
        alive[child[inner]] = alive[child[inner] + 1] = True
    number = np.cumsum(alive) - 1
    feature, cut, child, sums = feature[alive], cut[alive], child[alive], sums[alive]
    leaf = feature == LEAF
    child = np.where(leaf, np.cumsum(leaf) - 1, number[np.where(leaf, 0, child)])
    return {"feature": feature, "bin": cut, "child": child.astype(np.int32), "sums": sums[leaf]}


def _blocks(values: DataFrame, cuts: list[list[float]], *others: str, name: str) -> DataFrame:
    """Rows as stored blocks: the bins of ``values`` (column ``x``) by feature, and the other columns, as bytes."""
    width = len(cuts)
    columns = [F.col("x")[i].cast("double").alias(f"x{i}") for i in range(width)]
    sorted_cuts = [np.array(c) for c in cuts]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            x = np.stack([np.searchsorted(c, table.column(i).to_numpy()) for i, c in enumerate(sorted_cuts)]).astype(np.uint8)
            cells = [x.tobytes(), *[table.column(o).to_numpy().tobytes() for o in others]]
            return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells] + [pa.array([len(table)], pa.int64())], ["x", *others, "n"])

        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, BLOCK - n)
                held, n, batch = [*held, part], n + part.num_rows, batch.slice(part.num_rows)
                if n == BLOCK:
                    yield block(held)
                    held, n = [], 0
        if n:
            yield block(held)

    kinds = "".join(f", {o} binary" for o in others)
    packed = values.select(*columns, *others).mapInArrow(pack, f"x binary{kinds}, n bigint")
    return materialise(packed.withColumn("block", F.monotonically_increasing_id()), name)


def _cuts(values: DataFrame, width: int, bins: int) -> list[list[float]]:
    """Per feature the last value of every bin but the highest: all values if they are few, else of bins with about as many rows."""
    some = values.select([F.col("x")[i].alias(f"x{i}") for i in range(width)])
    few = some.agg(*[F.approx_count_distinct(f"x{i}") for i in range(width)]).first()
    out = some.approxQuantile(some.columns, [i / bins for i in range(1, bins)], 0.001)
    for i in range(width):
        if few[i] <= 2 * bins:
            found = sorted(r[0] for r in some.select(f"x{i}").distinct().limit(4 * bins).collect())
            if len(found) <= bins:
                out[i] = [(a + b) / 2 for a, b in zip(found, found[1:])]
    return [sorted(set(c)) for c in out]


def _records(rows: list[list], kinds: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, kinds)], [name for name, _ in kinds])


class _ForestParams(HasFeaturesCol, HasLabelCol, HasWeightCol, HasSeed):
    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "deepest level of a tree", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "least number of rows drawn on either side of a split", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "most bins of a feature", TypeConverters.toInt)


class Forest(Estimator, _ForestParams):
    """Random forest on numeric features, as Spark's: rows drawn with repeats per tree, bins, Gini impurity, and the root of the number
    of features tried per node. A forest of one tree takes all rows and features."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", weightCol=None, numTrees=20, maxDepth=5, minInstancesPerNode=1, maxBins=32, seed=42):
        super().__init__()
        self._setDefault(numTrees=20, maxDepth=5, minInstancesPerNode=1, maxBins=32, seed=42)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> ForestModel:
        weight = F.col(self.getWeightCol()).cast("double") if self.isSet("weightCol") else F.lit(1.0)
        rows = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("int").alias("y"), weight.alias("w"))
        seen = rows.agg(F.max("y"), F.max(F.size("x")), F.min("y")).first()
        if seen[0] is None or seen[2] < 0:
            raise ValueError("a forest needs rows, with labels from 0 on")
        cuts = _cuts(rows, seen[1], self.getOrDefault("maxBins"))
        shape = Shape(*[self.getOrDefault(p) for p in ("numTrees", "maxDepth", "minInstancesPerNode")], self.getSeed(), seen[0] + 1, cuts)
        blocks = _blocks(rows, cuts, "y", "w", name="forest-rows")
        upper = _upper_levels(blocks, shape)
        pieces = materialise(_lower_parts(blocks, upper, shape), "forest")
        fitted = ForestModel(pieces, cuts, shape.classes, shape.trees)
        fitted._set(featuresCol=self.getFeaturesCol())
        return fitted


def _shared_out(blocks: DataFrame, shape: Shape) -> DataFrame:
    """Every block once per group of trees (``group`` of ``groups``); the groups are as many as keep all cores busy."""
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    n = blocks.count()
    groups = max(1, min(shape.trees, math.ceil(3 * cores / n)))
    numbers = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
    return blocks.select("*", numbers, F.lit(groups).alias("groups")).repartition(n * groups, "block", "group")


def _units(batches: Iterator[pa.RecordBatch], shape: Shape):
    """Block, its columns, and the rows and copies drawn, for every tree of the groups in a task."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            x = np.frombuffer(row["x"], np.uint8).reshape(len(shape.cuts), -1)
            y, w = np.frombuffer(row["y"], np.int32), np.frombuffer(row["w"])
            for tree in range(row["group"], shape.trees, row["groups"]):
                copies = shape.copies(tree, row["block"], len(y))
                rows = np.flatnonzero(copies)
                yield tree, row["block"], x[:, rows], y[rows], w[rows], copies[rows]


def _upper_levels(blocks: DataFrame, shape: Shape) -> dict[int, Upper]:
    """All trees down to nodes of at most ``PIECE`` rows."""
    upper = {tree: Upper() for tree in range(shape.trees)}
    whole = blocks.agg(F.sum("n")).first()[0]
    for tree in upper.values():
        if whole > PIECE and shape.depth > 0:
            tree.open.append((0, 0))
        else:
            tree.onward(0, 0)
    if whole <= PIECE or shape.depth == 0:
        return upper
    units = _shared_out(blocks, shape)
    turn = 0
    while any(t.open for t in upper.values()):
        turn, room, plans = turn + 1, SLOTS, {}
        for number, tree in upper.items():
            now, tree.open = tree.open[:room], tree.open[room:]
            room -= len(now)
            if now:
                tried = shape.drawn(len(now), np.random.default_rng([shape.seed, number, turn, 1]))
                plans[number] = (now, tried, tree.arrays())
        for row in _splits(units, plans, shape):
            tree, (now, tried, _) = upper[row["tree"]], plans[row["tree"]]
            left, total = (np.frombuffer(row[c]).reshape(len(now), -1) for c in ("left", "whole"))
            for i, (node, depth) in enumerate(now):
                if not row["better"][i]:
                    tree.end(node, total[i, :-1])
                    continue
                first = len(tree.feature)
                tree.feature[node], tree.bin[node], tree.child[node] = int(tried[i, row["at"][i]]), row["cut"][i], first
                for sums in (left[i], total[i] - left[i]):
                    tree.feature.append(ONWARD)
                    tree.bin.append(0)
                    tree.child.append(0)
                    own = len(tree.feature) - 1
                    if depth + 1 == shape.depth:
                        tree.end(own, np.maximum(sums[:-1], 0))
                    elif sums[-1] > PIECE:
                        tree.open.append((own, depth + 1))
                    else:
                        tree.onward(own, depth + 1)
    return upper


def _splits(units: DataFrame, plans: dict, shape: Shape) -> list[dict]:
    """The best split of every planned node, one row per tree; tasks add up sums, and one task per tree compares them."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for tree, _, x, y, w, copies in _units(batches, shape):
            if tree in plans:
                now, tried, nodes = plans[tree]
                slots = np.full(len(nodes[0]), -1)
                slots[[node for node, _ in now]] = np.arange(len(now))
                slot = slots[walk(x, *nodes)]
                rows = np.flatnonzero(slot >= 0)
                found = histogram(x[:, rows], y[rows], (w * copies)[rows], copies[rows], slot[rows], tried, shape.bins, shape.classes)
                sums[tree] = sums[tree] + found if tree in sums else found
        for tree, found in sums.items():
            yield _records([[tree, found.tobytes()]], [("tree", pa.int32()), ("sums", pa.binary())])

    kinds = [("tree", pa.int32()), ("at", pa.list_(pa.int32())), ("cut", pa.list_(pa.int32())), ("better", pa.list_(pa.bool_()))]
    kinds += [("left", pa.binary()), ("whole", pa.binary())]

    def choose(key, table):
        tree = key[0].as_py()
        tried = plans[tree][1]
        # the order of additions is the same in a repeated task
        parts = sorted(table.column("sums").to_pylist())
        total = np.sum([np.frombuffer(p).reshape(*tried.shape, shape.bins, -1) for p in parts], axis=0)
        at, cut, better, left = best_splits(total, shape.leaf)
        whole = total[:, 0].sum(axis=1)
        return pa.Table.from_batches([_records([[tree, at.tolist(), cut.tolist(), better.tolist(), left.tobytes(), whole.tobytes()]], kinds)])

    added = units.mapInArrow(add, "tree int, sums binary")
    schema = "tree int, at array<int>, cut array<int>, better array<boolean>, left binary, whole binary"
    return added.groupBy("tree").applyInArrow(choose, schema).toArrow().to_pylist()


def _lower_parts(blocks: DataFrame, upper: dict[int, Upper], shape: Shape) -> DataFrame:
    """The pieces of all trees; piece 0 of each is its upper levels."""
    nodes = {number: tree.arrays() for number, tree in upper.items()}
    depths = {number: tree.depths for number, tree in upper.items()}
    kinds = [("tree", pa.int32()), ("piece", pa.int32()), ("block", pa.int64())] + [(c, pa.binary()) for c in ("x", "y", "w", "copies")]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, block, x, y, w, copies in _units(batches, shape):
            feature, _, child = nodes[tree]
            last = walk(x, *nodes[tree])
            piece = np.where(feature[last] == ONWARD, child[last], 0)
            order = np.argsort(piece, kind="stable")
            order = order[piece[order] > 0]
            for part in np.split(order, np.flatnonzero(np.diff(piece[order])) + 1):
                if len(part):
                    cells = [x[:, part], y[part], w[part], copies[part]]
                    yield _records([[tree, int(piece[part[0]]), block, *[c.tobytes() for c in cells]]], kinds)

    def finish(key, table):
        tree, piece = (k.as_py() for k in key)
        table = table.sort_by("block")
        x, y, w, copies = (
            [np.frombuffer(b, kind) for b in table.column(c).to_pylist()]
            for c, kind in (("x", np.uint8), ("y", np.int32), ("w", np.float64), ("copies", np.uint8))
        )
        x = np.concatenate([part.reshape(len(shape.cuts), -1) for part in x], axis=1)
        y, w, copies = np.concatenate(y), np.concatenate(w), np.concatenate(copies)
        grown = grow(x, y, w * copies, copies, depths[tree][piece], shape, np.random.default_rng([shape.seed, tree, piece, 2]))
        return pa.Table.from_batches([_records([[tree, piece, *[grown[c].tobytes() for c in ("feature", "bin", "child", "sums")]]], tops)])

    tops = [("tree", pa.int32()), ("piece", pa.int32())] + [(c, pa.binary()) for c in ("feature", "bin", "child", "sums")]
    rows = _shared_out(blocks, shape).mapInArrow(deal, "tree int, piece int, block bigint, x binary, y binary, w binary, copies binary")
    lower = rows.groupBy("tree", "piece").applyInArrow(finish, NODES)
    first = [
        (number, 0, *[bytearray(a.tobytes()) for a in tree.arrays()], bytearray(np.array(tree.sums, np.float64).tobytes()))
        for number, tree in upper.items()
    ]
    return blocks.sparkSession.createDataFrame(first, NODES).unionByName(lower)


def _whole_tree(pieces: list[dict], classes: int) -> tuple[np.ndarray, ...]:
    """The nodes of a tree, its pieces put together, and the shares of its leaves."""
    pieces = sorted(pieces, key=lambda p: p["piece"])
    kinds = {"feature": np.uint8, "bin": np.uint8, "child": np.int32}
    parts = [[np.frombuffer(p[c], kind) for c, kind in kinds.items()] for p in pieces]
    sums = [np.frombuffer(p["sums"]).reshape(-1, classes) for p in pieces]
    start = np.cumsum([0, *[len(p[0]) for p in parts]])
    leaves = np.cumsum([0, *[len(s) for s in sums]])
    feature, cut, child = (np.concatenate(c) for c in zip(*parts))
    for i in range(len(parts)):
        own = slice(start[i], start[i + 1])
        child[own] += np.where(feature[own] == LEAF, leaves[i], np.where(feature[own] < ONWARD, start[i], 0)).astype(np.int32)
    # a node that goes on in a piece becomes the first node of that piece
    place = {p["piece"]: start[i] for i, p in enumerate(pieces)}
    for node in np.flatnonzero(feature[: start[1]] == ONWARD):
        root = place[int(child[node])]
        feature[node], cut[node], child[node] = feature[root], cut[root], child[root]
    # what a piece could not see is pruned here: upper nodes whose two sides have ended with the same class
    sums, merged = np.concatenate(sums), []
    for node in range(start[1] - 1, -1, -1):
        if feature[node] < ONWARD:
            ends = [child[child[node] + side] for side in (0, 1) if feature[child[node] + side] == LEAF]
            both = [sums[e] if e < len(sums) else merged[e - len(sums)] for e in ends]
            if len(both) == 2 and both[0].argmax() == both[1].argmax():
                feature[node], child[node] = LEAF, len(sums) + len(merged)
                merged.append(both[0] + both[1])
    return feature, cut, child, _shares(np.concatenate([sums, *[m[None] for m in merged]])).astype(np.float32)


class ForestModel(Model, _ForestParams, MLReadable, MLWritable):
    """A fitted forest: ``pieces`` is a stored table. Adds rawPrediction, probability and prediction."""

    def __init__(self, pieces: DataFrame | None = None, cuts: list | None = None, classes: int = 0, trees: int = 0):
        super().__init__()
        self.pieces, self.cuts, self.classes, self.trees = pieces, cuts, classes, trees

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cuts, classes, columns = self.cuts, self.classes, dataset.columns
        # the rows are stored, as they meet their votes again by a number
        rows = materialise(dataset.withColumn("_row", F.monotonically_increasing_id()), "forest-scored")
        values = rows.select(vector_to_array(self.getFeaturesCol()).alias("x"), "_row")
        blocks = _blocks(values, cuts, "_row", name="forest-blocks")
        groups = math.ceil(self.trees / TREES)
        parts = max(1, math.ceil(blocks.count() / SCORED))

        def dealt(df: DataFrame, own: str, number, other: str, n: int) -> DataFrame:
            return df.withColumns({own: number, other: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))})

        def vote(left, right):
            found = []
            trees: dict[int, list[dict]] = {}
            for row in right.to_pylist():
                trees.setdefault(row["tree"], []).append(row)
            built = [_whole_tree(trees[t], classes) for t in sorted(trees)]
            for row in left.select(["block", "x"]).to_pylist():
                x = np.frombuffer(row["x"], np.uint8).reshape(len(cuts), -1)
                votes = np.zeros((x.shape[1], classes), np.float32)
                for feature, cut, child, shares in built:
                    votes += shares[child[walk(x, feature, cut, child)]]
                found.append([row["block"], votes.tobytes()])
            return pa.Table.from_batches([_records(found, [("block", pa.int64()), ("votes", pa.binary())])])

        def add(left, right):
            numbers = np.frombuffer(left.column("_row")[0].as_py(), np.int64)
            # the order of additions is the same in a repeated task
            parts = [np.frombuffer(v, np.float32) for v in sorted(right.column("votes").to_pylist())]
            votes = np.sum(parts, axis=0, dtype=np.float64).reshape(-1, classes)
            return pa.table({"_row": numbers, "_votes": pa.array(list(votes), pa.list_(pa.float64()))})

        blocks_left = dealt(blocks.select("block", "x"), "_part", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int"), "_group", groups)
        trees_right = dealt(self.pieces, "_group", (F.col("tree") % groups).cast("int"), "_part", parts)
        tile = ["_group", "_part"]
        votes = blocks_left.groupBy(*tile).cogroup(trees_right.groupBy(*tile)).applyInArrow(vote, "block bigint, votes binary")
        sums = blocks.select("block", "_row").groupBy("block").cogroup(votes.groupBy("block")).applyInArrow(add, "_row bigint, _votes array<double>")
        total = F.aggregate("_votes", F.lit(0.0), lambda a, v: a + v)
        share = F.transform("_votes", lambda v: v / total)
        best = F.array_position("_votes", F.array_max("_votes")) - 1
        return rows.join(sums, "_row").select(
            *columns,
            array_to_vector("_votes").alias("rawPrediction"),
            array_to_vector(share).alias("probability"),
            best.cast("double").alias("prediction"),
        )

    def copy(self, extra=None) -> ForestModel:
        other = super().copy(extra)
        other.pieces = self.pieces
        return other

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, fitted: ForestModel):
        super().__init__()
        self.fitted = fitted

    def saveImpl(self, path: str) -> None:
        told = {"cuts": self.fitted.cuts, "classes": self.fitted.classes, "trees": self.fitted.trees}
        DefaultParamsWriter.saveMetadata(self.fitted, path, self.sparkSession, extraMetadata=told)
        self.fitted.pieces.write.parquet(f"{path}/pieces")


class _Reader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> ForestModel:
        spark = SparkSession.getActiveSession()
        told = DefaultParamsReader.loadMetadata(path, spark)
        fitted = self.kind(spark.read.parquet(f"{path}/pieces"), told["cuts"], told["classes"], told["trees"])
        fitted._resetUid(told["uid"])
        DefaultParamsReader.getAndSetParams(fitted, told)
        return fitted
