"""Exact nearest neighbours of many rows in a pool of vectors."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tillwise.operators.ranking import top_per_group
from tillwise.session import materialise

# Rows of a tile on either side.
ROW_BLOCK, POOL_BLOCK = 4096, 16_384
# Pool rows of a cell, rows that are compared as one, and bytes of the rows that place the cuts between cells.
CELL, LEAF, SAMPLE_BYTES = 65_536, 256, 4 << 20


def over_tiles(
    rows: DataFrame,
    pool: DataFrame,
    row_key: str,
    pool_key: str,
    match: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
    row_block: int = ROW_BLOCK,
    pool_block: int = POOL_BLOCK,
) -> DataFrame:
    """``match`` of every block of rows with every block of the pool; the blocks hold about
    ``row_block`` and ``pool_block`` rows, dealt by a hash of their keys."""
    down = max(1, math.ceil(rows.count() / row_block))
    across = max(1, math.ceil(pool.count() / pool_block))

    def dealt(df: DataFrame, key: str, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_other - 1).cast("bigint")))
        return df.withColumns({own: F.pmod(F.xxhash64(key), F.lit(n_own)), other: copies})

    # both sides may come from one table: names of its own keep their columns apart
    pool = pool.select([F.col(c).alias(c) for c in pool.columns])
    tile = ["_row_block", "_pool_block"]
    left = dealt(rows, row_key, "_row_block", down, "_pool_block", across).groupBy(*tile)
    right = dealt(pool, pool_key, "_pool_block", across, "_row_block", down).groupBy(*tile)
    return left.cogroup(right).applyInPandas(match, schema)


def n_least(costs: np.ndarray, n: int) -> np.ndarray:
    """Mask of the ``n`` least entries of every row; of equal ones, those further left.

    Rounded, so that costs which differ only by the order of additions count as equal.
    """
    costs = np.round(costs, 9)
    if n >= costs.shape[1]:
        return np.ones(costs.shape, bool)
    border = np.partition(costs, n - 1, axis=1)[:, n - 1 : n]
    sure = costs < border
    equal = costs == border
    open_places = n - sure.sum(axis=1, keepdims=True)
    return sure | (equal & (np.cumsum(equal, axis=1) <= open_places))


def least_places(costs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of ``n_least``, in its order.

    The ``n``-th least of the first columns bounds what the whole row keeps, so that most entries are only compared with it.
    """
    width = costs.shape[1]
    some = max(4 * n, width // 16)
    if some >= width:
        return np.nonzero(n_least(costs, n))
    bound = np.partition(costs[:, :some], n - 1, axis=1)[:, n - 1 : n]
    # what is rounded to no more than the bound is may lie a little above it
    at, near = np.nonzero(costs <= bound + 2e-9 + 1e-12 * np.abs(bound))
    if np.isnan(bound).any() or len(at) > costs.size // 8:
        return np.nonzero(n_least(costs, n))
    order = np.lexsort((near, np.round(costs[at, near], 9), at))
    first = np.searchsorted(at, np.arange(len(costs)))
    kept = np.sort(order[np.arange(len(at)) - first[at[order]] < n])
    return at[kept], near[kept]


def _leaves(x: np.ndarray, size: int) -> list[np.ndarray]:
    """Places of the rows in groups of at most ``size`` near rows, halved along the widest side."""
    out, rest = [], [np.arange(len(x))]
    while rest:
        own = rest.pop()
        if len(own) <= size:
            out.append(own)
            continue
        side = np.ptp(x[own], axis=0).argmax()
        half = len(own) // 2
        order = np.argpartition(x[own, side], half)
        rest += [own[order[half:]], own[order[:half]]]
    return out


def _box_gaps(low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Squared distance of every row of ``x`` to every box."""
    out = np.zeros((len(x), len(low)))
    for i in range(x.shape[1]):
        v = x[:, i : i + 1]
        out += np.maximum(np.maximum(low[:, i] - v, v - high[:, i]), 0) ** 2
    return out


def _slack(gap: np.ndarray, scale: float) -> np.ndarray:
    """A bound that no gap passes which is rounded to no more than ``gap``, where squared lengths are up to ``scale``."""
    return gap + 2e-9 + 1e-12 * (np.abs(gap) + scale)


def _least_near(x: np.ndarray, bound: np.ndarray, known: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row of ``x`` the places of its ``n`` nearest rows of ``known``, and the gaps: the least first, then the foremost.

    What lies farther than the row's ``bound`` may be left out. Leaves of near rows meet, those farther than the n-th so far do not.
    """
    squares = (known**2).sum(axis=1)
    scale = squares.max() + (x**2).sum(axis=1).max()
    leaves = _leaves(known, LEAF)
    low, high = np.stack([known[own].min(axis=0) for own in leaves]), np.stack([known[own].max(axis=0) for own in leaves])
    parts, lengths = [np.ascontiguousarray(known[own].T) for own in leaves], [squares[own] for own in leaves]
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for rows in _leaves(x, LEAF):
        mine = x[rows]
        own = (mine**2).sum(axis=1)
        most = bound[rows].copy()
        best = np.full((len(rows), n), np.inf)
        apart = _box_gaps(low, high, mine)
        hits = []
        for leaf in np.argsort(apart.mean(axis=0)):
            at = np.flatnonzero(apart[:, leaf] <= _slack(most, scale))
            if not len(at):
                continue
            gaps = own[at, None] + lengths[leaf] - 2 * (mine[at] @ parts[leaf])
            best[at] = np.partition(np.concatenate([best[at], gaps], axis=1), n - 1, axis=1)[:, :n]
            most[at] = np.minimum(most[at], best[at].max(axis=1))
            row, near = np.nonzero(gaps <= _slack(most[at], scale)[:, None])
            hits.append((at[row], leaves[leaf][near], gaps[row, near]))
        if not hits:
            continue
        at, near, gap = (np.concatenate(part) for part in zip(*hits))
        kept = gap <= _slack(most[at], scale)
        at, near, gap = at[kept], near[kept], np.round(gap[kept], 9)
        order = np.lexsort((near, gap, at))
        at, near, gap = at[order], near[order], np.maximum(gap[order], 0.0)
        kept = np.arange(len(at)) - np.searchsorted(at, at) < n
        found.append((rows[at[kept]], near[kept], gap[kept]))
    return tuple(np.concatenate(part) for part in zip(*found))


def _rows_of(table: pa.Table) -> np.ndarray:
    return pc.list_flatten(table.column("_x")).to_numpy().reshape(table.num_rows, -1)


def _near_rows(left: pa.Table, right: pa.Table, n: int, skip_self: bool) -> tuple[np.ndarray, ...]:
    """Row of ``left``, place in ``right`` and gap of the ``n`` nearest of each row. ``right`` is in the order of its keys."""
    known = _rows_of(right)
    keys = right.column("near_key").combine_chunks().dictionary_encode()
    code = keys.indices.fill_null(-1).to_numpy()
    # a key may have several rows, none of which counts for itself
    more = int(np.unique(code, return_counts=True)[1].max()) if skip_self else 0
    mine, first, which = np.unique(_rows_of(left), axis=0, return_index=True, return_inverse=True)
    bound = np.full(len(mine), -np.inf)
    np.maximum.at(bound, which, left.column("_radius").to_numpy())
    at, near, gap = _least_near(mine, bound, known, n + more)
    order = np.argsort(at, kind="stable")
    at, near, gap = at[order], near[order], gap[order]
    begin = np.searchsorted(at, np.arange(len(mine)))
    number = np.bincount(at, minlength=len(mine))[which]
    row = np.repeat(np.arange(len(which)), number)
    slot = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number) + begin[which][row]
    if skip_self:
        self_code = pc.index_in(left.column("_key"), keys.dictionary).combine_chunks().fill_null(-2).to_numpy()
        self_code = np.where(left.column("_key").is_null().to_numpy(), -1, self_code)
        kept = code[near[slot]] != self_code[row]
        row, slot = row[kept], slot[kept]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < n
    return row[kept], near[slot[kept]], gap[slot[kept]]


class _Cells:
    """Cells of a space: a cut of each inner node, learnt from some rows, and the box of the rows in each cell."""

    def __init__(self, x: np.ndarray, rows: float, block: int):
        """Cells of about ``block`` rows at most, where ``rows`` stand behind each row of ``x``; rows that are equal stay together."""
        self.side, self.cut, self.next = [], [], []
        self.width = x.shape[1]
        rest = [(np.arange(len(x)), self._node())]
        while rest:
            own, node = rest.pop()
            if len(own) * rows <= block or len(own) < 2:
                continue
            for side in np.argsort(-np.ptp(x[own], axis=0)):
                values = np.sort(x[own, side])
                below = values[values < values[-1]]
                if len(below):
                    cut = min(values[(len(own) - 1) // 2], below[-1])
                    left = x[own, side] <= cut
                    self.side[node], self.cut[node], self.next[node] = side, cut, len(self.side)
                    a, b = self._node(), self._node()
                    rest += [(own[left], a), (own[~left], b)]
                    break

    def _node(self) -> int:
        self.side.append(-1)
        self.cut.append(0.0)
        self.next.append(-1)
        return len(self.side) - 1

    def of(self, x: np.ndarray) -> np.ndarray:
        side, cut, after, rows = np.array(self.side), np.array(self.cut), np.array(self.next), np.arange(len(x))
        node = np.zeros(len(x), np.int64)
        while (inner := side[node] >= 0).any():
            right = x[rows, np.maximum(side[node], 0)] > cut[node]
            node = np.where(inner, after[node] + right, node)
        return node


def _with_cells(rows: DataFrame, cells: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Each row once for each cell of it: ``cells`` gives places of rows and their cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                at, cell = cells(part)
                taken = part.take(pa.array(at))
                columns = [taken.column(c) if c != "_cell" else pa.array(cell, pa.int32()) for c in part.schema.names]
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return rows.mapInArrow(run, rows.schema)


def _meet(rows: DataFrame, pool: DataFrame, match: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``match`` of the rows of each cell with the pool of that cell; the rows in parts of about ``ROW_BLOCK``."""
    n = {r["_cell"]: math.ceil(r["n"] / ROW_BLOCK) for r in rows.groupBy("_cell").agg(F.count("*").alias("n")).collect()}
    if not n:
        return rows.sparkSession.createDataFrame([], schema)
    parts = F.element_at(F.create_map(*[F.lit(v) for pair in n.items() for v in pair]), F.col("_cell"))
    # equal rows meet in one part, where they are compared once
    left = rows.withColumn("_part", F.pmod(F.xxhash64("_x"), parts.cast("bigint")))
    right = pool.where(F.col("_cell").isin(*n)).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts.cast("bigint") - 1)))
    return left.groupBy("_cell", "_part").cogroup(right.groupBy("_cell", "_part")).applyInArrow(match, schema)


def nearest(
    rows: DataFrame,
    pool: DataFrame,
    n: int,
    key: str,
    vector: str,
    payload: str,
    skip_self: bool = False,
    block: int = CELL,
) -> DataFrame:
    """The ``n`` pool rows nearest to every row: key, near_key, gap (squared Euclidean
    distance), near_<payload> and rank. Equal gaps (to nine places) go to the smaller key.

    Exact. The pool is cut into cells of about ``block`` near rows, each with its box. Every row first meets the pool of the cell next to it; its
    n-th gap there says which other cells may hold nearer rows, and it meets only these. Of equal vectors the pool keeps the
    first keys, as many as a row can have among its nearest. Neither side passes through the driver but for some rows that
    place the cuts; it holds the boxes.
    """
    finite = lambda x: ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    key_type = rows.schema[key].dataType.simpleString()
    pool_key_type = pool.schema[key].dataType.simpleString()
    payload_type = pool.schema[payload].dataType.simpleString()
    x = F.col(vector).cast("array<double>").alias("_x")
    pool = pool.select(F.lit(0).alias("_cell"), F.col(key).alias("near_key"), x, F.col(payload).alias("_payload")).where(finite("_x"))
    rows = rows.select(F.lit(0).alias("_cell"), F.col(key).alias("_key"), x, F.lit(float("inf")).alias("_radius")).where(finite("_x"))
    size, boxes = pool.count(), None
    if size > block:
        place = F.dense_rank() if skip_self else F.row_number()
        pool = pool.withColumn("_place", place.over(Window.partitionBy("_x").orderBy("near_key"))).where(F.col("_place") <= n + skip_self).drop("_place")
        pool = materialise(pool, "pool")
        size = pool.count()
    if size > block:
        width = len(pool.select("_x").first()[0])
        share = min(1.0, SAMPLE_BYTES / (8 * width * size))
        some = pool.select("_x").sample(False, share, 42) if share < 1 else pool.select("_x")
        some = _rows_of(some.toArrow())
        cells = _Cells(some, size / max(len(some), 1), block)
        every = lambda part: (np.arange(part.num_rows), cells.of(_rows_of(part)))
        pool = materialise(_with_cells(pool, every), "cells")
        sides = [f(F.get("_x", F.lit(i))) for f in (F.min, F.max) for i in range(width)]
        found = pool.groupBy("_cell").agg(*[c.alias(f"s{i}") for i, c in enumerate(sides)]).toPandas().sort_values("_cell")
        names, boxes = found["_cell"].to_numpy(), found.drop(columns="_cell").to_numpy()
        low, high = boxes[:, :width], boxes[:, width:]

        def home(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
            return np.arange(part.num_rows), names[_box_gaps(low, high, _rows_of(part)).argmin(axis=1)]

        def others(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
            """The cells but the first one that may hold rows within the radius."""
            mine = _rows_of(part)
            scale = np.maximum(low**2, high**2).sum(axis=1).max() + (mine**2).sum(axis=1).max(initial=0.0)
            open_ = _box_gaps(low, high, mine) <= _slack(part.column("_radius").to_numpy(), scale)[:, None]
            at, cell = np.nonzero(open_ & (names[None, :] != part.column("_cell").to_numpy()[:, None]))
            return at, names[cell]

        rows = materialise(_with_cells(rows, home), "homes")

    def match(left: pa.Table, right: pa.Table) -> pa.Table:
        """Each row with its nearest in this cell, and the greatest of their gaps."""
        if left.num_rows and right.num_rows:
            right = right.take(pc.sort_indices(right, sort_keys=[("near_key", "ascending")], null_placement="at_start"))
            row, near, gap = _near_rows(left, right, n, skip_self)
        else:
            row, near, gap, right = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), right.slice(0, 0)
        number = np.bincount(row, minlength=left.num_rows)
        end = np.cumsum(number)
        radius = np.full(left.num_rows, np.inf)
        radius[number == n] = gap[end[number == n] - 1]
        taken = right.take(pa.array(near))
        found = [taken.column("near_key").combine_chunks(), pa.array(gap), taken.column("_payload").combine_chunks()]
        near_rows = pa.ListArray.from_arrays(pa.array(np.r_[0, end].astype(np.int32)), pa.StructArray.from_arrays(found, ["near_key", "gap", "_payload"]))
        return pa.table({"_cell": left.column("_cell"), "_key": left.column("_key"), "_x": left.column("_x"), "_radius": radius, "_near": near_rows})

    schema = f"_cell int, _key {key_type}, _x array<double>, _radius double, _near array<struct<near_key:{pool_key_type},gap:double,_payload:{payload_type}>>"
    met = _meet(rows, pool, match, schema)
    if boxes is not None:
        met = materialise(met, "near")
        met = met.unionByName(_meet(_with_cells(met.select("_cell", "_key", "_x", "_radius"), others), pool, match, schema))
    result = met.select(F.col("_key").alias(key), F.inline("_near").alias("near_key", "gap", f"near_{payload}"))
    return top_per_group(result, [key], n, F.asc("gap"), F.asc("near_key"), name="rank")
