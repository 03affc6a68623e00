"""The prefix trie of conversations, from double arrays over shards of their paths.

Turns are numbered, and a prefix is named by the exclusive or of hashes of its turns, each hashed with its place: such names are running
aggregates, so the longest conversation is named in slices like any other rows, and a prefix's parent follows from its name and its last turn.
Paths are cut into bands of ``BAND`` turns, equal bands below equal prefixes are counted once, and the rest is dealt by ranges of prefix, so
that a shard holds neighbouring paths and a crowded prefix spreads over many shards. Each shard numbers its turns densely, packs its paths into
BASE and CHECK arrays (the child of state s by turn c is BASE[s] + c, and CHECK there is s), and walks them for its nodes. Nodes
that several shards share, those of the upper levels, are merged by their names. Sums over subtrees follow by doubling:
after round k every node holds the sum of its descendants up to 2^k below it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.operators.ranking import global_rank
from tillwise.session import materialise

#: Turns of a band, distinct bands of a shard, rows of a slice in which names run on.
BAND, SHARD, SLICE = 16, 8192, 4096
#: Ids that are joined at a time for a digest.
IDS = 1 << 14


def numbered(df: DataFrame, group: str, *order: Column, running: dict[str, Column] | None = None, slice_: int = SLICE) -> DataFrame:
    """Every row with its place in its group (``pos``, from 1) and the running exclusive or, within the group, of some longs.

    ``running`` has columns of ``pos``. Groups of any size are spread over tasks by ranges of ``group`` and ``order``, which must end in a unique key.
    """
    ranked = global_rank(df, F.col(group), *order, name="rank")
    first = ranked.groupBy(group).agg(F.min("rank").alias("first"))
    placed = ranked.join(first, group).withColumn("pos", F.col("rank") - F.col("first") + 1).drop("first")
    if not running:
        return placed.drop("rank")
    placed = placed.withColumns({**running, "slice": F.floor(F.col("rank") / slice_)})
    inside = Window.partitionBy("slice").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    placed = materialise(placed.withColumns({f"{c}_sum": F.bit_xor(c).over(inside) for c in running}), "running")
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("slice").agg(*[F.bit_xor(c).alias(c) for c in running])
    before = totals.select("slice", *[F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in running])
    whole = {f"{c}_sum": F.col(f"{c}_sum").bitwiseXOR(F.col(f"{c}_before")) for c in running}
    whole = placed.join(before, "slice").withColumns(whole).drop("slice", *[f"{c}_before" for c in running])
    start = whole.where("pos = 1").select(group, *[F.col(f"{c}_sum").bitwiseXOR(F.col(c)).alias(f"{c}_start") for c in running])
    own = {f"{c}_sum": F.col(f"{c}_sum").bitwiseXOR(F.col(f"{c}_start")) for c in running}
    return whole.join(start, group).withColumns(own).drop("rank", *[f"{c}_start" for c in running])


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1, by turn, null first), two hashes of role and text, and the text's code points.

    Null roles and texts are empty; rows without conv_id take no part; rows of the same turn stand in a fixed order of their content.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("k1"),
        F.xxhash64(text, F.lit("turn"), role).alias("k2"),
        F.length(text).alias("length"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = F.col("turn").asc_nulls_first(), F.col("k1"), F.col("k2"), F.col("row")
    return numbered(rows, "conv_id", *order).select("conv_id", "pos", "k1", "k2", "length")


def grafted(rows: DataFrame, stem: Column, taken: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first ``taken`` turns of another one, ``stem``, and go on with their own after as many.

    Both are columns of conv_id; ``taken`` is small. Gives the turns (conv_id, part, pos and the other columns), of which ``part`` and then ``pos``
    is the order, and the ids of all conversations, those left without turns among them.
    """
    ids = materialise(rows.groupBy("conv_id").agg(F.lit(1).alias("one")).select("conv_id", stem.alias("stem"), taken.alias("taken")), "conversations")
    most = ids.agg(F.max("taken")).first()[0] or 0
    heads = rows.where(F.col("pos") <= most).join(ids.select("stem").distinct(), F.col("conv_id") == F.col("stem"), "left_semi")
    heads = heads.withColumnRenamed("conv_id", "stem").join(ids, "stem").where(F.col("pos") <= F.col("taken"))
    own = rows.where(F.col("pos") > taken).withColumn("part", F.lit(1))
    return own.unionByName(heads.drop("stem", "taken").withColumn("part", F.lit(0))), ids.select("conv_id")


class DoubleArray:
    """A trie of paths over labels 0 to ``labels`` - 1, packed level by level; state 0 is the root."""

    def __init__(self, labels: int):
        self.labels = labels
        self.base = np.zeros(2 * labels + 2, np.int64)
        self.check = np.full(2 * labels + 2, -1, np.int64)
        self.check[0] = 0
        self.free, self.end = 1, 1  # no slot below the first is free, none from the second is taken

    def place(self, children: np.ndarray) -> int:
        """A base at which the slots of all children are free: from the first free slot, or behind all."""
        least = int(children[0])
        while self.free < len(self.check) and self.check[self.free] >= 0:
            self.free += 1
        at = self.free
        for _ in range(32):
            slots = at - least + children
            if slots[-1] >= len(self.check):
                break
            if (self.check[slots] < 0).all():
                return at - least
            later = np.flatnonzero(self.check[at + 1 : at + 257] < 0)
            if not len(later):
                break
            at += 1 + int(later[0])
        return self.end - least

    def grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.r_[self.base, np.zeros(more, np.int64)]
            self.check = np.r_[self.check, np.full(more, -1, np.int64)]

    def add_level(self, states: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Packs the children (state and label, which may repeat) of states that have none yet; gives each child's state."""
        pairs, which = np.unique(states * self.labels + labels, return_inverse=True)
        parent, label = pairs // self.labels, pairs % self.labels
        begin = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]]) if len(parent) else np.zeros(0, np.int64)
        ends = np.r_[begin[1:], len(parent)]
        slots = np.zeros(len(pairs), np.int64)
        for b, e in zip(begin.tolist(), ends.tolist()):
            base = self.place(label[b:e])
            self.end = max(self.end, base + int(label[e - 1]) + 1)
            self.grow(self.end)
            self.base[parent[b]] = base
            slots[b:e] = base + label[b:e]
            self.check[slots[b:e]] = parent[b]
        return slots[which]

    def step(self, states: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """The child of each state by each label; -1 where there is none."""
        slots = self.base[states] + labels
        inside = (slots > 0) & (slots < len(self.check))
        return np.where(inside & (self.check[np.where(inside, slots, 0)] == states), slots, -1)


_PATH = ["k1", "k2", "f1", "f2", "length"]
_NODE = "p1 long, p2 long, q1 long, q2 long, depth long, length long, n long, least long"


def walked(shard: pa.Table, levels: int) -> pa.RecordBatch:
    """The nodes of a shard's bands (r1, r2, band, path, n, least) below the prefixes r at which they begin."""
    path = shard.column("path").combine_chunks()
    size = np.diff(path.offsets.to_numpy())
    k1, k2, f1, f2, length = (path.flatten().field(c).to_numpy(zero_copy_only=False) for c in _PATH)
    r1, r2, band, n, least = (shard.column(c).to_numpy() for c in ("r1", "r2", "band", "n", "least"))
    # dense ids: turns first, then the prefixes at which bands begin
    _, turn = np.unique(np.stack([k1, k2], axis=1), axis=0, return_inverse=True)
    _, root = np.unique(np.stack([r1, r2], axis=1), axis=0, return_inverse=True)
    turn, root = turn.ravel(), root.ravel()
    most = int(turn.max()) + 1
    trie = DoubleArray(most + int(root.max()) + 1)
    states = trie.add_level(np.zeros(len(root), np.int64), most + root)
    begin, top = np.r_[0, np.cumsum(size)[:-1]], states.copy()
    for d in range(int(size.max())):
        going = np.flatnonzero(size > d)
        states[going] = trie.add_level(states[going], turn[begin[going] + d])
    # from the roots again, now along the arrays: what goes through a state belongs to its node
    states, p1, p2, out = top, r1.copy(), r2.copy(), []
    count, low = np.zeros(len(trie.check), np.int64), np.full(len(trie.check), np.iinfo(np.int64).max)
    for d in range(int(size.max())):
        going = np.flatnonzero(size > d)
        place = begin[going] + d
        states[going] = trie.step(states[going], turn[place])
        at = states[going]
        np.add.at(count, at, n[going])
        np.minimum.at(low, at, least[going])
        q1, q2 = p1[going], p2[going]
        p1[going], p2[going] = q1 ^ f1[place], q2 ^ f2[place]
        slot, one = np.unique(at, return_index=True)
        out.append([p1[going][one], p2[going][one], q1[one], q2[one], (band[going] * levels + d + 1)[one], length[place][one], count[slot], low[slot]])
    columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _NODE.split(", ")])


def _shards(levels: int, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                held, rows = [*held, part], rows + part.num_rows
                if rows >= size:
                    yield walked(pa.Table.from_batches(held), levels)
                    held, rows = [], 0
        if rows:
            yield walked(pa.Table.from_batches(held), levels)

    return run


def prefixes(rows: DataFrame, levels: int = BAND, shard: int = SHARD) -> DataFrame:
    """The nodes (see ``_NODE``: own and parent's name, depth, last text's length, members, smallest member), but for the root, of named turns."""
    rows = rows.withColumn("band", F.floor((F.col("pos") - 1) / levels))
    turn = F.struct("pos", *_PATH)
    bands = rows.groupBy("conv_id", "band").agg(
        F.sort_array(F.collect_list(turn)).alias("path"),
        F.min_by(F.struct("q1", "q2"), "pos").alias("q"),
    )  # as many turns as a band has levels
    path = F.transform("path", lambda x: F.struct(*[x[c].alias(c) for c in _PATH]))
    bands = bands.select("conv_id", "band", F.col("q.q1").alias("r1"), F.col("q.q2").alias("r2"), path.alias("path"))
    distinct = bands.groupBy("r1", "r2", "band", "path").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"))
    keys = ["r1", "r2", "path"]
    dealt = distinct.repartitionByRange(*keys).sortWithinPartitions(*keys)
    found = dealt.select("r1", "r2", "band", "path", "n", "least").mapInArrow(_shards(levels, shard), _NODE)
    sums = [F.any_value(c).alias(c) for c in ("q1", "q2", "depth", "length")]
    return found.groupBy("p1", "p2").agg(*sums, F.sum("n").alias("n"), F.min("least").alias("least"))


def over_subtrees(nodes: DataFrame, values: list[str]) -> DataFrame:
    """p1, p2 and the sums of ``values`` over each node and its descendants; (q1, q2) names the parent, null below the root."""
    state = materialise(nodes.select("p1", "p2", F.col("q1").alias("a1"), F.col("q2").alias("a2"), *values), "subtrees")
    while not state.where("a1 IS NOT NULL").isEmpty():
        above = state.where("a1 IS NOT NULL").groupBy("a1", "a2").agg(*[F.sum(v).alias(f"{v}_more") for v in values])
        above = above.select(F.col("a1").alias("p1"), F.col("a2").alias("p2"), *[f"{v}_more" for v in values])
        summed = state.join(above, ["p1", "p2"], "left")
        summed = summed.select("p1", "p2", "a1", "a2", *[(F.col(v) + F.coalesce(f"{v}_more", F.lit(0))).alias(v) for v in values])
        further = state.where("a1 IS NOT NULL").select(F.col("p1").alias("a1"), F.col("p2").alias("a2"), F.col("a1").alias("b1"), F.col("a2").alias("b2"))
        nearer = summed.join(further, ["a1", "a2"], "left")
        state = materialise(nearer.select("p1", "p2", F.col("b1").alias("a1"), F.col("b2").alias("a2"), *values), "subtrees")
    return state.select("p1", "p2", *values)


def digests(ends: DataFrame) -> DataFrame:
    """p1, p2 and the SHA-256 of the ids (conv_id, ascending, decimal, comma-joined) that end there.

    Ids are joined in parts over ranges; a digest then reads its parts in order, one at a time.
    """
    keys = ["p1", "p2", "conv_id"]

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, ids = (batch.column(c).to_numpy() for c in keys)
            begin = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, np.int64)
            cuts = np.unique(np.r_[begin, np.arange(0, len(a), IDS)]).astype(np.int64)
            parts = [",".join(map(str, x)) for x in np.split(ids, cuts[1:])] if len(a) else []
            yield pa.RecordBatch.from_arrays([pa.array(a[cuts]), pa.array(b[cuts]), pa.array(ids[cuts]), pa.array(parts, pa.string())], names=[*keys, "part"])

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for batch in batches:
            done = []
            for a, b, part in zip(*(batch.column(c).to_pylist() for c in ("p1", "p2", "part"))):
                if (a, b) != now:
                    if sha:
                        done.append((*now, sha.hexdigest()))
                    now, sha = (a, b), hashlib.sha256(part.encode())
                else:
                    sha.update(b"," + part.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(("p1", "p2", "ends"), x)) for x in done], schema=_DIGEST)
        if sha:
            yield pa.RecordBatch.from_pylist([{"p1": now[0], "p2": now[1], "ends": sha.hexdigest()}], schema=_DIGEST)

    parts = ends.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(joined, "p1 long, p2 long, conv_id long, part string")
    return parts.repartition("p1", "p2").sortWithinPartitions(*keys).mapInArrow(digested, "p1 long, p2 long, ends string")


_DIGEST = pa.schema([("p1", pa.int64()), ("p2", pa.int64()), ("ends", pa.string())])


def nodes(rows: DataFrame, members: DataFrame, *order: str, levels: int = BAND, shard: int = SHARD, slice_: int = SLICE) -> DataFrame:
    """One row for each node of the trie of ``rows`` (conv_id, k1, k2, length, and the ``order`` of a conversation's turns).

    ``members`` has all conv_ids, once each, those without turns among them, which belong to the root alone; without members there is no node.
    Columns: conv_id (smallest member), depth, parent_conv_id (the parent's conv_id; null for the root), n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256. Turns are told apart by 128 bits. No group is held in one task but a band of ``BAND`` turns; the digest
    of the ids that end in one node reads them in order, part by part, as a digest must.
    """
    running = {"f1": F.xxhash64("k1", "k2", "pos"), "f2": F.xxhash64("pos", F.lit("place"), "k2", "k1")}
    named = numbered(rows, "conv_id", *map(F.col, order), running=running, slice_=slice_)
    named = named.withColumnsRenamed({"f1_sum": "p1", "f2_sum": "p2"})
    named = materialise(named.withColumns({f"q{i}": F.col(f"p{i}").bitwiseXOR(F.col(f"f{i}")) for i in (1, 2)}), "turns")
    found = materialise(prefixes(named, levels, shard), "nodes")
    last = named.groupBy("conv_id").agg(F.max_by(F.struct("p1", "p2"), "pos").alias("p"))
    last = members.join(last, "conv_id", "left").select(
        "conv_id", F.coalesce("p.p1", F.lit(0)).alias("p1"), F.coalesce("p.p2", F.lit(0)).alias("p2")
    )
    ends = materialise(digests(last), "ends")
    children = found.groupBy("q1", "q2").agg(F.count(F.lit(1)).alias("n_children"))
    children = materialise(children.select(F.col("q1").alias("p1"), F.col("q2").alias("p2"), "n_children"), "children")
    inner = found.join(children, ["p1", "p2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    top = (F.col("q1") == 0) & (F.col("q2") == 0)
    valued = inner.select(
        "p1", "p2",
        *[F.when(~top, F.col(q)).alias(q) for q in ("q1", "q2")],
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n") - 1) * F.col("length")).alias("saved_tokens"),
    )
    sums = over_subtrees(valued, ["n_leaves", "saved_tokens"])
    parents = found.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("least").alias("parent_least"))
    n_all, least = members.agg(F.count(F.lit(1)), F.min("conv_id")).first()
    below = inner.select("p1", "p2", "q1", "q2", "depth", "n", "least", "n_children").join(sums, ["p1", "p2"])
    below = below.join(parents, ["q1", "q2"], "left")
    below = below.withColumn("parent_conv_id", F.when(top, F.lit(least)).otherwise(F.col("parent_least")))
    first = found.where(top).select("p1", "p2").join(sums, ["p1", "p2"])
    n_first, leaves, saved = first.agg(F.count(F.lit(1)), F.sum("n_leaves"), F.sum("saved_tokens")).first()
    names = ["p1", "p2", "depth", "n", "least", "n_children", "n_leaves", "saved_tokens", "parent_conv_id"]
    top_row = [(0, 0, 0, n_all, least, n_first, leaves or 1, saved or 0, None)] if n_all else []
    root = rows.sparkSession.createDataFrame(top_row, ", ".join(f"{c} long" for c in names))
    every = below.select(root.columns).unionByName(root).join(ends, ["p1", "p2"], "left")
    return every.select(
        F.col("least").alias("conv_id"),
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def conversation_nodes(conversations: DataFrame) -> DataFrame:
    """The trie of conversations as they are: see ``nodes``; further columns take no part."""
    rows = materialise(turns(conversations), "turns")
    return nodes(rows, rows.select("conv_id").distinct(), "pos")


def grafted_nodes(conversations: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """The trie of conversations of which each begins with turns of the last one whose id ``every`` divides, ``crc32(id) % most`` of them."""
    id_ = F.col("conv_id")
    rows = materialise(turns(conversations), "turns")
    grown, ids = grafted(rows, id_ - id_ % every, F.crc32(id_.cast("string")) % most)
    return nodes(grown.withColumnRenamed("pos", "place"), ids, "part", "place")
