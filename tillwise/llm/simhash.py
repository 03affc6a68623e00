"""SimHash fingerprints, and the groups of documents whose fingerprints differ in few bits.

Two fingerprints that differ in at most 3 of 64 bits differ in at most 1 bit of one half. Each half of 32 bits
is covered by the code words of a perfect Hamming code (31 bits, covering radius 1) and a plain bit. These code words
are the anchors: a fingerprint lies within 1 of its nearest anchor, so any fingerprint that differs from it in 1 bit
of the half lies within 2 of that anchor. Every fingerprint is replicated to all anchors within 2, the covering
radius plus what may differ, and compared there with those to which the anchor is nearest. Anchors near which more
than ``HOT`` fingerprints lie are divided again by the anchors of the other half's two quarters (15 bits and one).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm import common, shingles
from tillwise.session import materialise

SHINGLE, SEED, MOST_BITS = 3, 42, 3
#: Fingerprints nearest to one anchor from which on the anchor is divided; pairs that a task compares at once.
HOT, PAIRS_AT_ONCE = 4096, 1 << 21


def fingerprint(text: bytes) -> int:
    """64 bits, each set if over half of the shingles' XXH64 hashes have it set; zero without words."""
    words = text.lower().split()  # of bytes: A-Z alone, and ASCII white space alone
    if not words:
        return 0
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(64, np.int64), len(words) - SHINGLE + 1
    for start in range(0, n, 1 << 16):
        part = words[start : start + (1 << 16) + SHINGLE - 1]
        hashes = np.array([digest(b"%b %b %b" % s, SEED) for s in zip(part, part[1:], part[2:])], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and its fingerprint as a (signed) long, for every row; null texts are empty."""

    def make():
        return lambda texts: [np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64)]

    return common.over_texts(common.documents(docs), make, "fp long")


class Cover:
    """The anchors around fields of ``2**r`` bits: code words of the Hamming code of 2**r - 1 bits, and one plain bit."""

    def __init__(self, r: int):
        size = (1 << r) - 1
        self.plain = np.uint64(1 << size)
        self.tests = [np.uint64(sum(1 << (i - 1) for i in range(1, size + 1) if i >> j & 1)) for j in range(r)]
        bit = lambda i: 1 << (i - 1) if i else 0
        around = [[bit(s), bit(s) | 1 << size] + [bit(i) | bit(i ^ s) for i in range(1, size + 1) if s and i < i ^ s] for s in range(size + 1)]
        self.width = max(map(len, around))
        #: By syndrome: what to flip for the nearest anchor (first) and for all others within 2 bits; filled up with the first.
        self.flips = np.array([a + a[:1] * (self.width - len(a)) for a in around], dtype=np.uint64)
        self.filled = np.array([len(a) for a in around])

    def anchors(self, field: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, anchor and whether it is the row's nearest, for every anchor within 2 of each value."""
        syndrome = np.zeros(len(field), np.int64)
        for j, test in enumerate(self.tests):
            syndrome |= (np.bitwise_count(field & test).astype(np.int64) & 1) << j
        real = np.arange(self.width)[None, :] < self.filled[syndrome][:, None]
        row, place = np.nonzero(real)
        return row, (field[:, None] ^ self.flips[syndrome])[real], place == 0


_HALF, _QUARTER = Cover(5), Cover(4)
_KEYED = "key long, fp long, near boolean"


def _batch(key: np.ndarray, fp: np.ndarray, near: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(near)], ["key", "fp", "near"])


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, 1 << 16):
        yield batch.slice(start, 1 << 16)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _chunks(batch):
            fp = part.column("fp").to_numpy().view(np.uint64)
            for half in (0, 1):
                row, anchor, near = _HALF.anchors(fp >> np.uint64(32 * half) & np.uint64(0xFFFFFFFF))
                yield _batch(np.uint64(half << 32) | anchor, fp[row], near)


def _divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _chunks(batch):
            key, fp = part.column("key").to_numpy().view(np.uint64), part.column("fp").to_numpy().view(np.uint64)
            was = part.column("near").to_numpy(zero_copy_only=False)
            other = fp >> (np.uint64(32) * (np.uint64(1) - (key >> np.uint64(32)))) & np.uint64(0xFFFFFFFF)
            for quarter in (0, 1):
                row, anchor, near = _QUARTER.anchors(other >> np.uint64(16 * quarter) & np.uint64(0xFFFF))
                # 62: divided, 61-28: the first anchor, 27: the quarter, 15-0: the second anchor
                yield _batch(np.uint64(1 << 62 | quarter << 27) | key[row] << np.uint64(28) | anchor, fp[row], near & was[row])


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0 to n - 1 and links between a and b, the smallest node that each reaches."""
    label = np.arange(n)
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        open_ = low != high
        if not open_.any():
            return label
        a, b = a[open_], b[open_]
        np.minimum.at(label, high[open_], low[open_])
        further = label[label]
        while not np.array_equal(further, label):
            label, further = further, further[further]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same fingerprints as those between a and b, one for each but the smallest of a group."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = roots(len(nodes), at[: len(a)], at[len(a) :])
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among the fingerprints of each anchor; rows come sorted by anchor, and an anchor may go on in the next batch."""
    key, fp, near = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
    a, b = np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def linked(key, fp, near):
        begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[begin, len(key)])
        bucket = np.repeat(np.arange(len(begin)), size)
        who = np.flatnonzero(near & (size[bucket] > 1))
        each = size[bucket[who]]
        ends = np.cumsum(each)
        done = 0
        while done < len(who):  # as many near rows at once as make PAIRS_AT_ONCE pairs, or one
            upto = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + PAIRS_AT_ONCE, "right")))
            w, e = who[done:upto], each[done:upto]
            left = np.repeat(w, e)
            right = np.arange(len(left)) - np.repeat(np.cumsum(e) - e, e) + np.repeat(begin[bucket[w]], e)
            close = (np.bitwise_count(fp[left] ^ fp[right]) <= MOST_BITS) & (fp[left] != fp[right])
            yield fp[left[close]], fp[right[close]]
            done = upto

    def out():
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    def absorb(key, fp, near):
        nonlocal a, b
        for x, y in linked(key, fp, near):
            if len(x):
                a, b = forest(np.r_[a, x], np.r_[b, y])

    for batch in batches:
        key = np.r_[key, batch.column("key").to_numpy()]
        fp = np.r_[fp, batch.column("fp").to_numpy().view(np.uint64)]
        near = np.r_[near, batch.column("near").to_numpy(zero_copy_only=False)]
        cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
        if cut:
            absorb(key[:cut], fp[:cut], near[:cut])
            key, fp, near = key[cut:], fp[cut:], near[cut:]
        if len(a) > 1 << 20:  # hand on what is found, so that a task holds a bounded number of links
            yield out()
            a, b = a[:0], b[:0]
    if len(key):
        absorb(key, fp, near)
    yield out()


def links(distinct: DataFrame, hot: int = HOT) -> DataFrame:
    """a and b: links that connect exactly the fingerprints of ``distinct`` (column fp) which ``MOST_BITS`` connect."""
    keyed = distinct.select("fp").mapInArrow(_replicate, _KEYED)
    crowded = materialise(keyed.where("near").groupBy("key").count().where(F.col("count") > hot).select("key"), "anchors")
    if not crowded.isEmpty():
        divided = keyed.join(crowded, "key", "left_semi").select("key", "fp", "near").mapInArrow(_divide, _KEYED)
        keyed = keyed.join(crowded, "key", "left_anti").select("key", "fp", "near").unionByName(divided)
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_compare, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node that it reaches) of every node with a link; all work is joins and minima.

    Two steps by turns until nothing changes: every node hands its smallest neighbour to its larger neighbours, then
    to its smaller ones. Each round is written to the shared folder.
    """

    def star(edges: DataFrame) -> DataFrame:
        """edges: (u, v) with u > v. Larger neighbours first, then smaller ones."""
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        larger = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        larger = larger.distinct()
        low = larger.groupBy("u").agg(F.min("v").alias("m"))
        moved = larger.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        return moved.where(F.col("u") != F.col("v")).distinct()

    def state(edges: DataFrame):
        return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = materialise(
        edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    seen = state(edges)
    while seen[0]:
        edges = materialise(star(edges), "links")
        now = state(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the smallest doc_id that links reach) of every row.

    Texts without words have fingerprint zero and are linked like any other. Rows without id are fingerprinted and link
    others; their component_id is that of their group, null if none of it has an id. Rows that share an id are rows
    of their own, each with its own group.
    """
    stored = materialise(fingerprints(docs), "fingerprints")
    distinct = materialise(stored.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    rooted = distinct.join(components(links(distinct)), F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = rooted.join(smallest, "root").select("fp", "component_id")
    return stored.join(known, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def rooted(distinct: DataFrame, found: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """key, least, n, bits and root (shared by texts that the links found connect) of each text, and the stored key and root of those whose root is another text."""
    own = distinct.select("key", "least", "n", "bits")
    if found is None:
        roots = own.withColumn("root", F.col("key"))
    else:
        of = components(found).withColumnRenamed("node", "key")
        # stored, as each step that asks for roots would join all texts anew
        roots = materialise(own.join(of, "key", "left").withColumn("root", F.coalesce("root", "key")), "roots")
    return roots, materialise(roots.where("root != key").select("key", "root"), "moved")


def with_root(df: DataFrame, moved: DataFrame, key: str = "key", root: str = "root") -> DataFrame:
    """``df`` with the root of its ``key``; ``moved`` has those that are not their own."""
    named = moved.select(F.col("key").alias(key), F.col("root").alias(root))
    return common.narrowed(df, named, key, "left").withColumn(root, F.coalesce(root, key))


def near_copies(
    distinct: DataFrame, texts: DataFrame, crowd: int = shingles.CROWD, large: int = shingles.LARGE, few: int = shingles.FEW, rounds: int = 2, spans: int = 3
) -> DataFrame:
    """key, least and root (shared by texts that links connect) of every row of ``distinct`` (key, least, fp, n, bits, first; see ``shingles.marks``).

    Links are pairs whose five-word shingles agree to 0.8. Groups of copies are taken together first, by fingerprints within ``MOST_BITS`` and by
    the first four shingles, along spanning pairs; then all texts are joined exactly with those of other groups, so that every link between any two
    texts is found, or lies within a group that other links connect. Crowded buckets give spanning pairs first, one a text and at most ``spans`` times,
    and only what is still apart pair by pair. ``texts`` has doc_id, key and text of all rows.
    """
    of = distinct.groupBy("fp").agg(F.min("key").alias("key"))
    near = links(of)
    for side in ("a", "b"):
        near = near.join(of.select(F.col("fp").alias(side), F.col("key").alias(f"key_{side}")), side)
    near = near.select(F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b"))

    def apart(pairs: DataFrame, moved: DataFrame) -> DataFrame:
        """The pairs of different roots."""
        return with_root(with_root(pairs, moved, "a", "root_a"), moved, "b", "root_b").where("root_a != root_b").drop("root_a", "root_b")

    def alike(pairs: DataFrame) -> DataFrame:
        return materialise(shingles.verified(pairs, texts, distinct), "alike")

    found = None
    roots, moved = rooted(distinct, None)
    for turn in range(rounds):
        # one text of a group is enough here
        own = distinct if not turn else common.narrowed(distinct, moved.select("key"), "key", "left_anti")
        buckets = own.select("key", "n", F.col("key").alias("root"), F.explode(F.slice("first", 1, 4)).alias("band"))
        pairs = shingles.meeting(buckets, few, neighbours=True).select("a", "b")
        pairs = pairs.unionByName(near) if not turn else pairs
        new = alike(shingles.nearest(shingles.screened(pairs, roots)))
        found = new if found is None else found.unionByName(new)
        roots, moved = rooted(distinct, found)

    buckets = with_root(distinct.select("key", "n", "first"), moved).select("key", "n", "root", F.explode("first").alias("band"))
    pairs, crowds = shingles.met(buckets, roots, texts, crowd, large)
    pairs = materialise(shingles.once(pairs), "pairs")
    for turn in range(spans):
        spanning = shingles.crowded_pairs(crowds, roots, spanning=True)
        candidates = shingles.once(spanning if turn else pairs.unionByName(spanning))
        new = alike(shingles.nearest(candidates))
        if new.isEmpty():
            break
        found = found.unionByName(new)
        roots, moved = rooted(distinct, found)
    # what spanning pairs have not brought together is compared pair by pair
    left = shingles.once(apart(pairs, moved).unionByName(shingles.crowded_pairs(crowds, roots)))
    new = alike(left)
    return roots if new.isEmpty() else rooted(distinct, found.unionByName(new))[0]


def deduplicate(docs: DataFrame, crowd: int = shingles.CROWD, large: int = shingles.LARGE, few: int = shingles.FEW) -> DataFrame:
    """The documents of which each group of near copies keeps one, the one with the smallest doc_id; of repeated rows of it, one.

    Near copies share 0.8 of their five-word shingles; texts of fewer words are copies if their words are the same, and all texts without words, null
    ones among them, are one text. Rows are judged by id and text: rows that share an id but no group
    are kept or dropped each by its own group. Rows without id can't be told apart and all stay. All columns stay. Texts are told apart by
    64-bit hashes; a long text costs a task its words and shingles, eight bytes each.
    """

    def make():
        def of(texts: list[bytes]) -> list:
            return [np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64), *shingles.marks(texts)]

        return of

    texts = common.documents(docs).withColumn("key", F.xxhash64("text"))
    made = common.over_texts(texts, make, f"fp long, {shingles.MARKS}")
    stored = materialise(made.withColumn("at", F.monotonically_increasing_id()), "marks")
    # rows of a text are added up before anything travels, and one of them stands for all
    texts_once = materialise(stored.groupBy("key").agg(F.min("doc_id").alias("least"), F.min("at").alias("at")), "texts")
    distinct = materialise(common.narrowed(stored.drop("doc_id", "key"), texts_once, "at", "inner").drop("at"), "distinct")
    roots = near_copies(distinct, texts, crowd, large, few)
    smallest = roots.groupBy("root").agg(F.min("least").alias("least"))
    keepers = materialise(roots.join(smallest, ["root", "least"]).select(F.col("least").alias("doc_id"), "key", "root"), "keepers")

    own, text, place = (common.fresh(docs, c) for c in ("judged_id", "judged_text", "judged_root"))
    named = [F.col("doc_id").alias(own), F.col("key").alias(text)]
    id_, hashed = F.col("doc_id").cast("long"), F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    same = (id_ == F.col(own)) & (hashed == F.col(text))
    kept = docs.join(keepers.select(named).hint("shuffle_hash"), same, "left_semi")
    kept = kept.unionByName(docs.where(F.col("doc_id").isNull()))
    rows = stored.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n")).join(keepers, ["doc_id", "key"])
    several = rows.groupBy("doc_id", "root").agg(F.sum("n").alias("rows")).where(F.col("rows") > 1).select("doc_id", "root")
    again = materialise(keepers.join(several, ["doc_id", "root"], "left_semi").select(*named, F.col("root").alias(place)), "repeated")
    if again.isEmpty():
        return kept
    # only rows that share an id and a group are gathered, and the first of each in the order of their content stays
    single = kept.join(again, same, "left_anti")
    content = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    first = kept.join(again, same).groupBy(own, place).agg(F.min(content).alias("row"))
    return single.unionByName(first.select("row.*"))
