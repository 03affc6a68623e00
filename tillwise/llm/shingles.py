"""Near copies by five-word shingles: an exact join of all texts whose Jaccard similarity is 0.8 or more.

A text is the set of its hashed shingles, in the order of the hashes. Two texts of n and m shingles that are alike share one of the first
n - ceil(0.8 n) + 1 of the one with one of the first m - ceil(0.8 m) + 1 of the other, in this order as in any other that both follow; so
texts meet in a bucket for each of their first shingles, and no pair is lost. Which pairs of a bucket are worth a look is decided by
bounds that never reject a true pair: the sizes, and the parities of the shingles in about as many cells, of which each that differs
stands for a shingle that only one of the texts has. Only then are whole sets compared.

A passage that many unlike texts share fills buckets. A crowded bucket is compared in its task, by size and parities, and only pairs that pass
leave it. Texts that known links connect have one root and are not compared again, so a group of copies need not meet pair by pair. The texts of large buckets take another order among themselves, in which the shingles of those buckets come last, and meet again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm import common
from tillwise.session import materialise

WORDS, ALIKE = 5, Fraction(4, 5)
#: Cells of a text's parities at least; else the next power of two from its number of shingles.
BITS = 256
#: Buckets up to this size are compared pair by pair where groups of copies are first taken together; of larger ones only neighbours.
FEW = 16
#: Buckets of more texts are crowded, and of more than the second number large.
CROWD, LARGE = 64, 512
#: Shingles that are put last, at most (the order is valid whichever they are), and how often texts are put in a new order.
COMMON, ORDERS = 1 << 20, 2
#: Bytes of sets that are compared at once, and pairs of a bucket.
SET_BYTES, PAIRS_AT_ONCE = 4 << 20, 1 << 18

_draw = np.random.default_rng(42)
_PLACE = _draw.integers(1, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def hashed(text: bytes) -> np.ndarray:
    """The distinct shingles of a text as sorted longs: runs of five words, or all words of a text with fewer.

    A-Z is lowered, and words end at ASCII white space.
    """
    words = np.array([xxhash.xxh64_intdigest(w) for w in text.lower().split()], dtype=np.uint64)
    if len(words) < WORDS:
        words = np.r_[words, np.zeros(WORDS - len(words), np.uint64)]
    n = len(words) - WORDS + 1
    return np.unique(_mixed(sum(words[i : i + n] * _PLACE[i] for i in range(WORDS))).view(np.int64))


def leading(n: int) -> int:
    """How many of the first of n shingles any text alike must share one of."""
    return n - -(-n * ALIKE.numerator // ALIKE.denominator) + 1


def parities(shingles: np.ndarray) -> bytes:
    """For each cell whether an odd number of shingles falls into it. Halves laid over each other are the parities in half as many cells."""
    cells = max(BITS, 1 << (len(shingles) - 1).bit_length())
    return np.packbits(np.bincount(shingles & (cells - 1), minlength=cells) & 1).tobytes()


def possible(n: np.ndarray, m: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Whether sets of n and m shingles, ``apart`` of which at least lie in one only, can be alike.

    With a similarity of p/q, (q - p) (n + m) >= (q + p) x, where x is the number that lie in one only.
    """
    p, q = ALIKE.numerator, ALIKE.denominator
    return (q - p) * (n + m) >= (q + p) * np.maximum(apart, abs(n - m))


def alike(one: np.ndarray, other: np.ndarray) -> bool:
    """Whether the share of common shingles among all of both is 0.8 or more."""
    small, large = sorted((one, other), key=len)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    common_ = int((large[at] == small).sum())
    return common_ * ALIKE.denominator >= ALIKE.numerator * (len(one) + len(other) - common_)


MARKS = "n long, bits binary, first array<long>"


def marks(texts: list[bytes]) -> list[pa.Array]:
    """The columns of ``MARKS`` for each text: its number of shingles, their parities, and the first ones."""
    sets = [hashed(t) for t in texts]
    first = [s[: leading(len(s))] for s in sets]
    offsets = np.r_[0, np.cumsum([len(f) for f in first])].astype(np.int32)
    flat = np.concatenate(first) if first else np.zeros(0, np.int64)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))
    return [pa.array([len(s) for s in sets], pa.int64()), pa.array([parities(s) for s in sets], pa.binary()), lists]


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def by_bucket(columns: list[str], work: Callable[..., Iterator[pa.RecordBatch]]) -> Callable:
    """Calls ``work`` with the bounds of whole buckets and their columns; rows come sorted by ``band``, which may go on in the next batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(parts).combine_chunks()
            band = table.column("band").to_numpy()
            begin = np.flatnonzero(np.r_[True, band[1:] != band[:-1]])
            yield from work(begin, np.diff(np.r_[begin, len(band)]), *(table.column(c) for c in columns))

        for batch in batches:
            if not batch.num_rows:
                continue
            band = batch.column("band").to_numpy()
            if held and band[0] != held[0].column("band")[-1].as_py():
                yield from done(held)
                held = []
            cut = int(np.flatnonzero(band == band[-1])[0])
            if cut:
                yield from done([*held, batch.slice(0, cut)])
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from done(held)

    return run


_MET = "a long, b long, band long, size long, members long"


def _met(a: np.ndarray, b: np.ndarray, *bucket) -> pa.RecordBatch:
    rest = [pa.array(np.full(len(a), x, np.int64)) for x in bucket] or [pa.nulls(len(a), pa.int64())] * 3
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), *rest], ["a", "b", "band", "size", "members"])


def _meeting(few: int, neighbours: bool) -> Callable:
    """Pairs of buckets of at most ``few`` texts; of larger ones neighbours in their order, or else each text with the bucket, its size and a hash of its members.

    Texts of one root need not meet, and a bucket of one root is left.
    """

    def work(begin: np.ndarray, size: np.ndarray, band, key, n, root) -> Iterator[pa.RecordBatch]:
        band, key, n, root = band.to_numpy(), key.to_numpy(), n.to_numpy(), root.to_numpy()
        for k in np.unique(size[(size > 1) & (size <= few)]).tolist():  # all buckets of one size at once
            starts = begin[size == k]
            i, j = np.triu_indices(k, 1)
            step = max(1, PAIRS_AT_ONCE // len(i))
            for part in np.split(starts, range(step, len(starts), step)):
                left, right = (part[:, None] + i).ravel(), (part[:, None] + j).ravel()
                close = possible(n[left], n[right], np.zeros(1, np.int64)) & (root[left] != root[right])
                yield _met(key[left[close]], key[right[close]])
        for at in np.flatnonzero(size > few):
            some = slice(begin[at], begin[at] + size[at])
            if neighbours:
                yield _met(key[some][:-1], key[some][1:])
            elif (root[some] != root[begin[at]]).any():
                members = np.bitwise_xor.reduce(_mixed(key[some].view(np.uint64))).view(np.int64)
                yield _met(key[some], key[some], band[begin[at]], size[at], members)

    return by_bucket(["band", "key", "n", "root"], work)


def meeting(buckets: DataFrame, few: int, neighbours: bool) -> DataFrame:
    """a and b (a < b) of texts (key, n, root) of different roots that share a bucket (band) and may be alike by size; pairs may repeat.

    Of buckets with more than ``few`` texts come neighbours in an order of hashes, or else each text (a and b) with band, size and a hash of the members.
    """
    dealt = buckets.repartition("band").sortWithinPartitions("band", F.xxhash64("band", "key"))
    return dealt.select("band", "key", "n", "root").mapInArrow(_meeting(few, neighbours), _MET)


def _words(bits: list[bytes]) -> np.ndarray:
    """A row of words for each text; all have the same number of cells."""
    return np.frombuffer(b"".join(bits), np.uint64).reshape(len(bits), -1)


def _halved(words: np.ndarray) -> np.ndarray:
    half = words.shape[1] // 2
    return words[:, :half] ^ words[:, half:]


def _apart(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.bitwise_count(one ^ other).sum(axis=1, dtype=np.int64)


def apart(one: list[bytes], other: list[bytes]) -> np.ndarray:
    """For each pair of parities by how many shingles the texts differ at least."""
    size = np.array([(len(x), len(y)) for x, y in zip(one, other)]).reshape(-1, 2)
    out = np.zeros(len(one), np.int64)
    for a, b in np.unique(size, axis=0).tolist():
        which = np.flatnonzero((size[:, 0] == a) & (size[:, 1] == b))
        left, right = (_words([side[i] for i in which]) for side in (one, other))
        while left.shape[1] > right.shape[1]:
            left = _halved(left)
        while right.shape[1] > left.shape[1]:
            right = _halved(right)
        out[which] = _apart(left, right)
    return out


_SCREENED = "a long, b long, apart long"


def screened(pairs: DataFrame, marked: DataFrame) -> DataFrame:
    """The pairs, once each, that sizes and parities (key, n, bits) allow, and by how many shingles they differ at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "bits_a"):
                far = apart(*(part.column(c).to_pylist() for c in ("bits_a", "bits_b")))
                close = possible(part.column("n_a").to_numpy(), part.column("n_b").to_numpy(), far)
                kept = part.select(["a", "b"]).append_column("apart", pa.array(far))
                yield kept.filter(pa.array(close))

    joined = pairs.where("a < b").distinct()
    for side in ("a", "b"):
        known = marked.select(F.col("key").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}"))
        joined = joined.join(known, side)
    return joined.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, _SCREENED)


def nearest(pairs: DataFrame) -> DataFrame:
    """For each text that is the larger key of a pair the pair that differs least: as many pairs as texts at most, enough to join a group."""
    best = pairs.groupBy("b").agg(F.min(F.struct("apart", "a")).alias("best"))
    return best.select(F.col("best.a").alias("a"), "b")


def _unseen(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Keys and texts of a task, slice by slice, each key once."""
    seen: set[int] = set()
    for batch in batches:
        new = [k not in seen and not seen.add(k) for k in batch.column("key").to_pylist()]
        for part in common.slices(batch.filter(pa.array(new, pa.bool_())), "text"):
            yield part.column("key").to_pylist(), common.raw_texts(part)


def sets(texts: DataFrame) -> DataFrame:
    """key and the sorted shingles (longs in binary) of texts (key and text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, found in _unseen(batches):
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([hashed(t).tobytes() for t in found], pa.binary())], ["key", "shingles"])

    return texts.select("key", "text").mapInArrow(run, "key long, shingles binary")


def texts_of(docs: DataFrame, keys: DataFrame, distinct: DataFrame) -> DataFrame:
    """key and text of the stored ``keys``, from the rows of ``docs`` (doc_id, key, text) that ``distinct`` (key, least) names for them.

    A key comes more than once only if its row is repeated; texts stay where they are read.
    """
    named = distinct.select("key", "least").join(F.broadcast(keys) if (few := keys.count() <= 1 << 18) else keys, "key")
    named = named.select(F.col("key").alias("of"), "least")
    same = (F.col("key") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("least"))
    return docs.join(F.broadcast(named) if few else named, same, "left_semi").select("key", "text")


def verified(pairs: DataFrame, docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are alike. Texts are read for the keys of the pairs alone; see ``texts_of``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "shingles_a", SET_BYTES):
                one, other = ([np.frombuffer(x, np.int64) for x in part.column(c).to_pylist()] for c in ("shingles_a", "shingles_b"))
                yield part.select(["a", "b"]).filter(pa.array([alike(x, y) for x, y in zip(one, other)], pa.bool_()))

    pairs = materialise(pairs.select("a", "b").distinct(), "pairs")
    wanted = materialise(pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key"))).distinct(), "wanted")
    found = materialise(sets(texts_of(docs, wanted, distinct)), "sets")
    if found.count() > wanted.count():
        found = materialise(found.groupBy("key").agg(F.any_value("shingles").alias("shingles")), "sets")
    for side in ("a", "b"):
        pairs = pairs.join(found.select(F.col("key").alias(side), F.col("shingles").alias(f"shingles_{side}")), side)
    return pairs.select("a", "b", "shingles_a", "shingles_b").mapInArrow(run, "a long, b long")


def _crowded_pairs(spanning: bool) -> Callable:
    """Pairs of texts of different roots of a bucket that sizes and parities allow; if ``spanning``, of each text only the one that differs least."""

    def work(begin: np.ndarray, size: np.ndarray, key, n, bits, root) -> Iterator[pa.RecordBatch]:
        key, n, bits, root = key.to_numpy(), n.to_numpy(), bits.to_pylist(), root.to_numpy()
        for at, k in zip(begin.tolist(), size.tolist()):  # a bucket's texts come by size, so that cells never get fewer
            own, cells, of = n[at : at + k], np.array([len(x) for x in bits[at : at + k]]), root[at : at + k]
            names, number, members = np.unique(of, return_inverse=True, return_counts=True)
            if len(names) == 1:
                continue
            most = of == names[members.argmax()]  # texts of the commonest root meet the others alone
            others = np.flatnonzero(~most)
            # none beyond this place is small enough for the text at hand
            upto = np.searchsorted(own, own * ALIKE.denominator // ALIKE.numerator, "right")
            starts = np.r_[np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]]), k].tolist()
            a, b, far = [], [], []
            words = [_words(bits[at + s : at + e]) for s, e in zip(starts, starts[1:])]
            for g, (s, e) in enumerate(zip(starts, starts[1:])):
                # texts that are not too large have the same number of cells or twice as many
                sides = [(s, e, words[g])]
                if g + 1 < len(words) and words[g + 1].shape[1] == 2 * words[g].shape[1]:
                    sides.append((e, starts[g + 2], _halved(words[g + 1])))
                for i in range(s, e):
                    for low, high, other in sides:
                        first, end_ = max(i + 1, low), min(high, int(upto[i]))
                        met = others[slice(*np.searchsorted(others, [first, end_]))] if most[i] else np.arange(first, end_)
                        for start in range(0, len(met), PAIRS_AT_ONCE):
                            some = met[start : start + PAIRS_AT_ONCE]
                            found = _apart(words[g][i - s], other[some - low])
                            close = np.flatnonzero(possible(own[i], own[some], found) & (of[some] != of[i]))
                            if spanning and len(close):
                                close = close[[found[close].argmin()]]
                            if len(close):
                                a.append(np.full(len(close), key[at + i]))
                                b.append(key[at + some[close]])
                                far.append(found[close])
            if a:
                yield _pairs(np.concatenate(a), np.concatenate(b)).append_column("apart", pa.array(np.concatenate(far)))

    return by_bucket(["key", "n", "bits", "root"], work)


def crowded_pairs(crowded: DataFrame, marked: DataFrame, spanning: bool = False) -> DataFrame:
    """a, b and apart of the pairs of different roots in crowded buckets (band, key) that sizes and parities (key, n, bits, root) allow."""
    dealt = crowded.select("band", "key").join(marked.select("key", "n", "bits", "root"), "key").repartition("band").sortWithinPartitions("band", "n", "key")
    return dealt.mapInArrow(_crowded_pairs(spanning), _SCREENED)


def once(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a", "b").agg(F.min("apart").alias("apart"))


def reordered(texts: DataFrame, last: DataFrame) -> DataFrame:
    """Buckets (band, key, n) of texts (key, text) in an order in which the shingles of ``last`` (band, size) come last, those of the largest at the end."""
    last = last.orderBy("band").toArrow()
    known = last.column("band").to_numpy().astype(np.int64)
    level = np.ceil(np.log2(last.column("size").to_numpy())).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts_ in _unseen(batches):
            found = []
            for text in texts_:
                own = hashed(text)
                at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                order = np.argsort(np.where(known[at] == own, level[at], 0), kind="stable")
                found.append((own[order[: leading(len(own))]], len(own)))
            many = [len(f) for f, _ in found]
            columns = [np.concatenate([f for f, _ in found]), np.repeat(keys, many), np.repeat([n for _, n in found], many)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], ["band", "key", "n"])

    return texts.select("key", "text").mapInArrow(run, "band long, key long, n long")


def met(buckets: DataFrame, marked: DataFrame, docs: DataFrame, crowd: int = CROWD, large: int = LARGE, orders: int = ORDERS) -> tuple[DataFrame, DataFrame]:
    """The pairs (a, b, apart) of different roots in buckets that are not crowded, and the crowded buckets (band, key; stored).

    Among these and the pairs of the crowded buckets are all texts of ``marked`` (key, least, n, bits, root) that are alike and of different roots.
    ``buckets`` has band, key, n and root of their first shingles; ``docs`` the texts (see ``texts_of``).
    """
    found, crowds, last = [], [], None
    for turn in range(orders + 1):
        met = materialise(meeting(buckets, crowd, neighbours=False), "met")
        found.append(screened(met.where("size IS NULL"), marked))
        # the shingles of a passage fill buckets with the same texts; one of such buckets is enough
        buckets_ = met.where("size IS NOT NULL").groupBy("band", "size", "members").agg(F.lit(1).alias("one"))
        kept = materialise(buckets_.groupBy("size", "members").agg(F.min("band").alias("band")).select("band"), "kept")
        crowded = common.narrowed(met.where("size IS NOT NULL").select("band", F.col("a").alias("key"), "size"), kept, "band")
        new = buckets_.where(F.col("size") > large).select("band", "size")
        new = materialise(new if last is None else new.join(last.select("band"), "band", "left_anti"), "large")
        again = turn < orders and not new.isEmpty()
        near = crowded.where(F.col("size") <= large) if again else crowded
        # in each order a bucket is one of its own
        crowds.append(near.select(F.xxhash64(F.lit(turn), "band").alias("band"), "key"))
        if not again:
            break
        last = materialise(common.largest(new if last is None else last.unionByName(new), F.col("size"), COMMON), "last")
        keys = materialise(crowded.where(F.col("size") > large).select("key").distinct(), "crowded")
        buckets = reordered(texts_of(docs, keys, marked), last).join(marked.select("key", "root"), "key")
    return reduce(DataFrame.unionByName, found), materialise(reduce(DataFrame.unionByName, crowds), "crowds")


def joined(buckets: DataFrame, marked: DataFrame, docs: DataFrame, crowd: int = CROWD, large: int = LARGE, orders: int = ORDERS) -> DataFrame:
    """a, b and apart: all pairs of ``marked`` texts (key, least, n, bits) that sizes and parities allow, among them all that are alike.

    ``buckets`` has band, key and n of their first shingles; ``docs`` the texts (see ``texts_of``). Pairs come once.
    """
    buckets, marked = (df if "root" in df.columns else df.withColumn("root", F.col("key")) for df in (buckets, marked))
    pairs, crowds = met(buckets, marked, docs, crowd, large, orders)
    return once(pairs.unionByName(crowded_pairs(crowds, marked)))
