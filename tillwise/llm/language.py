"""Scores of texts by a hashed maximum-entropy language model.

A word's probability is proportional to that of a class model times the exponentials of the weights of two sparse features that hold: the pair of the
previous word and it (n-gram), and the pair of the one before that and it (skip). Every pair of words that follow each other so in the corpus is a
feature, so there are more of them the larger the corpus is; they are told apart by hashes of the words themselves.

The class model says the probability of a word's class, given hashed buckets of the previous word, of the one before it, and of both together, times
that of the word within its class. The most frequent words have classes of their own, divided by their share of all tokens, with a second softmax over
the class's words given the previous word's bucket; all other words fall into classes by their hash, where corpus counts decide. Its tokens are counted
once into a table of contexts and classes, over the whole corpus; as the loss is a sum over that table, each gradient is computed from its blocks in
parallel and is exactly the gradient over all tokens.

The weights of a sparse feature have a closed form: where a word with count c stands before, and the feature was seen n times in the corpus, the
weight is log(1 + n / (m q)), with m = ``MASS`` c ^ ``POWER`` and q the probability without it, and all weights together are normed by (c + m) / m: each
context sees as many features as its word has tokens. The model then expects the feature c (n + m q) / (c + m) times. Skip features come first.

Texts are packed into slices. Each slice sends the hashes of its features once, cut by ranges, and the sums over the corpus come back to it,
so no task holds the features of a word, however frequent, and none is left out. Rare words get their corpus counts the same way.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm import common
from tillwise.session import materialise

#: Buckets of the previous word, of the one before it, and of both together.
PREVIOUS, SKIPPED, BOTH = 256, 32, 2048
#: Words with a class softmax of their own, their classes, the classes of all other words, and words kept with their counts.
WORDS, CLASSES, OTHERS, HEAD = 1024, 32, 8, 1 << 17
#: Gradient rounds; weight of the ridge.
ROUNDS, RIDGE = 10, 1.0
#: Blocks of the context table that are one task's work in a round.
WORD_BLOCKS = 8
#: Distinct words whose codes a task keeps.
KEPT = 200_000
#: Mass that a context with one token leaves to what is expected without its features, and the power by which it grows with the tokens.
MASS, POWER = 4.0, 0.8
#: Bits of a feature's hash; bytes of text of a slice, and of all texts for each range of hashes.
KEY_BITS, SLICE_BYTES, RANGE_BYTES = 46, 4 << 20, 6 << 20

K = CLASSES + OTHERS
END = xxhash.xxh64_intdigest(b" ") >> 1  # no word holds a space
BEGIN = xxhash.xxh64_intdigest(b"  ") >> 1  # two words before the first


def word_hash(word: bytes) -> int:
    """63 bits for a word; words are told apart by it."""
    return xxhash.xxh64_intdigest(word) >> 1


class Codes(dict):
    """Word to code, made when first asked for."""

    def __init__(self, code: Callable[[int], int]):
        self.code = code

    def __missing__(self, word: bytes) -> int:
        if len(self) > KEPT:
            self.clear()
        self[word] = value = self.code(word_hash(word))
        return value


def coded(texts: list[bytes], codes: Codes) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the tokens of all texts in a row, each text followed by the end, and the number of tokens of each."""
    row, sizes = [], []
    for text in texts:
        words = text.lower().split()  # of bytes: A-Z alone, and ASCII white space alone
        row += [codes[w] for w in words]
        row.append(codes[b" "])
        sizes.append(len(words) + 1)
    return np.array(row, dtype=np.int64), np.array(sizes, dtype=np.int64)


@dataclass
class Head:
    """The most frequent words: hashes, counts, classes (equal shares of the tokens) of the first ``words``."""

    hashes: np.ndarray
    counts: np.ndarray
    tokens: int
    distinct: int
    words: int
    place: dict[int, int] = field(default_factory=dict)

    def __post_init__(self):
        self.place = {h: i for i, h in enumerate(self.hashes.tolist())}
        top = self.counts[: self.words].astype(float)
        middle = (np.cumsum(top) - top / 2) / max(top.sum(), 1)
        self.classes = np.minimum((middle * CLASSES).astype(np.int64), CLASSES - 1)

    def __getstate__(self):
        return {"hashes": self.hashes, "counts": self.counts, "tokens": self.tokens, "distinct": self.distinct, "words": self.words}

    def __setstate__(self, state):
        self.__init__(**state)

    def code(self, h: int) -> int:
        """Below zero for a frequent word (-1 - its place), else the hash."""
        i = self.place.get(h)
        return h if i is None else -1 - i

    def resolve(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Place (-1: not in the head), hash, class, and the buckets of the contexts of each token."""
        place = np.where(codes < 0, -1 - codes, -1)
        hashes = np.where(codes < 0, self.hashes[place] if len(self.hashes) else 0, codes)
        own = (place >= 0) & (place < self.words)
        kind = np.where(own, self.classes[np.where(own, place, 0)] if len(self.classes) else 0, CLASSES + hashes % OTHERS)
        begin = np.cumsum(sizes) - sizes
        before = np.r_[np.int64(END), hashes[:-1]]
        before[begin] = END
        skipped = np.r_[np.int64(END), before[:-1]]
        skipped[begin] = END
        return place, hashes, kind, bucket(before, 1, PREVIOUS), bucket(skipped, 2, SKIPPED)


def bucket(hashes: np.ndarray, salt: int, n: int) -> np.ndarray:
    mixed = (hashes.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(40)) % np.uint64(n)).astype(np.int64)


@cache
def both_bucket() -> np.ndarray:
    """Of every (skipped, previous) pair of buckets, the bucket of the pair."""
    pair = np.arange(SKIPPED * PREVIOUS, dtype=np.int64)
    return bucket(pair, 3, BOTH).reshape(SKIPPED, PREVIOUS)


def word_counts(texts: DataFrame) -> DataFrame:
    """h and c: the hash of every distinct token and how often it stands in ``texts``; counted in tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(lambda h: h)
        held, size = [], 0

        def out():
            h, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h), pa.array(c.astype(np.int64))], names=["h", "c"])

        for batch in batches:
            for part in common.slices(batch, "text"):
                held.append(coded(common.raw_texts(part), codes)[0])
                size += len(held[-1])
                if size > 2_000_000:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return texts.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def packed(texts: DataFrame) -> DataFrame:
    """doc_id, held_out and text in stored slices: their number, how many bytes of text they hold, and their rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def out():
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                for part in held:
                    stream.write_batch(part)
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([size]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["slice", "size", "data"])

        for batch in batches:
            for part in common.slices(batch, "text", SLICE_BYTES):
                more = pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
                if held and size + more > SLICE_BYTES:
                    yield out()
                    number, held, size = number + 1, [], 0
                held.append(part)
                size += more
        if held:
            yield out()

    return materialise(texts.select("doc_id", "held_out", "text").mapInArrow(run, "slice long, size long, data binary"), "slices")


def _unpacked(data: bytes) -> tuple[pa.Table, list[bytes]]:
    """The rows of a slice, and their texts."""
    rows = pa.ipc.open_stream(data).read_all().combine_chunks()
    return rows, [x or b"" for x in rows.column("text").cast(pa.binary()).to_pylist()]


def feature(word: np.ndarray, before: np.ndarray | int, salt: int) -> np.ndarray:
    """Hashes of pairs of words (by their hashes), of a kind told by ``salt``."""
    x = word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.asarray(before).astype(np.uint64) + np.uint64(salt << 60)
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(64 - KEY_BITS)


def features(place: np.ndarray, hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The features of all tokens with the previous word, then with the one before, of the ends of the texts, and of words out of the head.

    The word before an end is met by a second end, so that every context sees as many features as its word has tokens.
    """
    end = np.cumsum(sizes) - 1
    begin = end + 1 - sizes
    before = np.r_[np.int64(END), hashes[:-1]]
    before[begin] = END
    skipped = np.r_[np.int64(END), before[:-1]]
    skipped[begin] = BEGIN
    pairs = [feature(hashes, before, 1), feature(hashes, skipped, 2), feature(hashes[end], before[end], 2)]
    return np.concatenate([*pairs, feature(hashes[place < 0], 0, 3)])


def _shut(x: np.ndarray) -> bytes:
    """Whole numbers, byte by byte, so that equal bytes stand together."""
    return pa.compress(np.ascontiguousarray(x.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True)


def _opened(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 8 * n, "zstd"), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel()


SCORES = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
TABLE = "kind int, block int, slice long, n long, counts binary, extra binary"
TABLE_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
TABLE_NAMES = ["kind", "block", "slice", "n", "counts", "extra"]


def _each(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    """Rows with blocks in them, few of which are copied at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, 32):
            part = batch.slice(start, 32)
            yield from zip(*(part.column(c).to_pylist() for c in columns))


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), TABLE_TYPES)], names=TABLE_NAMES)


def context_table(slices: DataFrame, head: Head) -> DataFrame:
    """Blocks of two count tables over all tokens that are learnt from: kind 0, (skipped) previous by class; kind 1, previous by frequent word.

    And of kind 2, for each slice and range of hashes, how often each of the slice's features in that range occurs in all that is learnt from;
    the features are those of learnt and held out texts alike, in the order of their hashes.
    """
    words = len(head.classes)
    ranges = max(1, math.ceil((slices.agg(F.sum("size")).first()[0] or 0) / RANGE_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(head.code)
        by_class, by_word = np.zeros(SKIPPED * PREVIOUS * K, np.int64), np.zeros(PREVIOUS * words, np.int64)
        for batch in batches:
            for number, data in zip(batch.column("slice").to_pylist(), batch.column("data")):
                rows, texts = _unpacked(data.as_py())
                tokens, sizes = coded(texts, codes)
                learnt = ~rows.column("held_out").to_numpy()
                place, hashes, kind, previous, skipped = head.resolve(tokens, sizes)
                mine = np.repeat(learnt, sizes)
                by_class += np.bincount((skipped * PREVIOUS + previous)[mine] * K + kind[mine], minlength=len(by_class))
                own = mine & (place >= 0) & (place < words)
                if words:
                    by_word += np.bincount(previous[own] * words + place[own], minlength=len(by_word))
                # the lowest bit tells what is learnt from, so that one sort of numbers does
                flags = np.concatenate([mine, mine, learnt, mine[place < 0]])
                every = np.sort(features(place, hashes, sizes) << np.uint64(1) | flags.astype(np.uint64))
                keys = every >> np.uint64(1)
                first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                keys, seen = keys[first], np.add.reduceat((every & np.uint64(1)).astype(np.int64), first)
                cuts = np.searchsorted(keys, (np.arange(ranges + 1, dtype=object) * (1 << KEY_BITS) // ranges).astype(np.uint64))
                for i, (low, high) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                    if low < high:
                        gaps = np.diff(keys[low:high], prepend=np.uint64(0))
                        yield _rows([(2, i, number, high - low, _shut(gaps), _shut(seen[low:high]))])
        blocks = [(0, i, x) for i, x in enumerate(by_class.reshape(SKIPPED, -1))]
        blocks += [(1, i, x) for i, x in enumerate(by_word.reshape(WORD_BLOCKS, -1))] if words else []
        yield _rows([(kind, i, None, len(x), x.tobytes(), None) for kind, i, x in blocks])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def out():
            kind, block = at
            if kind < 2:
                return _rows([(kind, block, None, held[0][3], sum(np.frombuffer(r[4], np.int64) for r in held).tobytes(), None)])
            keys = np.concatenate([np.cumsum(_opened(r[4], r[3])) for r in held])
            seen = np.concatenate([_opened(r[5], r[3]) for r in held])
            _, which = np.unique(keys, return_inverse=True)
            total = np.bincount(which, seen)[which]
            ends = np.cumsum([r[3] for r in held])
            return _rows([(kind, block, r[2], r[3], _shut(x), None) for r, x in zip(held, np.split(total, ends[:-1]))])

        for row in _each(batches, TABLE_NAMES):
            if row[:2] != at and held:
                yield out()
                held = []
            at = row[:2]
            held.append(row)
        if held:
            yield out()

    made = slices.select("slice", "data").mapInArrow(run, TABLE)
    return made.repartition("kind", "block").sortWithinPartitions("kind", "block").mapInArrow(add, TABLE)


def _blocks(rows) -> pa.RecordBatch:
    columns = [[r[0] for r in rows], [r[1] for r in rows], [r[2].tobytes() for r in rows]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary()))], names=["kind", "block", "counts"])


def _unpack(batch: pa.RecordBatch, dtype=np.int64):
    for kind, block, counts in zip(*(batch.column(i).to_pylist() for i in range(3))):
        yield (kind, block), np.frombuffer(counts, dtype)


@dataclass
class Weights:
    """Of the class softmax: bias and three feature tables; of the words within a class: bias and the previous word."""

    bias: np.ndarray
    previous: np.ndarray
    skipped: np.ndarray
    both: np.ndarray
    word: np.ndarray
    word_previous: np.ndarray

    def class_log(self, block: int) -> np.ndarray:
        """Log probabilities of the classes for each previous bucket, at one skipped bucket."""
        z = self.bias + self.previous + self.skipped[block] + self.both[both_bucket()[block]]
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def word_log(self, rows: slice, begins: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Log probabilities of the frequent words within their classes, for some previous buckets."""
        z = self.word + self.word_previous[rows]
        z = z - np.maximum.reduceat(z, begins, axis=1)[:, classes]
        return z - np.log(np.add.reduceat(np.exp(z), begins, axis=1))[:, classes]


@dataclass
class Model:
    head: Head
    class_log10: np.ndarray
    word_log10: np.ndarray
    other_tokens: np.ndarray
    other_distinct: np.ndarray
    #: The rows of kind 2 of the table of contexts.
    sums: DataFrame


def _class_steps(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each class begins among the words in order of frequency, and for each word the number of its class among those."""
    steps = np.r_[True, classes[1:] != classes[:-1]] if len(classes) else np.zeros(0, bool)
    return np.flatnonzero(steps), np.cumsum(steps) - 1


def fit(texts: DataFrame, counts: DataFrame, rounds: int = ROUNDS, slices: DataFrame | None = None) -> Model:
    """Train on all of ``texts``; ``counts`` are their word counts. Of the corpus, the driver sees the head and the blocks.

    With ``slices`` (of ``packed``), on what is not held out in them, and their features are counted, held out or not.
    """
    tokens, distinct = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    top = common.largest(counts, F.col("c"), HEAD).toPandas().sort_values(["c", "h"], ascending=[False, True])
    head = Head(top["h"].to_numpy(np.int64), top["c"].to_numpy(np.int64), int(tokens or 0), int(distinct), WORDS)
    other_tokens, other_distinct = np.zeros(OTHERS, np.int64), np.zeros(OTHERS, np.int64)
    for row in counts.groupBy((F.col("h") % OTHERS).alias("k")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        other_tokens[row["k"]], other_distinct[row["k"]] = row["c"], row["n"]
    words = len(head.classes)
    np.subtract.at(other_tokens, head.hashes[:words] % OTHERS, head.counts[:words])
    np.subtract.at(other_distinct, head.hashes[:words] % OTHERS, 1)

    if slices is None:
        slices = packed(common.documents(texts).withColumn("held_out", F.lit(False)))
    contexts = materialise(context_table(slices, head), "contexts")
    table = contexts.where("kind < 2").select("kind", "block", "counts")
    begins, numbers = _class_steps(head.classes)
    weights = Weights(np.zeros(K), np.zeros((PREVIOUS, K)), np.zeros((SKIPPED, K)), np.zeros((BOTH, K)), np.zeros(words), np.zeros((PREVIOUS, words)))

    def tables(rows, dtype):
        by_class, by_word = np.zeros((SKIPPED, PREVIOUS, K)), np.zeros((PREVIOUS, words))
        for batch in rows.to_batches():
            for (kind, block), x in _unpack(batch, dtype):
                if kind == 0:
                    by_class[block] = x.reshape(PREVIOUS, K)
                else:
                    by_word.reshape(WORD_BLOCKS, -1)[block] = x
        return by_class, by_word

    def marginals(by_class, by_word):
        both = np.zeros((BOTH, K))
        np.add.at(both, both_bucket().ravel(), by_class.reshape(-1, K))
        return by_class.sum(axis=(0, 1)), by_class.sum(axis=0), by_class.sum(axis=1), both, by_word.sum(axis=0), by_word

    seen = marginals(*tables(table.toArrow(), np.int64))
    if head.tokens:  # begin with the plain shares
        weights.bias = np.log((seen[0] + 1) / (seen[0] + 1).sum())
        weights.word = np.log(seen[4] + 1)

    for _ in range(rounds if head.tokens else 0):

        def expected(batches: Iterator[pa.RecordBatch], weights=weights) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for (kind, block), x in _unpack(batch):
                    if kind == 0:
                        n = x.reshape(PREVIOUS, K)
                        out.append((0, block, np.exp(weights.class_log(block)) * n.sum(axis=1, keepdims=True)))
                    else:
                        n = x.reshape(-1, words)
                        rows = slice(block * len(n), (block + 1) * len(n))
                        total = np.add.reduceat(n, begins, axis=1)[:, numbers]
                        out.append((1, block, np.exp(weights.word_log(rows, begins, numbers)) * total))
                yield _blocks(out)

        means = marginals(*tables(table.mapInArrow(expected, "kind int, block int, counts binary").toArrow(), np.float64))
        for name, active, n, e in zip(("bias", "previous", "skipped", "both", "word", "word_previous"), (4, 4, 4, 4, 2, 2), seen, means):
            old = getattr(weights, name)
            # the gradient of the regularised likelihood, scaled for each weight by what it can move
            step = (n - e - RIDGE * old) / (np.maximum(n, e) + RIDGE)
            setattr(weights, name, old + np.clip(step, -2, 2) / active)

    scale = 1 / math.log(10)
    class_log = np.stack([weights.class_log(b) for b in range(SKIPPED)]) * scale
    word_log = weights.word_log(slice(None), begins, numbers) * scale if words else np.zeros((PREVIOUS, 0))
    return Model(head, class_log, word_log, other_tokens, other_distinct, contexts.where("kind = 2"))


def score(docs: DataFrame, split: int = 7, held: int = 2) -> DataFrame:
    """Base and model scores of every row, learnt from the rows whose crc32(doc_id as text) mod ``split`` is not ``held``.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score. Null and empty texts hold the end alone.
    Repeated rows are repeated texts, in training too. With nothing to learn from every token is unknown, and all classes
    are as likely. A slice is scored where the sums of its features over the corpus meet it.
    """
    texts = common.documents(docs).withColumn("held_out", common.remainder("doc_id", split) == held)
    training = texts.where(~F.col("held_out"))
    counts = materialise(word_counts(training), "counts")
    slices = packed(texts)
    model = fit(training, counts, slices=slices)
    head, class_log10, word_log10 = model.head, model.class_log10, model.word_log10
    base_rest = math.log10(head.tokens + head.distinct + 1)
    class_rest = np.log10(model.other_tokens + model.other_distinct + 1)
    words = len(head.classes)

    def scored(data: bytes, total: np.ndarray, codes: Codes) -> pa.RecordBatch:
        rows, texts = _unpacked(data)
        tokens, sizes = coded(texts, codes)
        place, hashes, kind, previous, skipped = head.resolve(tokens, sizes)
        begin = np.cumsum(sizes) - sizes
        rare, own = place < 0, (place >= 0) & (place < words)
        every, which = np.unique(features(place, hashes, sizes), return_inverse=True)
        assert len(every) == len(total), "the sums are of other features"
        seen = total[which]
        n = len(place)
        count = head.counts[np.where(rare, 0, place)].astype(float) if len(head.counts) else np.zeros(n)
        count[rare] = seen[2 * n + len(sizes) :]
        before = np.roll(count, 1)  # how often the word before stands in the corpus, and the end for the first
        before[begin] = count[-1]
        skip = np.roll(before, 1)
        skip[begin] = count[-1]
        gain = np.log10(count + 1)
        value = class_log10[skipped, previous, kind]
        value[own] += word_log10[previous[own], place[own]]
        value[~own] += gain[~own] - class_rest[hashes[~own] % OTHERS]
        value = 10**value
        for known, context in ((seen[n : 2 * n], skip), (seen[:n], before)):
            mass = MASS * np.maximum(context, 1) ** POWER
            value = (known + mass * value) / (context + mass)
        columns = [
            rows.column("doc_id").combine_chunks(),
            rows.column("held_out").combine_chunks(),
            pa.array(sizes),
            pa.array(np.add.reduceat((count > 0).astype(np.int64), begin)),
            pa.array(np.full(len(sizes), head.tokens)),
            pa.array(np.add.reduceat(gain, begin) - sizes * base_rest),
            pa.array(np.add.reduceat(np.log10(value), begin)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=SCORES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, at, data, held = Codes(head.code), None, None, []
        for number, n, found in _each(batches, ["slice", "n", "counts"]):
            if number != at:
                if at is not None:
                    yield scored(data, np.concatenate(held), codes)
                at, data, held = number, found, []
            else:
                held.append(_opened(found, n).astype(float))
        if at is not None:
            yield scored(data, np.concatenate(held), codes)

    # a slice comes before its sums, and these in the order of their ranges
    both = slices.select("slice", F.lit(-1).alias("block"), "size", "data").toDF("slice", "block", "n", "counts")
    both = both.union(model.sums.select("slice", "block", "n", "counts"))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return both.repartition("slice").sortWithinPartitions("slice", "block").mapInArrow(run, schema)
