"""Ranked lexical search through hashed max-sketches.

A term's impact on a document is what it adds to a score apart from its weight: ``1e9 tf / (1000 tf + 12 m)``, where m follows
from the document's length. An index row folds the impacts of all terms of a document into the maxima of hashed slots, a byte
each, rounded up; the number of slots follows the number of distinct terms. A term's weight depends on the corpus alone, so it
multiplies what a query reads from its slot, and the sum over a query's terms is an upper bound of the document's score.

A batch of queries is searched in three passes over the index: the best bounds of all documents give k seeds a query, the
exact scores of the seeds give a threshold, and then every task scores its documents exactly by descending bound until
the bound falls below what the query has already. No document whose score could matter is left out.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm import common
from tillwise.operators.ranking import top_per_group
from tillwise.session import materialise

#: Slots for each distinct term of a document, at least, and for a document.
SLOTS, LEAST = 8, 64
#: The largest impact, and the steps in which slots keep it.
TOP, STEPS = 1_000_000, 255
#: Queries, and distinct terms, that are looked up together.
QUERIES, TERMS = 256, 1 << 14

_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)  # A-Z lowered; what no term holds is a space


def terms_of(text: bytes) -> list[bytes]:
    """All terms of a text: runs of ASCII letters and digits and of all else beyond ASCII; only A-Z is lowered."""
    return text.translate(_LETTERS).split()


def saturation(n: int, documents: int, terms: int) -> int:
    """m of a document of n terms."""
    return 75 + 25 * n * documents // terms


def impact(tf: int, m: int) -> int:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def sketches(texts: list[bytes], documents: int, terms: int) -> pa.BinaryArray:
    """The sketch of each text; empty for a text without terms."""
    bags = [Counter(terms_of(t)) for t in texts]
    size = np.array([len(b) for b in bags])
    slots = np.array([max(LEAST, 1 << (SLOTS * n - 1).bit_length()) if n else 0 for n in size.tolist()], np.int64)
    ends = np.cumsum(slots)
    hashes = np.array([xxhash.xxh64_intdigest(t) for bag in bags for t in bag], np.uint64)
    tf = np.array([n for bag in bags for n in bag.values()], np.int64)
    m = np.array([saturation(sum(bag.values()), documents, terms) for bag in bags], np.int64)
    found = 1_000_000_000 * tf // (1000 * tf + 12 * np.repeat(m, size))
    steps = -(-found * STEPS // TOP)
    mask, start = np.repeat(slots - 1, size).astype(np.uint64), np.repeat(ends - slots, size)
    flat = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    np.maximum.at(flat, start + (hashes & mask).astype(np.int64), steps.astype(np.uint8))
    offsets = np.r_[0, ends].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


@dataclass(frozen=True)
class Index:
    """Rows ``at`` (a number of its own), ``doc_id``, ``text`` and ``sketch`` of the documents with terms; their number and that of their terms."""

    rows: DataFrame
    documents: int
    terms: int


def index(docs: DataFrame) -> Index:
    """The index of all documents with at least one term, written to the shared folder. Null texts have none."""
    docs = common.documents(docs)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents, terms = 0, 0
        for batch in batches:
            for part in common.slices(batch, "text"):
                for text in common.raw_texts(part):
                    n = len(terms_of(text))
                    documents, terms = documents + (n > 0), terms + n
        yield pa.RecordBatch.from_pydict({"documents": [documents], "terms": [terms]})

    sums = docs.select("text").mapInArrow(measured, "documents long, terms long").agg(F.sum("documents"), F.sum("terms")).first()
    documents, terms = (int(x or 0) for x in sums)

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in common.slices(batch, "text"):
                made = sketches(common.raw_texts(part), documents, terms)
                numbers = pa.array(np.arange(at, at + part.num_rows), pa.int64())
                at += part.num_rows
                rows = pa.RecordBatch.from_arrays([numbers, part.column("doc_id"), part.column("text"), made], names=["at", "doc_id", "text", "sketch"])
                yield rows.filter(pa.compute.greater(pa.compute.binary_length(made), 0))

    if not terms:
        return Index(docs.sparkSession.createDataFrame([], "at long, doc_id long, text string, sketch binary"), 0, 0)
    rows = docs.mapInArrow(sketched, "at long, doc_id long, text string, sketch binary")
    return Index(materialise(rows, "lexical"), documents, terms)


class Batch:
    """Some queries: their terms, once each, and how often each query has which."""

    def __init__(self, bags: list[Counter]):
        self.number: dict[bytes, int] = {}
        self.bags = [{self.number.setdefault(t, len(self.number)): n for t, n in bag.items()} for bag in bags]
        self.hashes = np.array([xxhash.xxh64_intdigest(t) for t in self.number], np.uint64)
        self.weights: list[int] = []

    def weigh(self, documents: int, df: dict[int, int]) -> None:
        self.weights = [weight(documents, df.get(i, 0)) for i in range(len(self.number))]

    def table(self) -> np.ndarray:
        """What a step in a term's slot adds to each query's bound; rows are terms."""
        out = np.zeros((len(self.number), len(self.bags)), np.float32)
        for q, bag in enumerate(self.bags):
            for i, n in bag.items():
                out[i, q] = n * self.weights[i]
        return out

    def bounds(self, sketches_: list[bytes], table: np.ndarray) -> np.ndarray:
        """Upper bounds of all scores; rows are documents. Rounding of the sums is allowed for."""
        out = np.zeros((len(sketches_), len(self.bags)), np.float32)
        size = np.array([len(s) for s in sketches_])
        for slots in np.unique(size):
            which = np.flatnonzero(size == slots)
            at = (self.hashes & np.uint64(slots - 1)).astype(np.int64)
            for part in np.split(which, range(1024, len(which), 1024)):
                steps = np.stack([np.frombuffer(sketches_[i], np.uint8)[at] for i in part])
                out[part] = steps.astype(np.float32) @ table
        return out * np.float32(TOP / STEPS * (1 + (len(self.number) + 8) * 2.0**-23))

    def score(self, q: int, tf: dict[int, int], m: int) -> int:
        """The exact score of query q for a document, given how often it holds which of the batch's terms."""
        return sum(n * self.weights[i] * impact(tf[i], m) for i, n in self.bags[q].items() if i in tf)


class Found:
    """How often each document of a slice holds the batch's terms, and its m; read from the text when first asked for."""

    def __init__(self, batch: Batch, texts: list[bytes], documents: int, terms: int):
        self.batch, self.texts, self.sums, self.known = batch, texts, (documents, terms), {}

    def score(self, row: int, q: int) -> int:
        if row not in self.known:
            words = terms_of(self.texts[row])
            bag = Counter(filter(self.batch.number.__contains__, words))
            self.known[row] = {self.batch.number[t]: n for t, n in bag.items()}, saturation(len(words), *self.sums)
        return self.batch.score(q, *self.known[row])


_FOUND = "q int, doc_id long, at long, score long"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["q", "doc_id", "at", "score"])


def _held(batch: Batch) -> Callable:
    """How many documents of a task hold which term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, known = Counter(), batch.number.keys()
        for rows in batches:
            for part in common.slices(rows, "text"):
                for text in common.raw_texts(part):
                    df.update(known & set(terms_of(text)))
        yield pa.RecordBatch.from_pydict({"term": pa.array([batch.number[t] for t in df], pa.int32()), "df": pa.array(df.values(), pa.int64())})

    return run


def _best_bounds(batch: Batch, k: int) -> Callable:
    """A task's k documents of the highest bounds for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = batch.table()
        best, at = np.zeros((0, len(batch.bags)), np.float32), np.zeros((0, len(batch.bags)), np.int64)
        for rows in batches:
            for part in common.slices(rows, "sketch"):
                bounds = batch.bounds(part.column("sketch").to_pylist(), table)
                numbers = np.broadcast_to(part.column("at").to_numpy()[:, None], bounds.shape)
                best, at = np.concatenate([best, bounds]), np.concatenate([at, numbers])
                if len(best) > k:
                    chosen = np.argpartition(-best, k - 1, axis=0)[:k]
                    best, at = np.take_along_axis(best, chosen, 0), np.take_along_axis(at, chosen, 0)
        q = np.broadcast_to(np.arange(len(batch.bags), dtype=np.int32)[None, :], best.shape)
        some = best > 0
        yield pa.RecordBatch.from_arrays([pa.array(q[some]), pa.array(at[some]), pa.array(best[some])], names=["q", "at", "bound"])

    return run


def _seeds(batch: Batch, documents: int, terms: int) -> Callable:
    """Exact scores of the rows' texts for the queries that ask for them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for part in common.slices(rows, "text"):
                found = Found(batch, common.raw_texts(part), documents, terms)
                ids, at = part.column("doc_id").to_pylist(), part.column("at").to_pylist()
                asked = part.column("asked").to_pylist()
                yield _rows([(q, ids[i], at[i], found.score(i, q)) for i in range(part.num_rows) for q in asked[i]])

    return run


def _exact(batch: Batch, documents: int, terms: int, k: int, threshold: list[int]) -> Callable:
    """A task's k best documents for each query, by exact score and doc_id; those below the threshold can't matter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = batch.table()
        least = np.maximum(np.array(threshold, np.float64), 1)
        heaps: list[list[tuple]] = [[] for _ in batch.bags]
        for rows in batches:
            for part in common.slices(rows, "sketch"):
                bounds = batch.bounds(part.column("sketch").to_pylist(), table).astype(np.float64)
                near = bounds >= least[None, :]
                if not near.any():
                    continue
                ids, at = part.column("doc_id").to_pylist(), part.column("at").to_pylist()
                found = Found(batch, common.raw_texts(part), documents, terms)
                for q in np.flatnonzero(near.any(axis=0)).tolist():
                    which = np.flatnonzero(near[:, q])
                    heap = heaps[q]
                    for i in which[np.argsort(-bounds[which, q], kind="stable")].tolist():
                        if bounds[i, q] < least[q]:
                            break  # so are all that follow
                        score = found.score(i, q)
                        if score < least[q]:
                            continue
                        # of equal scores the smaller doc_id stands higher, rows without one last
                        row = (score, ids[i] is not None, -(ids[i] or 0), -at[i], ids[i])
                        if len(heap) < k:
                            heapq.heappush(heap, row)
                        else:
                            heapq.heappushpop(heap, row)
                        if len(heap) == k:
                            least[q] = max(least[q], heap[0][0])
        yield _rows([(q, row[4], -row[3], row[0]) for q, heap in enumerate(heaps) for row in heap])

    return run


def batches_of(queries: DataFrame, item: str, text: str) -> Iterator[tuple[list, Batch]]:
    """The queries' ids and their batches, of at most ``QUERIES`` queries and about ``TERMS`` terms."""
    ids, bags, size = [], [], 0
    for row in queries.select(F.col(item).alias("item"), F.col(text).alias("text")).toLocalIterator():
        bag = Counter(terms_of((row["text"] or "").encode()))
        if ids and (len(ids) == QUERIES or size + len(bag) > TERMS):
            yield ids, Batch(bags)
            ids, bags, size = [], [], 0
        ids, bags, size = [*ids, row["item"]], [*bags, bag], size + len(bag)
    if ids:
        yield ids, Batch(bags)


def search(index: Index, queries: DataFrame, k: int = 20, item: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``k`` best documents of every query row, or of all with a score above 0.

    Equal scores stand by ascending doc_id, those without doc_id last; rows that share a doc_id are documents of their own. Null
    and empty queries, and queries of unknown terms, find nothing; repeated queries each have their results. The queries are a stated set: they pass
    the driver in batches, and each batch meets every index row; only k rows a query and task leave a task.
    """
    spark = index.rows.sparkSession
    done = []
    for ids, batch in batches_of(queries, item, text):
        if not index.terms or not batch.number:
            continue
        counted = index.rows.select("text").mapInArrow(_held(batch), "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
        batch.weigh(index.documents, {r["term"]: r["df"] for r in counted.collect()})
        best = index.rows.select("at", "sketch").mapInArrow(_best_bounds(batch, k), "q int, at long, bound float")
        seeds = top_per_group(best, ["q"], k, F.col("bound").desc(), F.col("at")).groupBy("at").agg(F.collect_list("q").alias("asked"))
        asked = index.rows.select("at", "doc_id", "text").join(F.broadcast(seeds), "at")  # k rows a query of the batch at most
        scored = asked.mapInArrow(_seeds(batch, index.documents, index.terms), _FOUND).select("q", "score").collect()
        scores: dict[int, list[int]] = {}
        for q, score in scored:
            scores.setdefault(q, []).append(score)
        threshold = [sorted(s, reverse=True)[k - 1] if len(s := scores.get(q, [])) >= k else 0 for q in range(len(ids))]
        rows = index.rows.mapInArrow(_exact(batch, index.documents, index.terms, k, threshold), _FOUND)
        order = F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("at")
        ranked = materialise(top_per_group(rows, ["q"], k, *order, name="rank"), "found")
        named = spark.createDataFrame(list(enumerate(ids)), "q int, item_id long")
        done.append(ranked.join(F.broadcast(named), "q").select("item_id", "rank", "doc_id", "score"))
    if not done:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, done)
