"""Byte-level BPE by replaying the merges over all new words of a task at once.

A text falls into pieces by the pattern. The pieces that a task hasn't met yet form a small corpus: every symbol knows
its neighbours, an index leads from the rank of each pair to the places where it stands, and merges are applied in the
order of their ranks, touching only the neighbours of what they join. Encoded pieces are kept for later texts.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import cache
from itertools import batched, chain, islice

import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tillwise.llm import common

#: Encoded pieces that a process keeps, and as many older ones.
KEPT = 300_000


@cache
def ranks_of(path: str) -> dict[bytes, int]:
    """Token bytes and their rank, from a file with base64 and a number in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


@cache
def merges_of(path: str) -> dict[int, int]:
    """The rank of what two tokens make, by both ranks (the first times 2**32): every way to cut each token into two."""
    ranks = ranks_of(path)
    cuts = ((token[:i], token[i:], rank) for token, rank in ranks.items() for i in range(1, len(token)))
    return {ranks[a] << 32 | ranks[b]: rank for a, b, rank in cuts if a in ranks and b in ranks}


def replay(words: list[bytes], singles: list[int], merges: dict[int, int]) -> list[list[int]]:
    """The ids of each word. Within a word the pair of the lowest rank goes first, of equal ones the leftmost."""
    symbols = [singles[c] for word in words for c in word]  # of all words in a row; -1 once joined to the one before
    after, before, ends = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1)), []
    end = 0
    for word in words:
        if word:
            before[end] = -1
            end += len(word)
            after[end - 1] = -1
        ends.append(end)
    find = merges.get
    index: dict[int, list[int]] = {}  # rank of a pair to where it begins
    for i, j in enumerate(after):
        if j >= 0 and (rank := find(symbols[i] << 32 | symbols[j])) is not None:
            if rank in index:
                index[rank].append(i)
            else:
                index[rank] = [i]
    queue = list(index)
    heapq.heapify(queue)
    while queue:
        rank = heapq.heappop(queue)
        places = index.pop(rank, ())
        if len(places) > 1:
            places.sort()
        for n, i in enumerate(places):
            j = after[i]
            if j < 0 or find(symbols[i] << 32 | symbols[j]) != rank:
                continue  # a merge of a lower rank, or this one just before, took a part of it
            symbols[i], symbols[j] = rank, -1
            k, h = after[j], before[i]
            after[i] = k
            lower = False
            if k >= 0:
                before[k] = i
                new = find(rank << 32 | symbols[k])
                if new is not None:
                    lower = new < rank
                    if new in index:
                        index[new].append(i)
                    else:
                        index[new] = [i]
                        heapq.heappush(queue, new)
            if h >= 0:
                new = find(symbols[h] << 32 | rank)
                if new is not None:
                    lower |= new < rank
                    if new in index:
                        index[new].append(h)
                    else:
                        index[new] = [h]
                        heapq.heappush(queue, new)
            if lower:  # a pair of a lower rank has come up: it goes before what is left of this one
                if n + 1 < len(places):
                    if rank not in index:
                        index[rank] = []
                        heapq.heappush(queue, rank)
                    index[rank] += places[n + 1 :]
                break
    return [[s for s in symbols[begin:end] if s >= 0] for begin, end in zip([0, *ends], ends)]


class Codec:
    """Encodes whole texts and decodes ids; one for each Python process."""

    def __init__(self, path: str, pattern: str):
        ranks = ranks_of(path)
        self.merges, self.pattern = merges_of(path), regex.compile(pattern)
        self.singles = [ranks.get(bytes([c]), -1) for c in range(256)]
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def learn(self, pieces: set[str]) -> None:
        """Encode the pieces that are new. Those that were not met since ``KEPT`` others are forgotten."""
        if len(self.known) > KEPT:
            self.known, self.older = {}, self.known
        new = pieces - self.known.keys()
        if again := new & self.older.keys():
            self.known.update((p, self.older[p]) for p in again)
            new -= again
        for part in batched(sorted(new), 1 << 16):
            found = replay([p.encode() for p in part], self.singles, self.merges)
            self.known.update(zip(part, map(tuple, found)))

    def encode(self, texts: list[bytes]) -> list[list[int]]:
        if sum(map(len, texts)) > common.SLICE_BYTES:  # one very long text: its pieces are met part by part
            return [self.encode_long(t.decode()) for t in texts]
        pieces = [self.pattern.findall(t.decode()) for t in texts]
        self.learn(set().union(*pieces))
        return [list(chain.from_iterable(map(self.known.__getitem__, p))) for p in pieces]

    def encode_long(self, text: str) -> list[int]:
        ids, found = [], (m[0] for m in self.pattern.finditer(text))
        while part := list(islice(found, 1 << 18)):
            self.learn(set(part))
            ids.extend(chain.from_iterable(map(self.known.__getitem__, part)))
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def shipped(spark: SparkSession, path: str) -> str:
    """Send the rank file to every executor; gives the name under which tasks find it."""
    spark.sparkContext.addFile(path)
    return path.rpartition("/")[2]


@cache
def codec(name: str, pattern: str) -> Codec:
    """The codec of this Python process; tasks that follow each other share it."""
    return Codec(SparkFiles.get(name), pattern)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Every row with ``n_tokens`` and ``ids`` (array<int>) in place of its text and of columns of these names, in whatever case.

    Null texts are empty, without ids; rows that are repeated, or have no doc_id, are encoded like others. A text longer than a slice is met part
    by part, but its ids are held at once.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("n_tokens", "ids")])
    name = shipped(docs.sparkSession, path)

    def make():
        own = codec(name, pattern)

        def of(texts: list[bytes]) -> list:
            ids = own.encode(texts)
            return [pa.array(map(len, ids), pa.int64()), pa.array(ids, pa.list_(pa.int32()))]

        return of

    return common.over_texts(docs, make, "n_tokens long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Every row with the bytes that its ``ids`` stand for (``decoded``) in their place; null ids give no bytes."""
    name = shipped(encoded.sparkSession, path)

    kept = encoded.drop("decoded", "ids")
    names, out = kept.columns, StructType([*kept.schema, StructField("decoded", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(name, "")
        for batch in batches:
            found = [b"" if x is None else own.decode(x) for x in batch.column("ids").to_pylist()]
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.binary())], names=out.names)

    return encoded.mapInArrow(run, out)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids (decimal, joined by spaces) and of the bytes decoded from them, per row."""
    name = shipped(docs.sparkSession, path)

    def make():
        own = codec(name, pattern)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        decimal = {i: str(i) for i in own.bytes_of}

        def of(texts: list[bytes]) -> list:
            ids = own.encode(texts)
            return [
                pa.array(map(len, ids), pa.int64()),
                pa.array([sha(" ".join(map(decimal.__getitem__, x)).encode()) for x in ids]),
                pa.array([sha(own.decode(x)) for x in ids]),
            ]

        return of

    return common.over_texts(common.documents(docs), make, "n_tokens long, ids_sha256 string, decoded_sha256 string")
