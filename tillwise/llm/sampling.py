"""Fingerprints by consistent weighted sampling.

Each of ``SAMPLES`` draws takes one weighted term of a text, with random numbers that depend on the term and the draw
alone: two Gamma(2, 1) values and a uniform one, from a hash. The chance that two texts draw the same term at
the same level is their generalised Jaccard similarity, the sum of the smaller over the sum of the larger weights.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm import common
from tillwise.session import materialise

SAMPLES = 64
#: Terms whose random numbers a task keeps (768 bytes each), and weighted terms that it draws from at once.
KEPT, AT_ONCE = 1 << 16, 1 << 12
#: New terms whose random numbers are drawn together: their arrays stay in a processor's cache.
DRAWN = 256
#: Bytes of text that are fingerprinted together.
CHUNK = 1 << 19

_DRAWS = (np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :]
_EXPONENTIAL = -np.log((np.arange(65536) + 0.5) / 65536)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers without visible order (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def draws(hashes: np.ndarray) -> np.ndarray:
    """For each term log c, r and beta of all draws, as float32 of shape (3, terms, SAMPLES)."""
    x = mix(hashes[:, None] + _DRAWS)
    bits = x.view(np.uint16).reshape(len(hashes), SAMPLES, 4)
    r = _EXPONENTIAL[bits[:, :, 0]] + _EXPONENTIAL[bits[:, :, 1]]
    c = _EXPONENTIAL[bits[:, :, 2]] + _EXPONENTIAL[bits[:, :, 3]]
    out = np.empty((3, *x.shape), np.float32)
    out[0] = np.log(c, out=c)
    out[1] = r
    # 24 bits, which a float32 holds exactly
    np.multiply(mix(x + np.uint64(1)) >> np.uint64(40), np.float32(2.0**-24), out=out[2], casting="unsafe", dtype=np.float32)
    return out


class Sampler:
    """Fingerprints of weighted terms; keeps the random numbers of the terms that it met last."""

    def __init__(self):
        self.slots: dict[bytes, int] = {}
        self.kept = np.zeros((3, KEPT, SAMPLES), np.float32)
        #: The value of each draw for a weight of one, of which the logarithm is zero, and so is the level.
        self.once = np.zeros((KEPT, SAMPLES), np.float32)

    def numbers(self, terms: list[bytes]) -> np.ndarray:
        known = list(map(self.slots.get, terms))
        new = list(dict.fromkeys(t for t, slot in zip(terms, known) if slot is None)) if None in known else []
        if len(self.slots) + len(new) > KEPT:
            self.slots.clear()
            new = list(dict.fromkeys(terms))
        if new:
            first = len(self.slots)
            self.slots.update(zip(new, range(first, first + len(new))))
            hashes = np.array([xxhash.xxh64_intdigest(t) for t in new], dtype=np.uint64)
            for i in range(0, len(new), DRAWN):
                part = draws(hashes[i : i + DRAWN])
                some = slice(first + i, first + i + part.shape[1])
                self.kept[:, some] = part
                log_c, r, beta = part
                self.once[some] = log_c - r * (np.float32(0) - beta + np.float32(1))
            known = list(map(self.slots.__getitem__, terms))
        return np.array(known, dtype=np.int64)

    def fingerprints(self, bags: list[dict[bytes, int]]) -> np.ndarray:
        """16 bits for each draw and bag; equal bags have equal fingerprints, the empty one is all zero."""
        least = np.full((len(bags), SAMPLES), np.inf, np.float32)
        terms = [t for bag in bags for t in bag]
        weights = np.array([w for bag in bags for w in bag.values()], dtype=np.float32)
        owner = np.repeat(np.arange(len(bags)), [len(bag) for bag in bags])
        for start in range(0, len(terms), AT_ONCE):
            part = slice(start, start + AT_ONCE)
            slot, weight, own = self.numbers(terms[part]), weights[part], owner[part]
            value = self.once[slot]
            more = np.flatnonzero(weight > 1)
            if len(more):
                log_c, r, beta = (kept[slot[more]] for kept in self.kept)
                level = np.floor(np.log(weight[more])[:, None] / r + beta)
                value[more] = log_c - r * (level - beta + np.float32(1))
            begin = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            least[own[begin]] = np.minimum(least[own[begin]], np.minimum.reduceat(value, begin, axis=0))
        out = (mix(least.view(np.uint32).astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)
        out[np.isinf(least)] = 0
        return out


def bag_of(text: bytes) -> Counter:
    """The weights of a text's terms: how often each word stands in it; A-Z in lower case, words end at ASCII white space."""
    return Counter(text.lower().split())


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of draws in which two fingerprints agree."""
    return (a == b).mean(axis=-1)


def edited(text: str, following: str) -> str:
    """The text with its last half (rounded down) replaced by as many of the first code points of the following."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_FOUND = "n_chars long, edited_sha256 string, fp binary, edited_fp binary, near_edited double, near_next double"


def _compare(sampler: Sampler, texts: list[bytes], follows: list[bytes], own=None, others=None) -> list[pa.Array]:
    """The columns of ``_FOUND`` for texts and those that follow them."""
    plain = [t.decode() for t in texts]
    changed = [edited(t, f.decode()).encode() for t, f in zip(plain, follows)]
    own = sampler.fingerprints([bag_of(t) for t in texts]) if own is None else own
    others = sampler.fingerprints([bag_of(t) for t in follows]) if others is None else others
    new = sampler.fingerprints([bag_of(t) for t in changed])
    return [
        pa.array([len(t) for t in plain], pa.int64()),
        pa.array([hashlib.sha256(t).hexdigest() for t in changed], pa.string()),
        pa.array([x.tobytes() for x in own], pa.binary()),
        pa.array([x.tobytes() for x in new], pa.binary()),
        pa.array(likeness(own, new), pa.float64()),
        pa.array(likeness(own, others), pa.float64()),
    ]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint (hex, 16 bits a draw) of every row's whole text; null and empty texts give zeros."""

    def make():
        sampler = Sampler()
        return lambda texts: [pa.array([x.tobytes() for x in sampler.fingerprints([bag_of(t) for t in texts])], pa.binary())]

    found = common.over_texts(common.documents(docs), make, "fp binary")
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"))


def against_next(docs: DataFrame) -> DataFrame:
    """Every document against its edited text and against the next document, by descending doc_id.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every row. After the last
    comes the first, so a single document follows itself. Null texts are empty; rows without id come last; rows that share
    an id follow each other by text. Rows are dealt by ranges of doc_id, each task walks its range in order, and
    only the first and last document of each range meet their neighbours in a second step.
    """
    ordered = (
        common.documents(docs)
        .repartitionByRange(F.col("doc_id").desc_nulls_last())
        .sortWithinPartitions(F.col("doc_id").desc_nulls_last(), "text")
    )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, part = Sampler(), TaskContext.get().partitionId()
        held: tuple | None = None  # the last row so far: id, text, fingerprint

        def rows(kind: int, ids: list, found: list[pa.Array], texts: list) -> pa.RecordBatch:
            n = len(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([part] * n, pa.int32()), pa.array([kind] * n, pa.int32()), pa.array(texts, pa.string()), *found],
                names=["doc_id", "part", "kind", "text", *names],
            )

        names = [x.split()[0] for x in _FOUND.split(", ")]
        blank = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]
        for batch in batches:
            for ids, texts in chunked(batch):
                prints = sampler.fingerprints([bag_of(t) for t in texts])
                if held is None:
                    yield rows(0, ids[:1], blank, [texts[0].decode()])
                else:
                    ids, texts, prints = [held[0], *ids], [held[1], *texts], np.concatenate([held[2], prints])
                if len(ids) > 1:
                    yield rows(2, ids[:-1], _compare(sampler, texts[:-1], texts[1:], prints[:-1], prints[1:]), [None] * (len(ids) - 1))
                held = (ids[-1], texts[-1], prints[-1:])
        if held is not None:
            yield rows(1, [held[0]], blank, [held[1].decode()])

    walked = materialise(ordered.mapInArrow(walk, f"doc_id long, part int, kind int, text string, {_FOUND}"), "walked")
    # two rows a range: its first (kind 0) and its last (kind 1), which the first of the next range follows
    firsts = walked.where("kind = 0").select(F.col("part").alias("next"), F.col("text").alias("follows"))
    parts = firsts.select(F.col("next").alias("part"))  # a number for each range; texts don't pass the window
    begin = parts.agg(F.min("part")).scalar()
    after = parts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), begin).alias("next"))
    lasts = walked.where("kind = 1").select("doc_id", "part", "text")
    lasts = lasts.join(after, "part").join(firsts, "next").select("doc_id", "text", "follows")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for batch in batches:
            found = _compare(sampler, common.raw_texts(batch), common.raw_texts(batch, "follows"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *found], names=["doc_id", *(x.split()[0] for x in _FOUND.split(", "))])

    ended = lasts.mapInArrow(finish, f"doc_id long, {_FOUND}")
    return walked.where("kind = 2").drop("part", "kind", "text").unionByName(ended).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.lower(F.hex("fp")).alias("fingerprint"),
        F.lower(F.hex("edited_fp")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def chunked(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[bytes]]]:
    """Ids and texts of the batch in parts of about ``CHUNK`` bytes, or one row."""
    ids, texts = batch.column("doc_id").to_pylist(), common.raw_texts(batch)
    start, held = 0, 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > CHUNK:
            yield ids[start:i], texts[start:i]
            start, held = i, 0
        held += len(text)
    if texts:
        yield ids[start:], texts[start:]
