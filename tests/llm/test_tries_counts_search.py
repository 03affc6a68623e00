"""Prefix tries, token counts and lexical search against plain versions of themselves, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tillwise.llm import lexical, tokens, trie

MODEL = public_tokenizers.path("piece_bpe_32k.model")


# prefix trie


def plain_paths(rows):
    """conv_id to its turns (role, text), by turn, null first."""
    out = {}
    for c, t, role, text in rows:
        if c is not None:
            out.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(turns)] for c, turns in out.items()}


def plain_nodes(paths):
    members, ends = {}, {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
        ends.setdefault(tuple(path), []).append(c)
    out = []
    for p, ids in members.items():
        below = [x for x in members if x[: len(p)] == p]
        children = [x for x in below if len(x) == len(p) + 1]
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        sha = hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()
        out.append((min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), len(children), len(leaves), saved, sha))
    return sorted(out, key=str)


def grafted(paths):
    out = {}
    for c, own in paths.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = paths.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:]
    return out


def conversations(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.withColumns({c: F.lit("clash") for c in ("pos", "part", "stem", "k1", "rank", "n", "depth", "slice")})


def random_rows(seed, ids, words=3, longest=9):
    r = random.Random(seed)
    return [(c, t, r.choice(["user", "assistant", None]), r.choice(["", None, *("éa", "bb", "c😀")[:words]])) for c in ids for t in range(r.randint(0, longest))]


def tuples(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_trie_equals_brute_force(spark):
    rows = random_rows(1, [*range(40), *range(90, 230), 512, -7, -205], words=1, longest=7)
    rows += [(300, None, "user", "first"), (300, 0, "user", "second"), (None, 0, "user", "no id")]
    got = tuples(trie.grafted_nodes(conversations(spark, rows)))
    assert got == plain_nodes(grafted(plain_paths(rows)))


def test_trie_in_small_bands_shards_and_slices(spark):
    """A conversation of many bands, a third of all conversations alike, and many that share a beginning."""
    r = random.Random(2)
    rows = [(1, t, "user", str(t % 7)) for t in range(150)] + [(2, t, "user", str(t % 7)) for t in range(120)]
    rows += [(c, t, "user", "same") for c in range(10, 60) for t in range(4)]
    rows += [(c, t, "user", "same" if t < 2 else r.choice("abc")) for c in range(60, 110) for t in range(6)]
    turns = trie.turns(conversations(spark, rows))
    got = tuples(trie.nodes(turns, turns.select("conv_id").distinct(), "pos", levels=3, shard=5, slice_=16))
    assert got == plain_nodes(plain_paths(rows))


def test_trie_of_nothing_and_of_turnless(spark):
    assert trie.grafted_nodes(conversations(spark, [])).collect() == []
    # 150 takes turns of 100, which isn't there, and has too few of its own
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 5)
    got = tuples(trie.grafted_nodes(conversations(spark, [(c, 0, "user", "x")])))
    assert got == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_double_array_holds_its_paths():
    r = np.random.default_rng(3)
    paths = np.unique(r.integers(0, 30, (500, 4)), axis=0)
    array = trie.DoubleArray(30)
    states = np.zeros(len(paths), np.int64)
    for d in range(4):
        states = array.add_level(states, paths[:, d])
    assert len(set(states.tolist())) == len(paths)
    walk = np.zeros(len(paths), np.int64)
    for d in range(4):
        walk = array.step(walk, paths[:, d])
    assert (walk == states).all()
    unknown = np.setdiff1d(np.arange(30), paths[paths[:, 0] == paths[0, 0], 1])
    first = array.step(np.zeros(1, np.int64), paths[:1, 0])
    assert (array.step(np.repeat(first, len(unknown)), unknown) == -1).all()
    assert len(array.check) < 8 * sum(len(np.unique(paths[:, :d], axis=0)) for d in range(1, 5))


# token counts

CASES = [
    "x" * 5001, "xy" * 2000, " " * 3000, "\n" * 999, "abc " * 900, "😀𐍈" * 500, "hello" * 800, "é" * 500, "", " ", "<s></s><unk> <0x41>",
    "a" * 49 + " " + "b" * 49, "中文" * 300, "▁ ▁a" * 200, "\u0000 " * 100,
]


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.mark.parametrize("chunk,overlap", [(8, 1), (50, 1), (50, 4), (257, 16), (1000, 64)])
def test_spliced_counts_equal_the_library(model, chunk, overlap):
    r = random.Random(chunk)
    texts = CASES + ["".join(r.choice(r.choice(["ab ", "thé rs", "xx ", "in the on ", "\n\t a"])) for _ in range(r.randint(0, 600))) for _ in range(150)]
    for text in texts:
        assert tokens.spliced(model, text, chunk, overlap)[0] == len(model.encode(text)), text[:40]


def test_spliced_text_is_not_encoded_whole(model):
    assert tokens.spliced(model, "some words of a text " * 500, 1000, 64)[1] == math.ceil(10_500 / 1000)


def test_token_counts(spark, model):
    texts = [None, "", *CASES, "long text of words " * 20_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, "other"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("clash")).withColumn("n_bytes", F.lit(1))
    got = sorted((tuple(r)[:4] for r in tokens.counts(df, MODEL, chunk=2000).collect()), key=str)
    want = [(i, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for i, t in rows]
    assert got == sorted(want, key=str)
    assert tokens.counts(df.limit(0), MODEL).collect() == []


# lexical search


def plain_search(docs, items, k=20):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    bags = [(i, Counter(words(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    documents, terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for i, b, n in bags:
            m = 100 - 25 + (25 * n * documents) // terms
            score = sum(
                math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 12 * m)) for t in words(text) if t in b
            )
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def corpus(seed, n):
    r = random.Random(seed)
    some = ["The", "the", "of", "É", "é", "x1", "don't", "a_b", "中文", "zipf", *(f"w{i}" for i in range(60))]
    make = lambda n: " ".join(r.choice(some[: r.choice([5, 20, 70])]) for _ in range(n))
    docs = [(i, make(r.choice([1, 5, 30, 200]))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, "... --"), (None, make(20)), (None, make(20)), (5, make(30)), (7, docs[7][1]), (n + 3, "zipf rare " * 30_000)]
    docs += [(2 * n + i, "the same copy of w1 w2") for i in range(n)]  # a third of all documents
    items = [(i, make(12)) for i in range(8)] + [(50, None), (51, "nowhere"), (52, "the"), (3, "the copy of w1 rare"), (53, "zipf zipf w59"), (None, "w3 w4")]
    return docs, items


@pytest.mark.parametrize("most", [256, 3])
def test_search_equals_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(lexical, "QUERIES", most)
    docs, items = corpus(1, 150)
    clash = {c: F.lit("clash") for c in ("at", "sketch", "rank", "score", "q", "bound")}
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns(clash)
    queries = spark.createDataFrame(items, "item_id long, text string").withColumns(clash)
    for k in (20, 3):
        assert tuples(lexical.search(lexical.index(df), queries, k)) == plain_search(docs, items, k)


def test_search_of_nothing(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.search(lexical.index(docs), items).collect() == []
    blank = spark.createDataFrame([(1, "?!"), (2, None)], "doc_id long, text string")
    assert lexical.search(lexical.index(blank), items).collect() == []
    assert lexical.search(lexical.index(items.withColumnRenamed("item_id", "doc_id")), items.limit(0)).collect() == []


def test_bounds_hold_and_are_not_idle():
    docs, items = corpus(2, 120)
    texts = [(t or "").encode() for _, t in docs]
    sizes = [len(lexical.terms_of(t)) for t in texts]
    documents, terms = sum(n > 0 for n in sizes), sum(sizes)
    batch = lexical.Batch([Counter(lexical.terms_of((t or "").encode())) for _, t in items])
    df = Counter(batch.number[w] for t in texts for w in set(lexical.terms_of(t)) if w in batch.number)
    batch.weigh(documents, df)
    made = lexical.sketches(texts, documents, terms).to_pylist()
    rows = [i for i, s in enumerate(made) if s]
    bounds = batch.bounds([made[i] for i in rows], batch.table())
    found = lexical.Found(batch, texts, documents, terms)
    exact = np.array([[found.score(i, q) for q in range(len(items))] for i in rows])
    assert (bounds >= exact).all()
    assert bounds.sum() < 1.3 * exact.sum()
