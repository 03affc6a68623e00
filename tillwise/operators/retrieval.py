"""Sections of documents and vector search."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from tillwise.functions.columns import stripped
from tillwise.functions.vectors import cosine, unit
from tillwise.operators.neighbours import POOL_BLOCK, n_least, over_tiles
from tillwise.operators.ranking import top_per_group

# Every line end that a text reader may meet, as one pattern.
_LINE_END = r"\r\n|[\r\x0B\x0C\x1C-\x1E\x85  ]"


def markdown_sections(docs: DataFrame, default_title: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per non-empty ``## `` section: title and content.

    Lines that start with ``# `` are dropped; text before the first section gets the default
    title. The split works inside each row, so no document crosses a shuffle.
    """
    body = F.regexp_replace(F.col(text), _LINE_END, "\n")
    parts = F.split(F.concat(F.lit("\n"), body), "\n## ")
    sections = docs.select(key, F.posexplode(parts).alias("section", "part"))
    lines = F.split("part", "\n")
    first = F.col("section") == 0
    content = F.filter(
        F.when(first, lines).otherwise(F.slice(lines, 2, F.size(lines))), lambda line: ~line.startswith("# ")
    )
    return sections.select(
        key,
        "section",
        F.when(first, default_title).otherwise(stripped(lines[0])).alias("title"),
        stripped(F.array_join(content, "\n")).alias("content"),
    ).where(F.col("content") != "")


def similarity(pairs: DataFrame, a: str, b: str) -> DataFrame:
    return pairs.withColumn("similarity", cosine(F.col(a), F.col(b)))


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    lengths = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)


def search(
    queries: DataFrame,
    corpus: DataFrame,
    n: int = 2,
    threshold: float = 0.3,
    query_key: str = "query_id",
    corpus_key: str = "vec_id",
    vector: str = "embedding",
    block: int = POOL_BLOCK,
) -> DataFrame:
    """Best ``n`` corpus vectors of every query, then those with similarity >= ``threshold``.

    Exact. Queries and corpus meet block by block; a task multiplies two blocks and keeps ``n``
    rows per query, so only (corpus blocks x queries x n) candidates are merged. Equal
    similarities go to the smaller key.
    """
    kinds = queries.schema[query_key].dataType.simpleString(), corpus.schema[corpus_key].dataType.simpleString()
    schema = f"{query_key} {kinds[0]}, {corpus_key} {kinds[1]}, similarity double"

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({query_key: [], corpus_key: [], "similarity": []})
        right = right.sort_values(corpus_key)
        known, keys = _unit_rows(np.stack(right[vector].to_list()).astype("float64")), right[corpus_key].to_numpy()
        found = []
        for start in range(0, len(left), 256):
            piece = left.iloc[start : start + 256]
            # rounded so that one query sees equal similarities as equal on every machine
            scores = np.round(_unit_rows(np.stack(piece[vector].to_list()).astype("float64")) @ known.T, 12)
            at, hit = np.nonzero(n_least(-scores, n))
            found.append(pd.DataFrame({query_key: piece[query_key].to_numpy()[at], corpus_key: keys[hit], "similarity": scores[at, hit]}))
        return pd.concat(found)

    candidates = over_tiles(
        queries.select(query_key, vector), corpus.select(corpus_key, vector), query_key, corpus_key, best, schema, pool_block=block
    )
    best_of = top_per_group(candidates, [query_key], n, F.desc("similarity"), F.asc(corpus_key), name="rank")
    return best_of.where(F.col("similarity") >= threshold)


def _unit_vector(column: str) -> Column:
    return array_to_vector(unit(F.col(column)))


def indexed_search(
    queries: DataFrame,
    corpus: DataFrame,
    distance: float = 1.2,
    bucket: float = 1.0,
    tables: int = 4,
    query_key: str = "query_id",
    corpus_key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Nearest corpus vector per query through random projections.

    On vectors of length one, Euclidean distance orders like cosine similarity, and
    similarity = 1 - distance^2 / 2. Only vectors that share a bucket with the query are
    compared, so a true neighbour can be missed; ``distance`` bounds the join.
    """
    # a vector without length has similarity 0 to everything and no direction to index
    def has_length(c: str) -> Column:
        return F.exists(c, lambda x: x != 0)

    left = queries.where(has_length(vector)).select(query_key, _unit_vector(vector).alias("v"))
    right = corpus.where(has_length(vector)).select(corpus_key, _unit_vector(vector).alias("v"))
    model = BucketedRandomProjectionLSH(
        inputCol="v", outputCol="hashes", bucketLength=bucket, numHashTables=tables, seed=42
    ).fit(right)
    near = model.approxSimilarityJoin(left, right, distance, "distance").select(
        F.col(f"datasetA.{query_key}").alias(query_key),
        F.col(f"datasetB.{corpus_key}").alias(corpus_key),
        (1 - F.col("distance") ** 2 / 2).alias("similarity"),
    )
    return top_per_group(near, [query_key], 1, F.desc("similarity"), F.asc(corpus_key), name="rank")


def compare_searches(exact: DataFrame, indexed: DataFrame, query_key: str = "query_id", corpus_key: str = "vec_id") -> DataFrame:
    """Per query: best hit and score of both searches, and whether they agree."""
    a = exact.where("rank = 1").select(
        query_key, F.col(corpus_key).alias("exact_hit"), F.col("similarity").alias("exact_similarity")
    )
    b = indexed.select(query_key, F.col(corpus_key).alias("indexed_hit"), F.col("similarity").alias("indexed_similarity"))
    return a.join(b, query_key, "left").withColumn(
        "same_hit", F.coalesce(F.col("exact_hit") == F.col("indexed_hit"), F.lit(False))
    )
