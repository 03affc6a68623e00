"""Exact nearest neighbours by a block matrix join over int8 codes.

Vectors are dealt into blocks. A tile multiplies the int8 codes of a block of queries with those of a block of
candidates; the quantisation errors of both sides bound how far the product may be from the cosine. Pairs that
the bounds cannot rule out are computed again in double precision, and the best of all tiles are merged by heaps.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.session import materialise

#: Rows of a tile on the query side, on the candidate side, and candidates multiplied at once.
QUERY_BLOCK, CANDIDATE_BLOCK, STRIPE = 2048, 8192, 2048
#: Added to every bound for the rounding of the float arithmetic itself.
SLACK = 1e-9


def nearest(vectors: DataFrame, id_col: str, vector_col: str, every: int, k: int) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (cosine) of the ``k`` nearest rows of each query.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but the query's own; ties go to
    the smaller id; with fewer candidates, all are returned. Vectors that are null, empty, zero or hold null or
    non-finite components (or whose squares under- or overflow) take no part, nor do rows without id. Rows that
    share an id count once, with the smallest vector. Vectors of different lengths are never compared. An empty table
    gives no rows. Copies of one vector are searched once, and enter a tile at most k + 1 times.
    """
    value = F.col(vector_col)
    square = F.aggregate(value.cast("array<double>"), F.lit(0.0), lambda a, x: a + x * x)
    kept = materialise(
        vectors.where((square > 0) & (square < F.lit(float("inf"))))
        .select(F.col(id_col).cast("long").alias("vec_id"), value.alias("vector"))
        .where(F.col("vec_id").isNotNull())
        .groupBy("vec_id")
        .agg(F.min("vector").alias("vector")),
        "vectors",
    )
    first = Window.partitionBy("vector").orderBy("vec_id")
    candidates = materialise(
        kept.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1).select("vec_id", "vector"), "candidates"
    )
    queries = kept.where(F.col("vec_id") % every == 0)
    classes = materialise(queries.groupBy("vector").agg(F.min("vec_id").alias("rep")), "queries")
    across = max(1, math.ceil(candidates.count() / CANDIDATE_BLOCK))
    down = max(1, math.ceil(classes.count() / QUERY_BLOCK))

    def blocks(df: DataFrame, key: str, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return df.select(
            F.size("vector").alias("dim"),
            F.pmod(F.xxhash64(key), F.lit(n_own)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other),
            F.col(key).alias("id"),
            "vector",
        )

    left = blocks(classes, "rep", "q", down, "c", across)
    right = blocks(candidates, "vec_id", "c", across, "q", down)
    tile = ["dim", "q", "c"]
    found = (
        left.groupBy(*tile)
        .cogroup(right.groupBy(*tile))
        .applyInArrow(lambda a, b: best_of_tile(a, b, k + 1), "rep long, vec_id long, score double")
    )

    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        heaps: dict[int, list[tuple[float, int]]] = {}
        for frame in frames:
            for rep, vec, score in zip(frame["rep"].tolist(), frame["vec_id"].tolist(), frame["score"].tolist()):
                heap = heaps.setdefault(rep, [])
                (heapq.heappush if len(heap) <= k else heapq.heappushpop)(heap, (score, -vec))
        ordered = {rep: sorted(heap, reverse=True) for rep, heap in heaps.items()}
        if not ordered:
            return
        yield pd.DataFrame(
            {
                "rep": pd.Series(list(ordered), dtype="int64"),
                "ids": [[-v for _, v in h] for h in ordered.values()],
                "scores": [[s for s, _ in h] for h in ordered.values()],
            }
        )

    merged = found.repartition("rep").mapInPandas(merge, "rep long, ids array<long>, scores array<double>")
    members = queries.join(classes, "vector").select("rep", F.col("vec_id").alias("query_id"))
    others = F.filter(F.arrays_zip("ids", "scores"), lambda x: x["ids"] != F.col("query_id"))
    return (
        members.join(merged, "rep")
        .select("query_id", F.posexplode(F.slice(others, 1, k)).alias("rank", "hit"))
        .select(
            "query_id", (F.col("rank") + 1).alias("rank"), F.col("hit.ids").alias("vec_id"), F.col("hit.scores").alias("score")
        )
    )


def in_order(products: np.ndarray) -> np.ndarray:
    """Sums of the rows, added from left to right."""
    return np.add.accumulate(products, axis=1)[:, -1]


def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("id").to_numpy()
    values = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return ids, values.reshape(len(ids), -1)


def int8_codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, their scale, and the length of what the codes leave out, row by row."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    return codes, scale, np.sqrt(((unit - codes * scale[:, None]) ** 2).sum(axis=1))


def best_of_tile(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """The ``k`` best candidates of the tile for each query, by cosine and then smaller id."""
    empty = pa.table({"rep": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    if not left.num_rows or not right.num_rows:
        return empty
    (rep, a), (ids, b) = matrix(left), matrix(right)
    a_norm, b_norm = np.sqrt(in_order(a * a)), np.sqrt(in_order(b * b))
    a_codes, a_scale, a_rest = int8_codes(a / a_norm[:, None])
    b_codes, b_scale, b_rest = int8_codes(b / b_norm[:, None])
    exact = np.float32 if a.shape[1] * 127**2 < 1 << 24 else np.float64  # integer sums that the type holds exactly
    top_q, top_id, top_score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    floor = np.full(len(rep), -np.inf)
    for start in range(0, len(ids), STRIPE):
        part = slice(start, start + STRIPE)
        product = (a_codes.astype(exact) @ b_codes[part].astype(exact).T) * a_scale[:, None] * b_scale[None, part]
        bound = a_rest[:, None] + (1 + a_rest)[:, None] * b_rest[None, part] + SLACK
        if product.shape[1] >= k:
            floor = np.maximum(floor, np.partition(product - bound, -k, axis=1)[:, -k])
        q, c = np.nonzero(product + bound >= floor[:, None])
        c += start
        score = np.concatenate(
            [np.zeros(0)]
            + [in_order(a[q[i : i + 65536]] * b[c[i : i + 65536]]) for i in range(0, len(q), 65536)]
        ) / (a_norm[q] * b_norm[c])
        top_q, top_id, top_score = np.r_[top_q, q], np.r_[top_id, ids[c]], np.r_[top_score, score]
        order = np.lexsort((top_id, -top_score, top_q))
        top_q, top_id, top_score = top_q[order], top_id[order], top_score[order]
        begins = np.searchsorted(top_q, top_q)
        place = np.arange(len(top_q)) - begins
        kth = place == k - 1
        floor[top_q[kth]] = np.maximum(floor[top_q[kth]], top_score[kth] - SLACK)
        top_q, top_id, top_score = (x[place < k] for x in (top_q, top_id, top_score))
    return pa.table({"rep": rep[top_q], "vec_id": top_id, "score": top_score})
