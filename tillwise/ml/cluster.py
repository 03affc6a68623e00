"""Customer segmentation."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from tillwise import model
from tillwise.ml import together
from tillwise.ml.evaluate import confusion
from tillwise.ml.prepare import SCALED, fit_behaviour
from tillwise.session import materialise


def principal_components(vectors: DataFrame, k: int) -> tuple[DataFrame, list[float]]:
    """Projection on ``k`` components and their shares of variance (signs are arbitrary)."""
    fitted = PCA(k=k, inputCol=SCALED, outputCol="components").fit(vectors)
    return fitted.transform(vectors), [float(v) for v in fitted.explainedVariance]


def fit_kmeans(vectors: DataFrame, k: int, restarts: int = 10, seed: int = 42) -> together.Centres:
    """Best of several starts by training cost; all of them share their passes over the rows."""
    best = best_kmeans(together.packed(vectors), [k], restarts, seed)[0]
    return together.Centres(centres=best.centres.tolist(), cost=best.cost)


def silhouette(clustered: DataFrame) -> float:
    """Mean silhouette with squared distance over all rows, in linear time; NaN for one cluster."""
    if clustered.select("cluster").distinct().limit(2).count() < 2:
        return math.nan
    return float(
        ClusteringEvaluator(featuresCol=SCALED, predictionCol="cluster", distanceMeasure="squaredEuclidean").evaluate(
            clustered
        )
    )


def best_kmeans(blocks: DataFrame, ks: list[int], restarts: int = 10, seed: int = 42) -> list[together.Fit]:
    """For every k the best of several starts by training cost; all starts of all k share their passes over the rows."""
    fits = together.kmeans(blocks, [(k, seed + i) for k in ks for i in range(restarts)])
    return [min(fits[i * restarts : (i + 1) * restarts], key=lambda f: f.cost) for i in range(len(ks))]


def sweep(vectors: DataFrame, ks: range, restarts: int = 10) -> DataFrame:
    """Inertia, the sum of squares that the labels themselves have, and silhouette for every k."""
    rows = []
    for fitted in best_kmeans(together.packed(vectors), list(ks), restarts):
        labelled = together.with_cluster(vectors, fitted.centres)
        rows.append((fitted.k, fitted.cost, within(labelled), silhouette(labelled)))
    return vectors.sparkSession.createDataFrame(rows, "k INT, inertia DOUBLE, within DOUBLE, silhouette DOUBLE")


def mixture_criteria(vectors: DataFrame, ks: range, seed: int = 42) -> DataFrame:
    """BIC and AIC of Gaussian mixtures with full covariances."""
    n = vectors.count()
    d = len(vectors.select(SCALED).first()[0])
    rows = []
    for k, fitted in zip(ks, together.mixtures(together.packed(vectors), list(ks), seed)):
        free = k * (d + d * (d + 1) / 2) + k - 1
        rows.append((k, free * math.log(n) - 2 * fitted.likelihood, 2 * free - 2 * fitted.likelihood))
    return vectors.sparkSession.createDataFrame(rows, "k INT, bic DOUBLE, aic DOUBLE")


def compare_segmentations(vectors: DataFrame, k: int = 6, seed: int = 42) -> DataFrame:
    """K-means, Gaussian mixture, top-down tree and bottom-up merges with ``k`` segments each: model, labels given,
    rows labelled, sum of squares around the segments' means, and silhouette over all rows."""
    blocks = together.packed(vectors)
    labelled = {
        "k-means": together.with_cluster(vectors, best_kmeans(blocks, [k], seed=seed)[0].centres),
        "mixture": together.with_component(vectors, together.mixtures(blocks, [k], seed)[0]),
        "tree": fit_bisecting(vectors, k, seed).transform(vectors),
        "ward": ward_segments(vectors, k)[0],
    }
    rows = []
    for name, one in labelled.items():
        sizes = one.groupBy("cluster").count().agg(F.count("*"), F.sum("count")).first()
        rows.append((name, sizes[0], sizes[1], within(one), silhouette(one)))
    return vectors.sparkSession.createDataFrame(
        rows, "model STRING, n_clusters BIGINT, n BIGINT, within DOUBLE, silhouette DOUBLE"
    )


def within(clustered: DataFrame, cluster: str = "cluster") -> float:
    """The sum of squared distances of all rows to the means of their clusters."""
    v = vector_to_array(SCALED)
    width = len(clustered.select(SCALED).first()[0])
    parts = clustered.groupBy(cluster).agg(*[(F.count("*") * F.var_pop(v[i])).alias(f"s{i}") for i in range(width)])
    return float(sum(parts.agg(*[F.sum(f"s{i}") for i in range(width)]).first()))


def elbow(ks: list[int], inertias: list[float], sensitivity: float = 1.0) -> int | None:
    """Knee of a convex falling curve: where it lies furthest below its chord.

    The distance curve must fall by ``sensitivity`` mean steps after a peak before it
    rises again; the first such peak wins.
    """
    x, y = np.array(ks, float), np.array(inertias, float)
    if len(x) < 3 or y.max() == y.min():
        return None
    u = (x - x.min()) / (x.max() - x.min())
    v = (y - y.min()) / (y.max() - y.min())
    below = 1 - v - u
    drop = sensitivity * np.abs(np.diff(u)).mean()
    for i in range(1, len(below) - 1):
        if below[i] >= below[i - 1] and below[i] >= below[i + 1]:
            for j in range(i + 1, len(below)):
                if below[j] > below[i]:
                    break
                if below[j] < below[i] - drop:
                    return ks[i]
    return None


def choose_k(swept: DataFrame, criteria: DataFrame) -> dict[str, int | None]:
    """k by elbow, best silhouette, least BIC and least AIC (a row per candidate k)."""
    rows = swept.join(criteria, "k", "left").orderBy("k").collect()
    ks = [r.k for r in rows]
    known = [r for r in rows if r.bic is not None]
    return {
        "elbow": elbow(ks, [r.inertia for r in rows]),
        "silhouette": max(rows, key=lambda r: r.silhouette).k,
        "bic": min(known, key=lambda r: r.bic).k if known else None,
        "aic": min(known, key=lambda r: r.aic).k if known else None,
    }


def cluster_profile(clustered: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Mean of every behaviour column per cluster, its size, and z-scores of these means
    across clusters (one row per cluster, so the windows are small)."""
    means = clustered.groupBy(cluster).agg(
        F.count("*").alias("n_customers"),
        *[F.avg(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(c) for c in model.BEHAVIOUR],
    )
    every = Window.partitionBy()
    scores = {
        f"z_{c}": F.try_divide(F.col(c) - F.avg(c).over(every), F.stddev_samp(c).over(every)) for c in model.BEHAVIOUR
    }
    return means.withColumns(scores)


def cluster_rules(clustered: DataFrame, depth: int = 4) -> tuple[str, float]:
    """Rules of a shallow tree that retells the clusters from raw columns, and its accuracy
    in percent. Needs the ``x_`` columns of the behaviour pipeline."""
    inputs = [f"x_{c}" for c in model.BEHAVIOUR]
    vectors = VectorAssembler(inputCols=inputs, outputCol="rule_features").transform(clustered)
    tree = DecisionTreeClassifier(
        maxDepth=depth, labelCol="cluster", featuresCol="rule_features", predictionCol="rule", seed=42
    ).fit(vectors)
    text = tree.toDebugString
    for i in reversed(range(len(inputs))):
        text = text.replace(f"feature {i} ", f"{model.BEHAVIOUR[i]} ")
    hits = tree.transform(vectors).agg(F.avg((F.col("rule") == F.col("cluster")).cast("double"))).first()[0]
    return text, 100.0 * hits


def cross_segments(clustered: DataFrame) -> DataFrame:
    """Customers per cluster and value segment."""
    return (
        confusion(clustered, "cluster", "value_segment")
        .groupBy(F.col("label").alias("cluster"))
        .pivot("predicted", model.SEGMENTS)
        .sum("n")
        .na.fill(0)
    )


def fit_bisecting(vectors: DataFrame, k: int = 6, seed: int = 42) -> PipelineModel:
    """Top-down tree of segments over all rows.

    A split begins by moving the centre by a share of its length, and standardised columns have a centre of length zero. A further
    column with the same value in every row gives the centre a length and changes no distance.
    """
    stages = [
        SQLTransformer(statement="SELECT *, 10D AS tree_lift FROM __THIS__"),
        VectorAssembler(inputCols=[SCALED, "tree_lift"], outputCol="tree_vector"),
        BisectingKMeans(k=k, seed=seed, featuresCol="tree_vector", predictionCol="cluster"),
    ]
    return Pipeline(stages=stages).fit(vectors)


def cluster_features(vectors: DataFrame, most: int = 2000, step: float = 2.0**-20) -> tuple[DataFrame, float]:
    """Sums over the cells of a grid, at most ``most`` of them: cell (array), n, total (array) and squares; and the cells' width.

    The sums of a cell are those of the smaller cells in it, so the width doubles, each time over the sums of the last, until few
    enough are left. With no more distinct rows than ``most``, and the first width, every cell holds equal rows only.
    """
    width = len(vectors.select(SCALED).first()[0])
    rows = vectors.select(vector_to_array(SCALED).alias("v"))
    rows = rows.select(
        F.transform("v", lambda x: F.floor(x / step)).alias("cell"),
        F.lit(1).cast("long").alias("n"),
        *[F.col("v")[i].alias(f"t{i}") for i in range(width)],
        F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x).alias("squares"),
    )

    def summed(df: DataFrame) -> DataFrame:
        return df.groupBy("cell").agg(F.sum("n").alias("n"), *[F.sum(f"t{i}").alias(f"t{i}") for i in range(width)], F.sum("squares").alias("squares"))

    cells = materialise(summed(rows), "cells")
    while cells.count() > most:
        step *= 2
        wider = F.transform("cell", lambda x: F.floor(x / 2).cast("long"))
        cells = materialise(summed(cells.withColumn("cell", wider)), "cells")
    return cells.select("cell", "n", F.array(*[f"t{i}" for i in range(width)]).alias("total"), "squares"), step


def ward_merges(n: np.ndarray, total: np.ndarray) -> list[tuple[int, int, float]]:
    """Merges of groups with these sizes and sums, by rising cost; a group keeps the smaller number of its two parts.

    The cost of a merge is what it adds to the sum of squares around the means. A chain of nearest neighbours ends in two
    groups that are each other's nearest; merging them at once gives the same tree as always merging the nearest of all.
    """
    n, total = n.astype(float).copy(), total.astype(float).copy()
    alive, merges, chain = np.ones(len(n), bool), [], []

    def costs(i: int) -> np.ndarray:
        apart = ((total / n[:, None] - total[i] / n[i]) ** 2).sum(axis=1)
        out = np.where(alive, n * n[i] / (n + n[i]) * apart, np.inf)
        out[i] = np.inf
        return out

    for _ in range(len(n) - 1):
        if not chain:
            chain = [int(np.flatnonzero(alive)[0])]
        while True:
            cost = costs(chain[-1])
            nearest = int(cost.argmin())
            if len(chain) > 1 and cost[chain[-2]] <= cost[nearest]:
                nearest = chain[-2]
                break
            chain.append(nearest)
        low, high = sorted((chain.pop(), chain.pop()))
        merges.append((low, high, float(cost[nearest])))
        n[low], total[low], alive[high] = n[low] + n[high], total[low] + total[high], False
    return sorted(merges, key=lambda m: m[2])


def ward_segments(vectors: DataFrame, k: int = 6, most: int = 2000) -> tuple[DataFrame, list[float]]:
    """Every row with its ``cluster`` (0 to k - 1, by size), from bottom-up merges of cell sums, and the costs of all merges, rising.

    The tree is built on the driver from at most ``most`` sums, however many rows there are; with no more distinct rows it is that of the rows.
    """
    cells, step = cluster_features(vectors, most)
    rows = cells.orderBy("cell").collect()
    n, total = np.array([r["n"] for r in rows]), np.array([r["total"] for r in rows])
    merges = ward_merges(n, total)
    group = np.arange(len(rows))
    for low, high, _ in merges[: max(0, len(rows) - k)]:
        group[group == group[high]] = group[low]
    sizes = {g: int(n[group == g].sum()) for g in np.unique(group)}
    number = {g: i for i, g in enumerate(sorted(sizes, key=lambda g: (-sizes[g], g)))}
    labels = vectors.sparkSession.createDataFrame(
        [(r["cell"], number[g]) for r, g in zip(rows, group)], "ward_cell ARRAY<BIGINT>, cluster INT"
    )
    cell = F.transform(vector_to_array(SCALED), lambda x: F.floor(x / step))
    return vectors.withColumn("ward_cell", cell).join(F.broadcast(labels), "ward_cell").drop("ward_cell"), [c for *_, c in merges]


def train_segmentation(
    features: DataFrame, k: int = 6, restarts: int = 10
) -> tuple[PipelineModel, dict[str, float]]:
    """The segmentation model with its preprocessing, and its metrics."""
    scaler = fit_behaviour(features)
    vectors = scaler.transform(features).persist()
    try:
        fitted = fit_kmeans(vectors, k, restarts)
        metrics = {
            "silhouette_score": silhouette(fitted.transform(vectors)),
            "inertia": fitted.getOrDefault("cost"),
            "k": k,
            "n_samples": vectors.count(),
        }
    finally:
        vectors.unpersist()
    return PipelineModel([*scaler.stages, fitted]), metrics
