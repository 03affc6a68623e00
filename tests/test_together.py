"""Fits that share their passes, against plain versions."""

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector

from tillwise.ml import cluster, together
from tillwise.ml.prepare import SCALED


def vectors(spark, x):
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id long, v array<double>")
    return df.select("id", array_to_vector("v").alias(SCALED)).repartition(3)


def groups(seed=1, n=40):
    r = np.random.default_rng(seed)
    middles = np.array([[0.0, 0, 0], [20, 0, 0], [0, 20, 0], [0, 0, 20]])
    return np.concatenate([m + r.normal(0, 1, (n, 3)) for m in middles])


def test_kmeans_of_all_settings_share_passes(spark, monkeypatch):
    x = groups()
    passes, plain = [], together._pass
    monkeypatch.setattr(together, "_pass", lambda *a, **k: passes.append(1) or plain(*a, **k))
    blocks = together.packed(vectors(spark, x))
    fits = together.kmeans(blocks, [(k, seed) for k in (2, 4) for seed in range(8)])
    assert len(passes) < 16 * 6 / 2  # alone, each start takes six passes before its first step
    for f in fits:
        gaps = ((x[:, None] - f.centres) ** 2).sum(axis=2)
        assert f.done and abs(f.cost - gaps.min(axis=1).sum()) < 1e-6
        for i, c in enumerate(f.centres):  # every centre is the mean of its rows
            assert np.allclose(c, x[gaps.argmin(axis=1) == i].mean(axis=0))
    best = sum(((g - g.mean(axis=0)) ** 2).sum() for g in np.split(x, 4))
    assert abs(min(f.cost for f in fits if f.k == 4) - best) < 1e-6


def test_clusters_are_the_nearest_centres(spark):
    x, centres = groups(2, 5), np.array([[0.0, 0, 0], [20, 0, 0], [0, 20, 10]])
    got = {r["id"]: r["cluster"] for r in together.with_cluster(vectors(spark, x), centres).select("id", "cluster").collect()}
    want = ((x[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
    assert [got[i] for i in range(len(x))] == want.tolist()


def test_equal_rows_and_more_clusters_than_rows(spark):
    same = together.packed(vectors(spark, np.ones((6, 3))))
    (fit,) = together.kmeans(same, [(3, 1)])
    assert fit.cost == 0 and np.allclose(fit.centres, 1)
    assert together.kmeans(together.packed(vectors(spark, groups(3, 1))), [(10, 1)])[0].cost < 1e-9


def test_mixture_of_one_is_the_normal_distribution_of_the_rows(spark):
    x = groups(4) @ np.array([[1, 0.5, 0], [0, 1, 0], [0, 0, 1.0]])
    one, four = together.mixtures(together.packed(vectors(spark, x)), [1, 4], 42)
    cov = np.cov(x.T, bias=True)
    assert np.allclose(one.means[0], x.mean(axis=0)) and np.allclose(one.covariances[0], cov)
    n, d = x.shape
    want = -0.5 * n * (d * np.log(2 * np.pi) + np.log(np.linalg.det(cov)) + d)
    assert abs(one.likelihood - want) < 1e-6 * abs(want)
    assert four.likelihood > one.likelihood and abs(four.weights.sum() - 1) < 1e-9


def test_sweep_costs_fall(spark):
    rows = cluster.sweep(vectors(spark, groups(5)), range(2, 6), restarts=4).orderBy("k").collect()
    assert [r["k"] for r in rows] == [2, 3, 4, 5]
    assert all(a["inertia"] > b["inertia"] for a, b in zip(rows, rows[1:]))
    assert all(abs(r["inertia"] - r["within"]) <= 0.01 * r["within"] for r in rows)
    assert max(rows, key=lambda r: r["silhouette"])["k"] == 4


def test_segmentation_shares_its_starts_and_keeps_them(spark, tmp_path, monkeypatch):
    """Ten starts cost the passes of the longest; the model is saved and read as a stage."""
    random = np.random.default_rng(3)
    table = [([float(v) for v in row],) for row in np.concatenate([random.normal(m, 0.2, (60, 2)) for m in (-4, 0, 4)])]
    df = spark.createDataFrame(table, "v ARRAY<DOUBLE>").select(array_to_vector("v").alias(SCALED))
    passes, plain = [], together._pass
    monkeypatch.setattr(together, "_pass", lambda *given: passes.append(1) or plain(*given))
    fitted = cluster.fit_kmeans(df, 3, restarts=10)
    assert len(passes) < 40
    centres = sorted(c[0] for c in fitted.getOrDefault("centres"))
    assert np.allclose(centres, [-4, 0, 4], atol=0.2)
    PipelineModel([fitted]).write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert again.transform(df).select("cluster").collect() == fitted.transform(df).select("cluster").collect()
    mixed = together.with_component(df, together.mixtures(together.packed(df), [3], 1)[0])
    assert mixed.groupBy("cluster").count().count() == 3
    compared = {r.model: r for r in cluster.compare_segmentations(df, 3).collect()}
    assert all(r.n == 180 for r in compared.values()) and len(compared) == 4
