import time

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tillwise.ml import boost, classify


@pytest.fixture(scope="module")
def rows(spark):
    random = np.random.default_rng(5)
    x = random.normal(size=(1500, 4)).round(1)
    y = (x[:, 0] * x[:, 1] > 0.2).astype(int) + (x[:, 2] > 0.8)
    table = [(int(a), float(1 + a), [float(v) for v in row]) for a, row in zip(y, x)]
    df = spark.createDataFrame(table, "label INT, weight DOUBLE, v ARRAY<DOUBLE>")
    return df.select("label", "weight", array_to_vector("v").alias("scaled")).repartition(3).persist()


def right(scored):
    return scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]


def test_agrees_with_sparks_trees(rows):
    machine = OneVsRest(classifier=GBTClassifier(featuresCol="scaled", maxIter=5, maxDepth=3), featuresCol="scaled", weightCol="weight")
    other = machine.fit(rows).transform(rows)
    fitted = boost.Boosted(featuresCol="scaled", weightCol="weight", maxIter=5, maxDepth=3).fit(rows)
    assert abs(right(fitted.transform(rows)) - right(other)) < 0.03


def test_first_tree_halves_the_squares_as_a_plain_search(rows, spark):
    """One round of depth one: the cut and the means on its sides are those of a search over all cuts."""
    fitted = boost.Boosted(featuresCol="scaled", maxIter=1, maxDepth=1, maxBins=255).fit(rows)
    table = rows.select("label", F.col("scaled")).collect()
    x, y = np.array([r.scaled.toArray() for r in table]), np.array([r.label for r in table])
    for c in range(3):
        side = np.where(y == c, 1.0, -1.0)
        best = max(
            (side[x[:, j] <= v].sum() ** 2 / (x[:, j] <= v).sum() + side[x[:, j] > v].sum() ** 2 / (x[:, j] > v).sum(), j, v)
            for j in range(4) for v in np.unique(x[:, j])[:-1]
        )
        low = x[:, best[1]] <= best[2]
        assert fitted.getOrDefault("feature")[c][1] == best[1]
        assert fitted.getOrDefault("value")[c] == pytest.approx([side[low].mean(), side[~low].mean()])


def test_margins_are_kept_between_rounds(rows, monkeypatch):
    whole = boost.Boosted(featuresCol="scaled", maxIter=6, maxDepth=2).fit(rows)
    monkeypatch.setattr(boost, "KEPT", 2)
    monkeypatch.setattr(boost, "ROWS", 100)  # and rows that are worked on in parts
    parts = boost.Boosted(featuresCol="scaled", maxIter=6, maxDepth=2).fit(rows)
    assert np.allclose(whole.getOrDefault("value"), parts.getOrDefault("value"), atol=1e-4)


def test_constant_features_and_a_saved_model(rows, spark, tmp_path):
    flat = rows.select("label", array_to_vector(F.array(F.lit(1.0), F.lit(2.0))).alias("scaled"))
    fitted = boost.Boosted(featuresCol="scaled", maxIter=2).fit(flat)
    assert fitted.transform(flat).select("prediction").distinct().count() == 1
    own = boost.Boosted(featuresCol="scaled", maxIter=3).fit(rows)
    own.write().save(str(tmp_path / "model"))
    again = boost.BoostedModel.load(str(tmp_path / "model"))
    assert own.transform(rows).select("prediction").collect() == again.transform(rows).select("prediction").collect()


def test_all_classes_share_the_passes_of_a_hundred_rounds(rows):
    """A level costs a pass, not a fit per class: hundreds of trees used to take minutes."""
    passes = []
    plain = boost._added

    def counted(*given):
        passes.append(1)
        return plain(*given)

    boost._added = counted
    try:
        started = time.time()
        fits = [(classify.boosted_model(False, rounds=20), rows), (classify.boosted_model(True, rounds=20), rows)]
        assert len(classify.fit_beside(fits)) == 2
    finally:
        boost._added = plain
    assert len(passes) <= 2 * 20 * 6 and time.time() - started < 120
