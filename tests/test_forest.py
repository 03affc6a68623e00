"""Forests grown in tasks: against Spark's, over several pieces, and after storing."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tillwise.ml import classify, forest

COMMON = {"featuresCol": "scaled", "labelCol": "label", "weightCol": "weight"}


def frame(spark, x, y, w=None):
    w = np.ones(len(y)) if w is None else w
    rows = [(i, v.tolist(), float(c), float(g)) for i, (v, c, g) in enumerate(zip(x, y, w))]
    return spark.createDataFrame(rows, "id LONG, x ARRAY<DOUBLE>, label DOUBLE, weight DOUBLE").select(
        "id", array_to_vector("x").alias("scaled"), "label", "weight"
    )


@pytest.fixture(scope="module")
def boxes(spark):
    """Three classes in boxes that a tree can tell apart."""
    random = np.random.default_rng(3)
    x = random.integers(0, 20, (3000, 4)).astype(float)
    y = np.where(x[:, 0] > 9, 0, np.where(x[:, 1] > 4, 1, 2))
    return frame(spark, x, y, np.where(y == 2, 3.0, 1.0)), x, y


def right(predicted):
    return predicted.where("label = prediction").count() / predicted.count()


def test_one_tree_predicts_as_sparks(spark):
    random = np.random.default_rng(5)
    x = random.integers(0, 12, (800, 3)).astype(float)
    y = (x[:, 0] * x[:, 1] + random.normal(0, 8, 800) > 30).astype(int)
    rows = frame(spark, x, y, random.uniform(0.5, 2, 800))
    options = {"maxDepth": 4, "minInstancesPerNode": 7, **COMMON}
    ours = forest.Forest(numTrees=1, **options).fit(rows).transform(rows)
    theirs = DecisionTreeClassifier(**options).fit(rows).transform(rows)
    share = lambda df: np.array([r.probability.toArray() for r in df.orderBy("id").collect()])
    assert np.allclose(share(ours), share(theirs), atol=1e-6)


def test_forest_is_about_as_right_as_sparks(spark):
    random = np.random.default_rng(7)
    x = random.normal(size=(1500, 7))
    y = (x[:, 0] ** 2 + x[:, 1] + random.normal(0, 0.5, 1500) > 1).astype(int)
    train, test = frame(spark, x[:1000], y[:1000]), frame(spark, x[1000:], y[1000:])
    ours = right(forest.Forest(numTrees=30, maxDepth=10, seed=1, **COMMON).fit(train).transform(test))
    theirs = right(RandomForestClassifier(numTrees=30, maxDepth=10, seed=1, **COMMON).fit(train).transform(test))
    assert ours > 0.8 and abs(ours - theirs) < 0.05


@pytest.mark.parametrize("piece,block,slots", [(200, 256, 3), (1 << 17, 1 << 16, 1 << 14)])
def test_pieces_make_whole_trees(boxes, monkeypatch, piece, block, slots):
    rows, x, y = boxes
    monkeypatch.setattr(forest, "PIECE", piece)
    monkeypatch.setattr(forest, "BLOCK", block)
    monkeypatch.setattr(forest, "SLOTS", slots)
    fitted = forest.Forest(numTrees=1, maxDepth=20, **COMMON).fit(rows)
    scored = fitted.transform(rows)
    assert scored.count() == len(y) and right(scored) == 1
    several = forest.Forest(numTrees=6, maxDepth=20, **COMMON).fit(rows)
    assert right(several.transform(rows)) > 0.99
    upper = [r.n for r in several.pieces.where("piece = 0").select(F.length("feature").alias("n")).collect()]
    assert len(upper) == 6 and all((n > 1) == (piece == 200) for n in upper)


def test_every_row_counts_and_depth_and_leaf_hold(boxes, monkeypatch):
    rows, _, _ = boxes
    monkeypatch.setattr(forest, "PIECE", 300)
    monkeypatch.setattr(forest, "BLOCK", 128)
    stump = forest.Forest(numTrees=1, maxDepth=1, **COMMON).fit(rows).transform(rows)
    assert stump.select("probability").distinct().count() == 2
    leaf = forest.Forest(numTrees=1, maxDepth=20, minInstancesPerNode=400, **COMMON).fit(rows).transform(rows)
    assert leaf.groupBy("probability").count().agg(F.min("count")).first()[0] >= 400
    none = forest.Forest(numTrees=3, maxDepth=0, **COMMON).fit(rows).transform(rows)
    assert none.select("probability").distinct().count() == 1


def test_odd_rows(spark):
    constant = frame(spark, np.ones((40, 3)), np.arange(40) % 2)
    got = forest.Forest(numTrees=3, **COMMON).fit(constant).transform(constant)
    assert got.count() == 40 and got.select("probability").distinct().count() == 1
    twice = constant.unionByName(constant)  # rows need no key
    assert forest.Forest(numTrees=3, **COMMON).fit(twice).transform(twice).count() == 80
    fitted = forest.Forest(numTrees=2, **COMMON).fit(constant)
    assert fitted.transform(constant.limit(0)).count() == 0
    with pytest.raises(ValueError):
        forest.Forest(numTrees=2, **COMMON).fit(constant.limit(0))


def test_stored_forest_scores_as_before(boxes, tmp_path):
    rows, _, _ = boxes
    fitted = PipelineModel([forest.Forest(numTrees=5, maxDepth=8, seed=3, **COMMON).fit(rows)])
    path = str(tmp_path / "model")
    fitted.write().overwrite().save(path)
    before, after = fitted.transform(rows), PipelineModel.load(path).transform(rows)
    both = before.select("id", F.col("probability").alias("a")).join(after.select("id", F.col("probability").alias("b")), "id")
    assert both.count() == rows.count() and both.where("a != b").isEmpty()


def test_status_forests_stay_out_of_the_driver():
    assert isinstance(classify.forest(), forest.Forest)
    assert isinstance(classify.balanced_models()["forest"], forest.Forest)
