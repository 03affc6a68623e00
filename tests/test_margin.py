"""Large-margin classifiers: as little loss as Spark's, in a bounded number of passes for all classes together."""

import numpy as np
from pyspark.ml.classification import LinearSVC, OneVsRest
import pyarrow as pa
from pyspark.ml.functions import array_to_vector

from tillwise.ml import classify, margin, together
from tillwise.session import few_at_once


def drawn(spark, n=900):
    """Three classes that overlap, with unlike weights, a column far from zero and one without spread."""
    r = np.random.default_rng(11)
    y = r.choice(3, n, p=[0.7, 0.2, 0.1])
    x = np.column_stack([r.normal(size=(n, 3)) + 0.8 * np.eye(3)[y], r.normal(50, 20, n) + 5 * y, np.full(n, 4.0)])
    w = np.array([0.5, 1.5, 3.0])[y]
    rows = spark.createDataFrame([(list(map(float, a)), float(b), float(c)) for a, b, c in zip(x, y, w)], "x array<double>, label double, weight double")
    return rows.select(array_to_vector("x").alias("scaled"), "label", "weight"), x, y, w


def losses(x, y, w, coefficients, intercepts, penalty=0.001):
    means = w @ x / w.sum()
    spread = np.sqrt(w @ (x - means) ** 2 / (w.sum() - (w**2).sum() / w.sum()))
    margins = np.where(y[:, None] == np.arange(3), 1, -1) * (x @ coefficients.T + intercepts)
    return w @ np.maximum(0, 1 - margins) / w.sum() + penalty / 2 * ((coefficients * spread) ** 2).sum(axis=1)


def test_loss_is_no_more_than_that_of_the_built_in_machine(spark):
    df, x, y, w = drawn(spark)
    own = classify.margin_model().fit(df)
    found = losses(x, y, w, np.reshape(own.getOrDefault("coefficients"), (3, -1)), np.array(own.getOrDefault("intercepts")))
    machine = LinearSVC(featuresCol="scaled", labelCol="label", weightCol="weight", maxIter=60, regParam=0.001)
    other = OneVsRest(classifier=machine, featuresCol="scaled", labelCol="label", weightCol="weight").fit(df)
    built_in = losses(x, y, w, np.array([m.coefficients.toArray() for m in other.models]), np.array([m.intercept for m in other.models]))
    assert (found <= built_in * 1.0005).all()
    claimed = own.transform(df).groupBy("prediction").count().collect()
    margins = x @ np.reshape(own.getOrDefault("coefficients"), (3, -1)).T + own.getOrDefault("intercepts")
    assert {int(r["prediction"]): r["count"] for r in claimed} == dict(zip(*np.unique(margins.argmax(axis=1), return_counts=True)))


def test_classes_share_a_bounded_number_of_passes(spark):
    df = drawn(spark)[0].persist()
    context = spark.sparkContext
    context.setJobGroup("margin fit", "margin fit")
    try:
        classify.margin_model().fit(df)
        assert 0 < len(context.statusTracker().getJobIdsForGroup("margin fit")) < 200
    finally:
        context._jsc.clearJobGroup()
        df.unpersist()


def test_blocks_are_small_and_come_few_at_a_time(spark):
    """A task holds a hundred blocks while it writes, and a batch of them while it reads."""
    rows = spark.range(0, 6000, 1, 1).selectExpr("transform(sequence(1, 300), i -> cast(i * id as double)) as x", "0d as y", "1d as w")
    blocks = margin._blocks(rows, 300, 6000.0, np.zeros(300), np.ones(300))
    assert 100 * blocks.selectExpr("max(length(block)) as n").first().n < 64 << 20
    sums = together._pass(blocks, lambda x, _: [np.array([len(x), x[:, 0].sum(), x[:, -1].sum()])], np.add)[0]
    assert sums.tolist() == [6000, sum(range(6000)), np.float64(sums[2])] and abs(sums[2] - 1) < 1e-9

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with few_at_once(spark), few_at_once(spark):
        assert spark.range(0, 100, 1, 1).mapInArrow(sizes, "n long").selectExpr("max(n) as n").first().n == 16
    assert spark.conf.get(name) == before
