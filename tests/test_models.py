"""Models: metrics against formulas and brute force, gates, scoring, persistence."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tillwise import model
from tillwise.ml import classify, cluster, evaluate, prepare, promote, regress, score
from tillwise.ml.kernel import FourierMap
from tillwise.session import materialise

GATES = [
    ("classification", {"f1_macro": 0.50}, True),
    ("classification", {"f1_macro": 0.19}, False),
    ("classification", {"f1_macro": 0.20}, True),
    ("classification", {}, False),
    ("regression", {"r2_log_target": 0.94}, True),
    ("regression", {"r2_log_target": 0.10}, False),
    ("clustering", {"silhouette_score": 0.35}, True),
    ("clustering", {"silhouette_score": 0.05}, False),
]
RUN = "task STRING, version STRING, metric STRING, value DOUBLE"


@pytest.fixture(scope="module")
def features(tables):
    return materialise(tables.features, "features")


@pytest.fixture(scope="module")
def vectors(features):
    return prepare.fit_behaviour(features).transform(features).persist()


@pytest.mark.parametrize("task,metrics,passes", GATES)
def test_gates(spark, task, metrics, passes):
    rows = [(task, "1", name, value) for name, value in metrics.items()] or [(task, "1", "accuracy", 0.9)]
    got = promote.gated(spark.createDataFrame(rows, RUN)).first()
    assert got.passed is passes


def test_promotion_rules(spark):
    runs = spark.createDataFrame(
        [
            ("classification", "9", "f1_macro", 0.30), ("classification", "10", "f1_macro", 0.30),
            ("clustering", "1", "silhouette_score", 0.4), ("clustering", "2", "silhouette_score", 0.3),
            ("regression", "1", "r2_log_target", 0.94), ("regression", "2", "r2_log_target", 0.80),
        ],
        RUN,
    )
    champions = spark.createDataFrame([("classification", "9"), ("clustering", "1"), ("regression", "1")], "task STRING, version STRING")
    got = {r.task: (r.version, r.promoted, r.champion_after) for r in promote.promotions(runs, champions).collect()}
    assert got["classification"] == ("10", True, "10")  # a tie promotes; 10 is newer than 9
    assert got["clustering"] == ("2", False, "1")
    assert got["regression"] == ("2", False, "1")  # the comparison metric is absent
    none = spark.createDataFrame([], "task STRING, version STRING")
    first = {r.task: r.promoted for r in promote.promotions(runs, none).collect()}
    assert first == {"classification": True, "clustering": True, "regression": False}


def test_macro_f1_counts_labels_that_are_only_predicted(spark):
    rows = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "c"), ("c", "c")], "y STRING, p STRING")
    counts = evaluate.confusion(rows, "y", "p")
    got = evaluate.classification_metrics(counts).first()
    assert got.accuracy == pytest.approx(0.75)
    assert got.f1_macro == pytest.approx((2 / 3 + 0 + 1) / 3)
    assert got.f1_weighted == pytest.approx((2 / 3 * 2 + 1 * 2) / 4)


def test_silhouette_equals_brute_force(spark):
    random = np.random.default_rng(0)
    x = np.concatenate([random.normal(c, 1.0, (30, 2)) for c in (0, 4, 9)] + [[[50.0, 50.0]]])
    label = [0] * 30 + [1] * 30 + [2] * 30 + [3]
    frame = spark.createDataFrame(
        [(str(i), int(c), v.tolist()) for i, (c, v) in enumerate(zip(label, x))], "customer_id STRING, cluster INT, x ARRAY<DOUBLE>"
    ).withColumn("scaled", array_to_vector("x"))
    gaps = (np.linalg.norm(x[:, None] - x[None], axis=2)) ** 2
    label = np.array(label)
    want = []
    for i in range(len(x)):
        own = (label == label[i]).sum()
        if own == 1:
            want.append(0.0)
            continue
        inner = gaps[i][label == label[i]].sum() / (own - 1)
        outer = min(gaps[i][label == c].mean() for c in set(label) - {label[i]})
        want.append((outer - inner) / max(outer, inner))
    assert cluster.silhouette(frame) == pytest.approx(np.mean(want), abs=1e-6)


def test_elbow():
    ks = list(range(1, 11))
    assert cluster.elbow(ks, [1000, 400, 200, 150, 130, 120, 115, 112, 110, 109]) == 3
    assert cluster.elbow([2, 3], [2.0, 1.0]) is None


def test_segmentation(features):
    fitted, metrics = cluster.train_segmentation(features, restarts=2)
    assert -1 <= metrics["silhouette_score"] <= 1 and metrics["n_samples"] == features.count()
    assert score.predict_segment(fitted, features).select("cluster").distinct().count() == 6


def test_sweep_falls_and_choices_exist(vectors):
    swept = cluster.sweep(vectors, range(2, 5), restarts=1)
    inertia = [r.inertia for r in swept.orderBy("k").collect()]
    assert inertia == sorted(inertia, reverse=True)
    chosen = cluster.choose_k(swept, cluster.mixture_criteria(vectors, range(2, 4)))
    assert chosen["silhouette"] in (2, 3, 4) and chosen["bic"] in (2, 3)


def test_rules_name_the_columns(vectors):
    clustered = cluster.fit_kmeans(vectors, 3, restarts=1).transform(vectors)
    text, fidelity = cluster.cluster_rules(clustered)
    assert 60 < fidelity <= 100 and "feature " not in text
    assert any(c in text for c in model.BEHAVIOUR)


@pytest.fixture(scope="module")
def parts(features):
    return classify.prepare(features)


def test_weights_balance_the_classes(parts):
    train, _, _ = parts
    totals = [r.w for r in train.groupBy("label").agg(F.sum("weight").alias("w")).collect()]
    assert totals == pytest.approx([totals[0]] * len(totals))


def test_oversampling_reaches_parity_inside_the_class(parts):
    train, _, _ = parts
    made = classify.oversample(train).withColumn("x", vector_to_array("scaled"))
    sizes = {r["count"] for r in made.groupBy("label").count().collect()}
    assert len(sizes) == 1
    again = classify.oversample(train.repartition(3)).withColumn("x", vector_to_array("scaled"))
    key = F.array_join(F.transform("x", lambda v: F.round(v, 9).cast("string")), ",")
    total = F.sum(F.xxhash64(key).cast("decimal(30,0)"))
    assert made.agg(total).first()[0] == again.agg(total).first()[0]


def test_oversampling_cuts_every_class_alike(spark):
    rows = [(str(i), float(i % 34 // 20 + i % 34 // 32), [float(i), float(i * i % 97)]) for i in range(340)]  # 200, 120, 20
    train = spark.createDataFrame(rows, "customer_id STRING, label DOUBLE, x ARRAY<DOUBLE>").withColumn("scaled", array_to_vector("x"))
    made = classify.oversample(train, cap=50)
    got = {(r.label, r.synthetic): r["count"] for r in made.groupBy("label", "synthetic").count().collect()}
    assert got == {(0.0, False): 50, (1.0, False): 50, (2.0, False): 20, (2.0, True): 30}
    whole = {r.label: r["count"] for r in classify.oversample(train).groupBy("label").count().collect()}
    assert set(whole.values()) == {200}


def test_too_small_class_is_an_error(spark):
    rows = [(str(i), 0.0 if i < 20 else 1.0, [float(i), 0.0]) for i in range(23)]
    train = spark.createDataFrame(rows, "customer_id STRING, label DOUBLE, x ARRAY<DOUBLE>").withColumn(
        "scaled", array_to_vector("x")
    )
    with pytest.raises(ValueError, match="needed"):
        classify.oversample(train)


def test_neighbour_votes_ask_all_training_rows(spark):
    """More rows than any sample of 50 000: the nearest is always the row beside."""
    rows = spark.range(60_000).select(
        F.col("id").cast("string").alias("customer_id"), (F.col("id") % 3).cast("double").alias("label"), F.array(F.col("id").cast("double")).alias("x")
    )
    train = rows.withColumn("scaled", array_to_vector("x"))
    test = train.where("CAST(customer_id AS long) % 300 = 7")
    assert classify.neighbour_votes(train, test, k=1).where("label = prediction").count() == 200
    some = classify.neighbour_votes(train, test, k=1, cap=100)
    assert some.count() == 200 and some.where("label = prediction").count() < 200


def test_neighbour_votes_find_separate_groups(spark):
    rows = [(str(i), float(i % 2), [100.0 * (i % 2) + i * 0.01, 0.0]) for i in range(60)]
    frame = spark.createDataFrame(rows, "customer_id STRING, label DOUBLE, x ARRAY<DOUBLE>").withColumn(
        "scaled", array_to_vector("x")
    )
    got = classify.neighbour_votes(frame, frame)
    assert got.count() == 60 and got.where("label != prediction").isEmpty()


@pytest.fixture(scope="module")
def status(features):
    return classify.train_status(features, trees=10, depth=6)


def test_status_probabilities_and_persistence(features, status, tmp_path):
    fitted, metrics = status
    assert 0 <= metrics["f1_macro"] <= 1 and metrics["n_train"] + metrics["n_test"] == features.count()
    path = str(tmp_path / "status")
    score.save(fitted, path)
    rows = score.predict_status(score.load(path), features.limit(50)).collect()
    assert len(rows) == 50
    for r in rows:
        assert sum(r.probabilities.values()) == pytest.approx(1.0)
        assert r.predicted_status == max(r.probabilities, key=r.probabilities.get)


def test_spend_model_and_unseen_levels(spark, features):
    fitted, metrics = regress.train_spend(features, rounds=5, depth=3)
    assert metrics["r2_log_target"] > 0.5 and metrics["n_train"] + metrics["n_test"] == features.count()
    odd = features.limit(1).withColumn("age_group", F.lit("26-35")).withColumn("club_member_status", F.lit("it's new"))
    assert score.predict_spend(fitted, odd).first().predicted_total_spend > 0


def test_regression_metrics(spark):
    rows = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.5)], "log_spend DOUBLE, prediction DOUBLE")
    got = evaluate.regression_metrics(rows).first()
    y, p = np.array([1.0, 2.0, 3.0]), np.array([1.5, 2.0, 2.5])
    gap = np.expm1(p) - np.expm1(y)
    assert got.rmse == pytest.approx(np.sqrt((gap**2).mean())) and got.mae == pytest.approx(np.abs(gap).mean())
    assert got.r2_log_target == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_profiles(spark):
    fields = ", ".join(f"{c} DOUBLE" for c in model.BEHAVIOUR)
    good = (34.0, 27.0, 540.0, 6.0, 42.5, 1.8, 12.0)
    rows = spark.createDataFrame([good, (-5.0, *good[1:]), (None, *good[1:6], None), (121.0, *good[1:])], fields)
    ok, bad = score.split_profiles(rows, model.BEHAVIOUR)
    assert ok.count() == 1
    reasons = sorted((tuple(r.missing), tuple(r.out_of_range)) for r in bad.collect())
    assert reasons == [((), ("age",)), ((), ("age",)), (("age", "recency_days"), ())]


def test_scoring_limit_and_sums(features, status):
    segment, _ = cluster.train_segmentation(features, restarts=1)
    spend, _ = regress.train_spend(features, rounds=3, depth=3)
    scored = score.score_customers(features, status[0], segment, spend, limit=100)
    row = score.summarise(scored, {"classification": "3"}).first()
    assert row.n_customers_scored == 100
    assert sum(row.club_status_distribution.values()) == sum(row.segment_distribution.values()) == 100
    assert row.club_status_distribution[row.dominant_club_status] == max(row.club_status_distribution.values())
    assert row.model_versions == {"classification": "3"}


@pytest.fixture()
def linear(spark):
    random = np.random.default_rng(2)
    x = random.normal(size=(80, 4))
    y = x @ [3.0, -6.0, 1.5, 0.0] + random.normal(size=80) * 0.5
    frame = spark.createDataFrame([(v.tolist(), float(t)) for v, t in zip(x, y)], "x ARRAY<DOUBLE>, log_spend DOUBLE")
    frame = frame.withColumn("scaled", array_to_vector("x"))
    fitted = {name: m.fit(frame).coefficients.toArray() for name, m in regress.linear_models(frame).items()}
    return x - x.mean(axis=0), y - y.mean(), fitted


def test_ridge_matches_its_closed_form(linear):
    x, y, fitted = linear
    assert np.allclose(fitted["ridge"], np.linalg.solve(x.T @ x + np.eye(4), x.T @ y), atol=1e-6)
    assert np.allclose(fitted["least squares"], np.linalg.lstsq(x, y, rcond=None)[0], atol=1e-6)


@pytest.mark.parametrize("name,a,b", [("lasso", 0.01, 0.0), ("elastic net", 0.005, 0.005)])
def test_penalised_models_meet_their_optimality_conditions(linear, name, a, b):
    x, y, fitted = linear
    w = fitted[name]
    pull = x.T @ (y - x @ w) / len(y) - b * w
    for value, slope in zip(w, pull):
        assert abs(slope - a * np.sign(value)) < 1e-4 if abs(value) > 1e-9 else abs(slope) <= a + 1e-4


def test_backward_elimination_and_drift_run_on_features(features):
    from tillwise.operators import drift

    same = drift.drift_summary(drift.drift_report(features, features, model.BEHAVIOUR, model.SPEND_CATEGORICAL)).first()
    assert same.n_drifted == 0 and not same.alert and same.n_columns == 10
    moved = features.withColumns({c: F.col(c) * 2 + 5 for c in model.BEHAVIOUR})
    assert drift.drift_summary(drift.drift_report(features, moved, model.BEHAVIOUR, [])).first().alert


def scaled_rows(spark, rows):
    arrays = [(i, [float(v) for v in x]) for i, x in enumerate(rows)]
    return spark.createDataFrame(arrays, "id INT, v ARRAY<DOUBLE>").select("id", array_to_vector("v").alias("scaled"))


def plain_ward(rows, k):
    groups = [[tuple(r)] for r in rows]

    def spread(group):
        at = np.array(group)
        return ((at - at.mean(axis=0)) ** 2).sum()

    costs = []
    while len(groups) > 1:
        best = min(
            (spread(a + b) - spread(a) - spread(b), i, j)
            for i, a in enumerate(groups)
            for j, b in enumerate(groups)
            if i < j
        )
        costs.append(best[0])
        groups[best[1]] += groups.pop(best[2])
        if len(groups) == k:
            found = [sorted(g) for g in groups]
    return sorted(found), costs


def test_ward_equals_brute_force(spark):
    r = np.random.default_rng(4)
    rows = np.concatenate([r.normal(c, 0.4, (12, 3)) for c in (-2, 0, 1.5)])
    rows = np.concatenate([rows, rows[:5]])  # repeated rows weigh twice
    df = scaled_rows(spark, rows)
    labelled, costs = cluster.ward_segments(df, 5)
    got = {}
    for row in labelled.collect():
        got.setdefault(row["cluster"], []).append(tuple(row["scaled"]))
    want, plain = plain_ward(rows.tolist(), 5)
    assert sorted(sorted(g) for g in got.values()) == want
    assert costs == sorted(costs) and np.allclose(costs, [c for c in plain if c > 1e-12][-len(costs) :])


def test_ward_over_few_sums_of_many_rows(spark):
    r = np.random.default_rng(5)
    centres = np.array([(-4, 0), (4, 0), (0, 5)])
    rows = np.concatenate([r.normal(c, 0.3, (500, 2)) for c in centres])
    df = scaled_rows(spark, rows)
    cells, _ = cluster.cluster_features(df, 40)
    assert cells.count() <= 40 and cells.agg(F.sum("n")).first()[0] == 1500
    labelled, _ = cluster.ward_segments(df, 3, 40)
    pairs = labelled.select((F.col("id") / 500).cast("int").alias("of"), "cluster").distinct()
    assert pairs.count() == 3 and pairs.select("cluster").distinct().count() == 3


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_tree_splits_centred_columns(spark, partitions):
    r = np.random.default_rng(6)
    rows = r.normal(size=(150, 7))
    rows = (rows - rows.mean(axis=0)) / rows.std(axis=0)
    df = scaled_rows(spark, rows).repartition(partitions)
    assert cluster.fit_bisecting(df, 6).transform(df).select("cluster").distinct().count() == 6


@pytest.mark.parametrize("features", [64, 1024])
def test_fourier_map_approaches_the_kernel(spark, features):
    r = np.random.default_rng(7)
    rows = r.normal(size=(60, 4))
    mapped = FourierMap(inputCol="scaled", outputCol="f", width=4, features=features, gamma=0.3).transform(scaled_rows(spark, rows))
    got = np.array([x["f"].toArray() for x in mapped.orderBy("id").collect()])
    kernel = np.exp(-0.3 * ((rows[:, None] - rows[None]) ** 2).sum(axis=2))
    off = (got @ got.T - kernel)[np.triu_indices(60, 1)]
    assert np.sqrt((off**2).mean()) <= 1.2 / np.sqrt(features)


def test_kernel_margin_separates_rings(spark, tmp_path):
    r = np.random.default_rng(8)
    angle, ring = r.uniform(0, 2 * np.pi, 400), np.arange(400) % 2
    at = np.stack([np.cos(angle), np.sin(angle)], axis=1) * np.where(ring, 2.0, 0.7)[:, None] + r.normal(0, 0.1, (400, 2))
    df = scaled_rows(spark, at).withColumn("label", (F.col("id") % 2).cast("double")).withColumn("weight", F.lit(1.0))
    right = lambda fitted: fitted.transform(df).where("prediction = label").count() / 400
    assert right(classify.margin_model().fit(df)) < 0.75
    fitted = classify.kernel_margin_model(2, 128).fit(df)
    assert right(fitted) > 0.98
    fitted.write().overwrite().save(str(tmp_path / "kernel"))
    assert right(PipelineModel.load(str(tmp_path / "kernel"))) == right(fitted)
