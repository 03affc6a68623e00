"""Model queries. Fits are checked by their properties; closed forms by SQL."""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window, functions as F

from tillwise import model
from tillwise.catalog.base import query, view
from tillwise.ml import classify, cluster, evaluate, prepare, promote, regress, score
from tillwise.session import materialise, new_path


def _features(t):
    return materialise(t.features, "features")


def _vectors(t):
    rows = _features(t)
    return prepare.fit_behaviour(rows).transform(rows)


# Fits draw at random, so these queries return what holds of every right fit.
view(
    "trainsize",
    """SELECT club_member_status, COUNT(*) - (COUNT(*) * 4 + 10) // 20 AS n, (COUNT(*) * 4 + 10) // 20 AS n_test
  FROM feat WHERE club_member_status IS NOT NULL GROUP BY 1""",
)
view(
    "sizes",
    """SELECT COUNT(*) AS n, (SELECT CAST(SUM(n) AS BIGINT) FROM trainsize) AS n_train,
  (SELECT CAST(SUM(n_test) AS BIGINT) FROM trainsize) AS n_test FROM feat""",
)


def _shares(*columns):
    """All of them lie between 0 and 1."""
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).between(0, 1)
    return whole


def _scored(rows):
    return rows.select("model", "n", _shares("accuracy", "f1_macro", "f1_weighted").alias("scores_are_shares"))


def _scored_sql(*names):
    listed = ", ".join(f"('{n}')" for n in names)
    return f"SELECT model, n_test AS n, true AS scores_are_shares FROM sizes, (VALUES {listed}) m(model)"


@query(
    "m01_standardised",
    "SELECT customer_id, "
    + ", ".join(f"round(({c} - AVG({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in model.BEHAVIOUR)
    + " FROM feat",
)
def m01(t):
    values = _vectors(t).select("customer_id", vector_to_array("scaled").alias("v"))
    return values.select("customer_id", *[F.round(F.col("v")[i], 6).alias(c) for i, c in enumerate(model.BEHAVIOUR)])


@query(
    "m02_components",
    "SELECT n, true AS uncorrelated, true AS shares_are_variances, true AS three_hold_more FROM sizes",
)
def m02(t):
    vectors = _vectors(t)
    two, shares_2 = cluster.principal_components(vectors, 2)
    _, shares_3 = cluster.principal_components(vectors, 3)
    v = vector_to_array("components")
    projected = two.select(v[0].alias("a"), v[1].alias("b"))
    of_all = [F.var_pop(c) / len(model.BEHAVIOUR) for c in ("a", "b")]  # standardised columns have variance 1
    return projected.agg(
        F.count("*").alias("n"),
        (F.abs(F.corr("a", "b")) < 1e-6).alias("uncorrelated"),
        ((F.abs(of_all[0] - shares_2[0]) < 1e-6) & (F.abs(of_all[1] - shares_2[1]) < 1e-6)).alias("shares_are_variances"),
        F.lit(sum(shares_2) <= sum(shares_3) <= 1 + 1e-9).alias("three_hold_more"),
    )


@query(
    "m03_kmeans_sweep",
    "SELECT k, true AS inertia_of_labels, true AS less_than_before, true AS silhouette_in_range FROM range(2, 11) r(k)",
)
def m03(t):
    vectors = _vectors(t).persist()
    try:
        # around one centre, standardised columns have a sum of squares of 1 per row and column
        whole = vectors.count() * len(model.BEHAVIOUR)
        swept = cluster.sweep(vectors, range(2, 11))
    finally:
        vectors.unpersist()
    before = F.coalesce(F.lag("inertia").over(Window.orderBy("k")), F.lit(float(whole)))  # nine rows
    return swept.select(
        "k",
        # the cost is measured before the centres move for the last time
        (F.abs(F.col("inertia") - F.col("within")) <= 0.01 * F.col("within")).alias("inertia_of_labels"),
        (F.col("inertia") < before).alias("less_than_before"),
        F.col("silhouette").between(-1, 1).alias("silhouette_in_range"),
    )


@query(
    "m04_choice_of_k",
    "SELECT unnest(['elbow', 'silhouette', 'bic', 'aic']) AS criterion, true AS is_best",
)
def m04(t):
    vectors = _vectors(t).persist()
    try:
        swept = cluster.sweep(vectors, range(2, 11))
        criteria = cluster.mixture_criteria(vectors, range(2, 11))
        chosen = cluster.choose_k(swept, criteria)
    finally:
        vectors.unpersist()
    best = swept.join(criteria, "k").agg(
        F.max_by("k", "silhouette").alias("silhouette"), F.min_by("k", "bic").alias("bic"), F.min_by("k", "aic").alias("aic")
    ).first()
    right = {c: chosen[c] == best[c] for c in ("silhouette", "bic", "aic")}
    right["elbow"] = chosen["elbow"] is None or 2 < chosen["elbow"] < 10  # never an end of the curve
    return t.spark.createDataFrame(list(right.items()), "criterion STRING, is_best BOOLEAN")


@query(
    "m05_mixture_criteria",
    # weights, means and covariances of k components in 7 columns
    "SELECT k, k - 1 + k * 7 + k * 28 AS n_parameters FROM range(2, 11) r(k)",
)
def m05(t):
    """The two criteria differ by (ln n - 2) per free parameter."""
    vectors = _vectors(t).persist()
    try:
        n = vectors.count()
        criteria = cluster.mixture_criteria(vectors, range(2, 11))
    finally:
        vectors.unpersist()
    free = F.round((F.col("bic") - F.col("aic")) / (math.log(n) - 2)).cast("bigint")
    return criteria.select("k", free.alias("n_parameters"))


def _clustered(t, k=6):
    vectors = _vectors(t)
    return cluster.fit_kmeans(vectors, k).transform(vectors)


@query(
    "m06_cluster_by_segment",
    "SELECT CAST(6 AS BIGINT) AS n_clusters, "
    + ", ".join(f"COUNT(*) FILTER (value_segment = '{s}') AS \"{s}\"" for s in model.SEGMENTS)
    + " FROM feat",
)
def m06(t):
    """Over all clusters, the counts are those of the segments."""
    crossed = cluster.cross_segments(_clustered(t))
    return crossed.agg(F.count("*").alias("n_clusters"), *[F.sum(f"`{s}`").alias(s) for s in model.SEGMENTS])


_Z = ", ".join(
    f"round((m_{c} - AVG(m_{c}) OVER ()) / stddev_samp(m_{c}) OVER (), 6) AS z_{c}, round(m_{c}, 6) AS {c}" for c in model.BEHAVIOUR
)
_M = ", ".join(f"AVG(coalesce({c}, 0)::DOUBLE) AS m_{c}" for c in model.BEHAVIOUR)


@query(
    "m07_cluster_profile",
    f"SELECT value_segment, n_customers, {_Z} FROM (SELECT value_segment, COUNT(*) AS n_customers, {_M} FROM feat GROUP BY 1)",
)
def m07(t):
    """The value segments in the role of the clusters."""
    profile = cluster.cluster_profile(_features(t), "value_segment")
    return profile.select(
        "value_segment",
        "n_customers",
        *[F.round(p + c, 6).alias(p + c) for c in model.BEHAVIOUR for p in ("z_", "")],
    )


@query(
    "m08_cluster_rules",
    "SELECT true AS above_largest_cluster, true AS names_columns",
)
def m08(t):
    """The rules retell at least the share of the largest cluster, in the names of the raw columns."""
    clustered = _clustered(t).persist()
    try:
        text, fidelity = cluster.cluster_rules(clustered)
        largest = clustered.groupBy("cluster").count().agg(F.max("count") / F.sum("count")).first()[0]
    finally:
        clustered.unpersist()
    named = "feature " not in text and any(c in text for c in model.BEHAVIOUR)
    return t.spark.createDataFrame(
        [(100 * largest - 1e-9 <= fidelity <= 100, named)], "above_largest_cluster BOOLEAN, names_columns BOOLEAN"
    )


@query(
    "m09_segmentation",
    """SELECT CAST(6 AS BIGINT) AS k, n AS n_samples, CAST(6 AS BIGINT) AS n_labels, true AS silhouette_in_range, true AS inertia_of_labels,
  true AS less_than_two_thirds FROM sizes""",
)
def m09(t):
    """The model, applied to the features anew, gives the sum of squares that its metrics tell."""
    rows = _features(t)
    fitted, metrics = cluster.train_segmentation(rows)
    labelled = fitted.transform(rows)
    spread, n = cluster.within(labelled), metrics["n_samples"]
    row = (
        metrics["k"],
        n,
        labelled.select("cluster").distinct().count(),
        -1 <= metrics["silhouette_score"] <= 1,
        abs(spread - metrics["inertia"]) <= 0.01 * spread,
        spread < n * len(model.BEHAVIOUR) * 2 / 3,  # one cluster has n times the columns
    )
    kinds = "k INT, n_samples BIGINT, n_labels BIGINT, silhouette_in_range BOOLEAN, inertia_of_labels BOOLEAN, less_than_two_thirds BOOLEAN"
    return t.spark.createDataFrame([row], kinds)


@query(
    "m10_segment_tree",
    """SELECT m.model, CAST(6 AS BIGINT) AS n_clusters, n, true AS explains_its_part
  FROM sizes, (VALUES ('k-means'), ('mixture'), ('tree'), ('ward')) m(model)""",
)
def m10(t):
    vectors = _vectors(t).persist()
    try:
        compared = cluster.compare_segmentations(vectors)
    finally:
        vectors.unpersist()
    whole = F.col("n") * len(model.BEHAVIOUR)  # one cluster's sum of squares
    # a mixture does not look for small sums of squares; the others must explain a third
    most = F.when(F.col("model") == "mixture", whole).otherwise(whole * 2 / 3)
    explained = (F.col("within") < most) & (F.col("within") > 0)
    return compared.select("model", "n_clusters", "n", explained.alias("explains_its_part"))


@query(
    "m11_status_forest",
    "SELECT n_train, n_test, true AS scores_are_shares FROM sizes",
)
def m11(t):
    _, metrics = classify.train_status(_features(t))
    return t.spark.createDataFrame([metrics]).select(
        "n_train", "n_test", _shares("accuracy", "f1_macro").alias("scores_are_shares")
    )


@query("m12_status_models", _scored_sql("logistic", "tree", "forest"))
def m12(t):
    train, test, _ = classify.prepare(_features(t))
    models = classify.balanced_models()
    return _scored(classify.compare(train, test, models))


view(
    "parted",
    """SELECT *, row_number() OVER (PARTITION BY club_member_status ORDER BY md5(customer_id || '|42'), customer_id) - 1
   < (COUNT(*) OVER (PARTITION BY club_member_status) * 4 + 10) // 20 AS held_out FROM feat WHERE club_member_status IS NOT NULL""",
)
_X = [f"coalesce({c}::DOUBLE, 0)" for c in model.BEHAVIOUR]
view(
    "scaledrows",
    "SELECT customer_id, club_member_status AS label, held_out, ["
    + ", ".join(f"({x} - AVG({x}) FILTER (NOT held_out) OVER ()) / stddev_pop({x}) FILTER (NOT held_out) OVER ()" for x in _X)
    + "] AS x FROM parted",
)
view(
    "nearrows",
    """SELECT a.customer_id, a.label, b.label AS near_label,
  row_number() OVER (PARTITION BY a.customer_id ORDER BY round(pow(list_distance(a.x, b.x), 2), 9), b.customer_id) AS place
  FROM scaledrows a, scaledrows b WHERE a.held_out AND NOT b.held_out""",
)
view(
    "voted",
    """SELECT customer_id, label, arg_min(near_label, (-n, near_label)) AS predicted FROM (
  SELECT customer_id, label, near_label, COUNT(*) AS n FROM nearrows WHERE place <= 5 GROUP BY ALL) GROUP BY ALL""",
)
view(
    "votedclass",
    """SELECT coalesce(hit, 0) AS hit, coalesce(support, 0) AS support, coalesce(claimed, 0) AS claimed FROM (
  SELECT label, COUNT(*) AS support, COUNT(*) FILTER (label = predicted) AS hit FROM voted GROUP BY 1)
  FULL JOIN (SELECT predicted AS label, COUNT(*) AS claimed FROM voted GROUP BY 1) USING (label)""",
)


@query(
    "m13_neighbour_votes",
    """SELECT 'neighbours' AS model, round(SUM(hit)::DOUBLE / SUM(support), 9) AS accuracy, round(AVG(2 * hit::DOUBLE / (claimed + support)), 9) AS f1_macro,
  round(SUM(2 * hit::DOUBLE / (claimed + support) * support) / SUM(support), 9) AS f1_weighted, CAST(SUM(support) AS BIGINT) AS n FROM votedclass""",
)
def m13(t):
    train, test, _ = classify.prepare(_features(t))
    scores = classify.evaluate_on(test, "neighbours", classify.neighbour_votes(train, test))
    return scores.select("model", *[F.round(c, 9).alias(c) for c in ("accuracy", "f1_macro", "f1_weighted")], "n")


@query("m14_margin_model", _scored_sql("margin", "kernel margin"))
def m14(t):
    train, test, _ = classify.prepare(_features(t))
    kernel = classify.kernel_margin_model(len(model.BEHAVIOUR))
    return _scored(classify.compare(train, test, {"margin": classify.margin_model(), "kernel margin": kernel}))


def _searched(t, name, grid):
    """Test scores of the best setting, whether it is one of the grid, and its validated score."""
    train, test, _ = classify.prepare(_features(t))
    fitted, chosen, best = classify.grid_search(train, classify.balanced_models()[name], grid)
    scores = _scored(classify.evaluate_on(test, f"tuned {name}", fitted.transform(test)))
    return scores.withColumns(
        {
            "of_grid": F.lit(all(chosen[c] in values for c, values in grid.items())),
            "cv_is_share": F.lit(0 <= float(best) <= 1),
        }
    )


# depth 30 is the deepest tree that Spark grows: the setting without a limit
@query("m15_grid_search", "SELECT *, true AS of_grid, true AS cv_is_share FROM (" + _scored_sql("tuned tree") + ")")
def m15(t):
    return _searched(t, "tree", {"maxDepth": [5, 10, 15, 30], "minInstancesPerNode": [1, 5, 10]})


@query(
    "m16_oversampled_classes",
    """SELECT club_member_status, CAST(n AS BIGINT) AS n_real, CAST((SELECT MAX(n) FROM trainsize) AS BIGINT) AS n_after,
  true AS inside_hull FROM trainsize""",
)
def m16(t):
    train, _, prepared = classify.prepare(_features(t))
    made = classify.oversample(train).withColumn("x", vector_to_array("scaled"))
    # a point between two rows of a class stays inside the class's box
    def box(real):
        side = F.when(~F.col("synthetic"), F.col("x")) if real else F.col("x")
        return [F.min(side[i]) for i in range(7)], [F.max(side[i]) for i in range(7)]

    low, high = box(True)
    all_low, all_high = box(False)
    inside = F.lit(True)
    for i in range(7):
        inside = inside & (all_low[i] >= low[i] - 1e-9) & (all_high[i] <= high[i] + 1e-9)
    names = F.array(*[F.lit(v) for v in prepared.stages[-1].labels])
    return made.groupBy("label").agg(
        F.count_if(~F.col("synthetic")).alias("n_real"), F.count("*").alias("n_after"), inside.alias("inside_hull")
    ).select(F.get(names, F.col("label").cast("int")).alias("club_member_status"), "n_real", "n_after", "inside_hull")


@query("m17_boosted_status", _scored_sql("weighted", "oversampled"))
def m17(t):
    train, test, _ = classify.prepare(_features(t))
    fits = [(classify.boosted_model(True), train), (classify.boosted_model(False), classify.oversample(train))]
    weighted, raised = classify.fit_beside(fits)
    both = classify.evaluate_on(test, "weighted", weighted.transform(test)).unionByName(
        classify.evaluate_on(test, "oversampled", raised.transform(test))
    )
    return _scored(both)


# rule-based predictions, the same in both engines: status by number of purchases
RULE = "CASE WHEN n_transactions >= 42 THEN 'ACTIVE' WHEN n_transactions >= 30 THEN 'PRE-CREATE' ELSE 'LEFT CLUB' END"
view("ruled", f"SELECT club_member_status AS label, {RULE} AS predicted, total_spend, value_segment FROM feat")
view(
    "perclass",
    """SELECT label, hit, support, claimed FROM (SELECT label, COUNT(*) AS support, COUNT(*) FILTER (label = predicted) AS hit FROM ruled GROUP BY 1)
  FULL JOIN (SELECT predicted AS label, COUNT(*) AS claimed FROM ruled GROUP BY 1) USING (label)""",
)


def _ruled(t):
    return _features(t).select(
        F.col("club_member_status").alias("label"), F.expr(RULE).alias("predicted"), "total_spend", "value_segment"
    )


@query("m18_confusion", "SELECT label, predicted, COUNT(*) AS n FROM ruled GROUP BY ALL")
def m18(t):
    return evaluate.confusion(_ruled(t), "label", "predicted")


@query(
    "m18_class_report",
    """SELECT label, hit::DOUBLE / claimed AS precision, hit::DOUBLE / support AS recall,
  2 * hit::DOUBLE / (claimed + support) AS f1, support FROM perclass""",
)
def m18_report(t):
    return evaluate.class_report(evaluate.confusion(_ruled(t), "label", "predicted"))


@query(
    "m18_metrics",
    """SELECT round(SUM(hit)::DOUBLE / SUM(support), 9) AS accuracy, round(AVG(2 * hit::DOUBLE / (claimed + support)), 9) AS f1_macro,
  round(SUM(2 * hit::DOUBLE / (claimed + support) * support) / SUM(support), 9) AS f1_weighted, CAST(SUM(support) AS BIGINT) AS n FROM perclass""",
)
def m18_metrics(t):
    scores = evaluate.classification_metrics(evaluate.confusion(_ruled(t), "label", "predicted"))
    return scores.select(*[F.round(c, 9).alias(c) for c in ("accuracy", "f1_macro", "f1_weighted")], "n")


@query(
    "m19_spend_columns",
    """SELECT customer_id, age, (club_member_status = 'PRE-CREATE')::INT::DOUBLE AS pre_create,
  (fashion_news_frequency = 'NONE')::INT::DOUBLE AS news_none, (age_group = '70+')::INT::DOUBLE AS age_70,
  CAST(6 + 2 + 2 + 8 AS BIGINT) AS n_columns FROM feat""",
)
def m19(t):
    rows = _features(t)
    stages, columns = prepare.fit_spend_columns(rows)
    encoded = PipelineModel(stages).transform(rows)
    return encoded.select(
        "customer_id",
        F.col("x_age").alias("age"),
        F.col("x_club_member_status_PRE-CREATE").alias("pre_create"),
        F.col("x_fashion_news_frequency_NONE").alias("news_none"),
        F.col("x_age_group_70+").alias("age_70"),
        F.lit(len(columns)).alias("n_columns"),
    )


@query(
    "m20_linear_models",
    """SELECT unnest(['least squares', 'lasso', 'ridge', 'elastic net']) AS model, true AS rmse_not_below_mae, true AS r2_at_most_one""",
)
def m20(t):
    train, test = regress.split(_features(t))
    inputs, _ = regress.fit_inputs(train)
    compared = regress.compare(inputs.transform(train), inputs.transform(test), regress.linear_models(train))
    return compared.select(
        "model",
        (F.col("rmse") >= F.col("mae")).alias("rmse_not_below_mae"),
        ((F.col("r2_log_target") <= 1) & (F.col("cv_r2") <= 1)).alias("r2_at_most_one"),
    )


@query(
    "m20_normal_equations",
    "SELECT n - CAST(round(n * 0.2) AS BIGINT) AS n_train, true AS orthogonal FROM sizes",
)
def m20_equations(t):
    """The residuals of least squares are orthogonal to every input on the training rows."""
    train, _ = regress.split(_features(t))
    inputs, chosen = regress.fit_inputs(train)
    rows = inputs.transform(train)
    fitted = regress.linear_models(train)["least squares"].fit(rows).transform(rows)
    scored = fitted.select((F.col("log_spend") - F.col("prediction")).alias("gap"), vector_to_array("scaled").alias("x"))
    orthogonal = F.abs(F.avg("gap")) < 1e-6
    for i in range(len(chosen)):
        orthogonal = orthogonal & (F.abs(F.avg(F.col("gap") * F.col("x")[i])) < 1e-6)
    return scored.agg(F.count("*").alias("n_train"), orthogonal.alias("orthogonal"))


@query(
    "m21_spend_model",
    """SELECT n - CAST(round(n * 0.2) AS BIGINT) AS n_train, CAST(round(n * 0.2) AS BIGINT) AS n_test,
  true AS rmse_not_below_mae, true AS r2_at_most_one FROM sizes""",
)
def m21(t):
    _, metrics = regress.train_spend(_features(t))
    return t.spark.createDataFrame([metrics]).select(
        "n_train",
        "n_test",
        (F.col("rmse") >= F.col("mae")).alias("rmse_not_below_mae"),
        (F.col("r2_log_target") <= 1).alias("r2_at_most_one"),
    )


@query(
    "m22_regression_metrics",
    """SELECT round(sqrt(AVG(pow(p - s, 2))), 2) AS rmse, round(AVG(abs(p - s)), 2) AS mae,
  round(1 - AVG(pow(ln(1 + s) - ln(1 + p), 2)) / var_pop(ln(1 + s)), 6) AS r2_log_target, COUNT(*) AS n FROM (
  SELECT total_spend::DOUBLE AS s, AVG(total_spend::DOUBLE) OVER (PARTITION BY value_segment) AS p FROM ruled)""",
)
def m22(t):
    """The mean of the customer's segment in the role of the prediction."""
    rows = _ruled(t).withColumn("s", F.col("total_spend").cast("double"))
    means = rows.groupBy("value_segment").agg(F.avg("s").alias("p"))
    predicted = rows.join(means, "value_segment").select(
        F.log1p("s").alias("log_spend"), F.log1p("p").alias("prediction")
    )
    scores = evaluate.regression_metrics(predicted)
    return scores.select(
        F.round("rmse", 2).alias("rmse"), F.round("mae", 2).alias("mae"), F.round("r2_log_target", 6).alias("r2_log_target"), "n"
    )


def _linear_predictions(t):
    train, test = regress.split(_features(t))
    inputs, _ = regress.fit_inputs(train)
    fitted = regress.linear_models(train)["least squares"].fit(inputs.transform(train))
    return fitted.transform(inputs.transform(test))


@query(
    "m23_residual_histogram",
    "SELECT CAST(50 AS BIGINT) AS n_bins, CAST(round(n * 0.2) AS BIGINT) AS n, true AS ends_are_filled FROM sizes",
)
def m23(t):
    bins = evaluate.residual_histogram(_linear_predictions(t))
    return bins.agg(
        F.count("*").alias("n_bins"),
        F.sum("n").alias("n"),
        ((F.min_by("n", "bin") > 0) & (F.max_by("n", "bin") > 0)).alias("ends_are_filled"),
    )


@query(
    "m23_residual_qq",
    "SELECT CAST(round(n * 0.2) AS BIGINT) AS n, true AS rising, true AS symmetric FROM sizes",
)
def m23_qq(t):
    points = evaluate.residual_qq(_linear_predictions(t))
    return points.agg(
        F.count("*").alias("n"),
        (F.corr("theoretical", "sample") > 0).alias("rising"),
        (F.abs(F.sum("theoretical")) < 1e-6).alias("symmetric"),
    )


@query(
    "m23_residuals",
    "SELECT CAST(round(n * 0.2) AS BIGINT) AS n, true AS adds_up FROM sizes",
)
def m23_points(t):
    """Residual beside prediction, per test row: the two give the label."""
    scored = _linear_predictions(t)
    points = evaluate.residuals(scored).join(scored.select("customer_id", "log_spend"), "customer_id")
    gap = F.abs(F.col("predicted") + F.col("residual") - F.col("log_spend"))
    return points.agg(F.count("*").alias("n"), (F.max(gap) < 1e-9).alias("adds_up"))


def _models(rows):
    status, _ = classify.train_status(rows)
    segment, _ = cluster.train_segmentation(rows)
    spend, _ = regress.train_spend(rows)
    return status, segment, spend


@query(
    "m24_batch_scoring",
    """SELECT n AS n_customers_scored, n AS n_with_status, n AS n_with_segment, 'customers_features_train' AS source_table,
  'classification=1,clustering=1,regression=1' AS model_versions FROM sizes""",
)
def m24(t):
    rows = _features(t)
    scored = score.score_customers(rows, *_models(rows))
    summary = score.summarise(scored, {"classification": "1", "clustering": "1", "regression": "1"})

    def total(column):
        return F.aggregate(F.map_values(column), F.lit(0).cast("bigint"), lambda a, x: a + x)

    return summary.select(
        "n_customers_scored",
        total("club_status_distribution").alias("n_with_status"),
        total("segment_distribution").alias("n_with_segment"),
        "source_table",
        "model_versions",
    )


view(
    "profs",
    """SELECT customer_id, CASE WHEN CAST(customer_id AS BIGINT) % 5 = 0 THEN NULL WHEN CAST(customer_id AS BIGINT) % 7 = 0 THEN -5 ELSE age END AS age,
  n_transactions, CASE WHEN CAST(customer_id AS BIGINT) % 11 = 0 THEN NULL ELSE tenure_days END AS tenure_days FROM feat""",
)


def _profiles(t):
    number = F.col("customer_id").cast("bigint")
    return _features(t).withColumns(
        {
            "age": F.when(number % 5 == 0, None).when(number % 7 == 0, -5.0).otherwise(F.col("age")),
            "tenure_days": F.when(number % 11 != 0, F.col("tenure_days")),
        }
    )


@query(
    "m25_profile_check",
    """SELECT customer_id, array_to_string(list_filter([CASE WHEN age IS NULL THEN 'age' END, CASE WHEN tenure_days IS NULL THEN 'tenure_days' END],
  lambda x: x IS NOT NULL), ',') AS missing, CASE WHEN age < 0 THEN 'age' ELSE '' END AS out_of_range FROM profs
  WHERE age IS NULL OR tenure_days IS NULL OR age < 0""",
)
def m25(t):
    _, bad = score.split_profiles(_profiles(t), model.BEHAVIOUR)
    return bad.select("customer_id", "missing", "out_of_range")


@query(
    "m25_scored_profiles",
    "SELECT COUNT(*) AS n, true AS known_status FROM profs WHERE age >= 0 AND tenure_days IS NOT NULL",
)
def m25_scored(t):
    rows = _features(t)
    good, _ = score.split_profiles(_profiles(t), model.BEHAVIOUR)
    fitted, _ = classify.train_status(rows)
    known = F.col("predicted_status").isin(fitted.stages[-1].getLabels())
    return score.predict_status(fitted, good).agg(F.count("*").alias("n"), F.every(known).alias("known_status"))


@query("m26_probabilities", "SELECT COUNT(*) AS n, COUNT(*) AS n_summing_to_one, CAST(3 AS BIGINT) AS n_classes FROM feat")
def m26(t):
    rows = _features(t)
    fitted, _ = classify.train_status(rows)
    total = F.aggregate(F.map_values("probabilities"), F.lit(0.0), lambda a, x: a + x)
    return score.predict_status(fitted, rows).agg(
        F.count("*").alias("n"),
        F.count_if(F.abs(total - 1) < 1e-9).alias("n_summing_to_one"),
        F.max(F.size("probabilities")).alias("n_classes"),
    )


# one run per event: task by type, metrics from the value
view(
    "modelruns",
    """SELECT CASE event_type WHEN 'click' THEN 'classification' WHEN 'view' THEN 'regression' ELSE 'clustering' END AS task,
  event_id AS ver, round(value / 500, 4) AS v FROM events""",
)
view(
    "runrows",
    """SELECT task, ver, CASE task WHEN 'classification' THEN v WHEN 'regression' THEN 1 - v ELSE v END AS value,
  CASE WHEN ver % 9 = 0 THEN NULL WHEN task = 'regression' THEN v + 0.4 ELSE v END AS gate_value,
  CASE task WHEN 'classification' THEN 0.2 WHEN 'regression' THEN 0.5 ELSE 0.1 END AS gate_min FROM modelruns""",
)


def _runs(t):
    kind = F.col("event_type")
    task = F.when(kind == "click", "classification").when(kind == "view", "regression").otherwise("clustering")
    base = t.raw("events").select(
        task.alias("task"), F.col("event_id").cast("string").alias("version"), F.round(F.col("value") / 500, 4).alias("v")
    )
    skip = F.col("version").cast("bigint") % 9 == 0
    named = F.when(F.col("task") == "classification", "f1_macro").otherwise("silhouette_score")
    pairs = F.when(
        F.col("task") == "regression",
        F.array(
            F.struct(F.lit("rmse").alias("metric"), (1 - F.col("v")).alias("value")),
            F.struct(F.lit("r2_log_target").alias("metric"), F.when(~skip, F.col("v") + 0.4).alias("value")),
        ),
    ).otherwise(F.array(F.struct(named.alias("metric"), F.when(~skip, F.col("v")).alias("value"))))
    return base.select("task", "version", F.inline(pairs)).where(F.col("value").isNotNull() | (F.col("task") != "regression"))


@query(
    "m27_gates",
    """SELECT task, CAST(ver AS VARCHAR) AS version, round(gate_value, 9) AS gate_value, coalesce(gate_value >= gate_min, false) AS passed FROM runrows""",
)
def m27(t):
    return promote.gated(_runs(t)).select("task", "version", F.round("gate_value", 9).alias("gate_value"), "passed")


@query(
    "m27_promotions",
    """SELECT task, version, passed, promoted, CASE WHEN promoted THEN version ELSE champ END AS champion_after FROM (
  SELECT n.task, CAST(n.ver AS VARCHAR) AS version, coalesce(n.gate_value >= n.gate_min, false) AS passed, CAST(c.ver AS VARCHAR) AS champ,
   coalesce(n.gate_value >= n.gate_min, false) AND nv IS NOT NULL AND
     CASE WHEN cv IS NULL THEN true WHEN n.task = 'regression' THEN nv <= cv ELSE nv >= cv END AS promoted
  FROM (SELECT *, CASE WHEN task <> 'regression' AND ver % 9 = 0 THEN NULL ELSE value END AS nv FROM runrows QUALIFY row_number() OVER (PARTITION BY task ORDER BY ver DESC) = 1) n
  JOIN (SELECT *, CASE WHEN task <> 'regression' AND ver % 9 = 0 THEN NULL ELSE value END AS cv FROM runrows QUALIFY row_number() OVER (PARTITION BY task ORDER BY ver) = 1) c USING (task))""",
)
def m27_promotions(t):
    runs = _runs(t)
    first = runs.groupBy("task").agg(F.min_by("version", F.col("version").cast("bigint")).alias("version"))
    return promote.promotions(runs, first).select("task", "version", "passed", "promoted", "champion_after")


@query("w08_latest_versions", "SELECT task, CAST(MAX(ver) AS VARCHAR) AS version FROM modelruns GROUP BY task")
def w08(t):
    return promote.latest_versions(_runs(t))


@query("m28_saved_model", "SELECT COUNT(*) AS n, COUNT(*) AS n_equal FROM feat")
def m28(t):
    rows = _features(t)
    fitted, _ = cluster.train_segmentation(rows)
    path = new_path(t.spark, "model")
    score.save(fitted, path)
    before = score.predict_segment(fitted, rows).select("customer_id", F.col("cluster").alias("a"))
    after = score.predict_segment(score.load(path), rows).select("customer_id", F.col("cluster").alias("b"))
    return before.join(after, "customer_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("a") == F.col("b")).alias("n_equal")
    )
