"""Club status models."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
)
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window, functions as F

from tillwise.functions.columns import sample_order
from tillwise.ml.boost import Boosted
from tillwise.ml.evaluate import F1Macro, classification_metrics, confusion
from tillwise.ml.forest import Forest
from tillwise.ml.kernel import FourierMap
from tillwise.ml.margin import Margin
from tillwise.ml.prepare import SCALED, fit_behaviour
from tillwise.operators.cleaning import require
from tillwise.operators.neighbours import nearest
from tillwise.operators.ranking import cap_per_stratum, global_rank, sample_rows, stratified_split
from tillwise.session import materialise

TARGET = "club_member_status"
NEIGHBOUR_CAP = 50_000


def prepare(features: DataFrame, key: str = "customer_id", seed: int = 42) -> tuple[DataFrame, DataFrame, PipelineModel]:
    """Stratified 80/20 split with label, weight and scaled vector; scaler and label index
    are fitted on the training rows. Both parts are stored: every model reads them again."""
    train, test = stratified_split(require(features, TARGET), TARGET, key, 0.2, seed)
    scaler = fit_behaviour(train)
    index = StringIndexer(inputCol=TARGET, outputCol="label", stringOrderType="alphabetAsc").fit(train)
    both = PipelineModel([*scaler.stages, index])
    kept = [key, TARGET, "label", SCALED]
    train = with_class_weights(both.transform(train).select(kept))
    return _stored(train, "train"), _stored(both.transform(test).select(kept), "test"), both


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Vectors are stored as plain arrays, which every reader understands."""
    plain = materialise(df.withColumn(SCALED, vector_to_array(SCALED)), name)
    return plain.withColumn(SCALED, array_to_vector(SCALED))


def with_class_weights(train: DataFrame, label: str = "label") -> DataFrame:
    """Weight n / (classes x class size): every class weighs the same in total."""
    sizes = train.groupBy(label).agg(F.count("*").alias("_size"))
    every = Window.partitionBy()
    weights = sizes.select(
        label, (F.sum("_size").over(every) / (F.count("*").over(every) * F.col("_size"))).alias("weight")
    )
    return train.join(F.broadcast(weights), label)  # one row per class


def forest(trees: int = 200, depth: int = 20, leaf: int = 5, seed: int = 42) -> Forest:
    return Forest(
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=leaf,
        featuresCol=SCALED,
        labelCol="label",
        weightCol="weight",
        seed=seed,
    )


def train_status(
    features: DataFrame, key: str = "customer_id", trees: int = 200, depth: int = 20, leaf: int = 5
) -> tuple[PipelineModel, dict[str, float]]:
    """The status model with preprocessing and label names, and its test metrics."""
    train, test, prepared = prepare(features, key)
    fitted = forest(trees, depth, leaf).fit(train)
    names = IndexToString(inputCol="prediction", outputCol="predicted_status", labels=prepared.stages[-1].labels)
    score = classification_metrics(confusion(fitted.transform(test), "label", "prediction")).first()
    metrics = {
        "f1_macro": score.f1_macro,
        "accuracy": score.accuracy,
        "n_train": train.count(),
        "n_test": test.count(),
    }
    # scoring starts from feature rows without a known status: the label index stays out
    return PipelineModel([*prepared.stages[:-1], fitted, names]), metrics


def evaluate_on(test: DataFrame, name: str, predictions: DataFrame) -> DataFrame:
    scores = classification_metrics(confusion(predictions, "label", "prediction"))
    return scores.select(F.lit(name).alias("model"), "accuracy", "f1_macro", "f1_weighted", "n")


def compare(train: DataFrame, test: DataFrame, estimators: dict) -> DataFrame:
    """Test metrics of several estimators, best macro F1 first."""
    result = None
    for name, estimator in estimators.items():
        row = evaluate_on(test, name, estimator.fit(train).transform(test))
        result = row if result is None else result.unionByName(row)
    return result.orderBy(F.desc("f1_macro"), "model")


def balanced_models(seed: int = 42) -> dict:
    common = {"featuresCol": SCALED, "labelCol": "label", "weightCol": "weight"}
    return {
        "logistic": LogisticRegression(maxIter=1000, **common),
        "tree": DecisionTreeClassifier(maxDepth=20, seed=seed, **common),
        "forest": Forest(numTrees=100, maxDepth=20, seed=seed, **common),
    }


def margin_model(column: str = SCALED) -> Margin:
    """Linear large-margin classifier per class against the rest, on weighted rows."""
    return Margin(featuresCol=column, labelCol="label", weightCol="weight", regParam=0.001)


def kernel_margin_model(width: int, features: int = 256, gamma: float | None = None, seed: int = 42) -> Pipeline:
    """The margin classifier under a radial kernel, by way of a map; by default gamma is 1 / ``width``, as columns have variance one."""
    gamma = 1 / width if gamma is None else gamma
    mapped = FourierMap(inputCol=SCALED, outputCol="fourier", width=width, features=features, gamma=gamma, seed=seed)
    return Pipeline(stages=[mapped, margin_model("fourier")])


def boosted_model(weighted: bool, rounds: int = 100, depth: int = 6) -> Boosted:
    """Boosted trees per class against the rest."""
    return Boosted(featuresCol=SCALED, labelCol="label", weightCol="weight" if weighted else None, maxIter=rounds, maxDepth=depth)


def fit_beside(fits: list[tuple]) -> list:
    """The models of several estimators, each with its own rows, fitted at the same time."""
    with ThreadPool(len(fits)) as pool:
        work = inheritable_thread_target(fits[0][1].sparkSession)(lambda one: one[0].fit(one[1]))
        return pool.map(work, fits)


def neighbour_votes(
    train: DataFrame, test: DataFrame, k: int = 5, key: str = "customer_id", cap: int | None = None, seed: int = 42
) -> DataFrame:
    """Majority class of the ``k`` nearest training rows; the smaller label on a tie.

    All training rows take part, tile by tile; with ``cap``, a fixed sample of so many.
    """
    pool = train.select(key, "label", vector_to_array(SCALED).alias("x"))
    if cap is not None:
        pool = sample_rows(pool, cap, key, seed)
    rows = test.select(key, "label", vector_to_array(SCALED).alias("x"))
    near = nearest(rows, pool, k, key, "x", "label")
    counts = near.groupBy(key, "near_label").agg(F.count("*").alias("n"))
    votes = counts.groupBy(key).agg(F.min_by("near_label", F.struct(-F.col("n"), F.col("near_label"))).alias("prediction"))
    return test.select(key, "label").join(votes, key)


def grid_search(
    train: DataFrame,
    estimator,
    grid: dict[str, list],
    folds: int = 3,
    key: str = "customer_id",
    cap: int = NEIGHBOUR_CAP,
    parallelism: int = 4,
    seed: int = 42,
):
    """Cross-validated choice by macro F1 on a fixed sample of at most ``cap`` rows; the best
    setting is then fitted on all training rows. Returns model, setting and its score."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    settings = builder.build()
    searched = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=settings,
        evaluator=F1Macro(),
        numFolds=folds,
        parallelism=parallelism,
        seed=seed,
    ).fit(sample_rows(train, cap, key, seed))
    best = max(range(len(settings)), key=lambda i: searched.avgMetrics[i])
    chosen = {param.name: value for param, value in settings[best].items()}
    return estimator.copy(settings[best]).fit(train), chosen, searched.avgMetrics[best]


def oversample(
    train: DataFrame, key: str = "customer_id", k: int = 4, cap: int | None = None, seed: int = 42
) -> DataFrame:
    """Raise every class to the size of the largest with points between near neighbours.

    With ``cap``, every class is first cut to that many rows at most, in a fixed pseudo-random
    order. A new point lies at a random place between a row and one of its ``k`` nearest rows
    of the same class. Result: label, scaled, synthetic.
    """
    rows = train.select(key, "label", vector_to_array(SCALED).alias("x"))
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    for label, n in sizes.items():
        if n <= k:
            raise ValueError(f"class {label} has {n} rows; {k + 1} are needed")
    if cap is not None and max(sizes.values()) > cap:
        rows = cap_per_stratum(rows, "label", key, cap, seed)
        sizes = {label: min(n, cap) for label, n in sizes.items()}
    rows = materialise(rows, "classes")
    largest = max(sizes.values())
    result = rows.select("label", array_to_vector("x").alias(SCALED), F.lit(False).alias("synthetic"))
    for label, n in sizes.items():
        if n < largest:
            added = _between_neighbours(rows.where(F.col("label") == label), key, k, n, largest - n, seed)
            result = result.unionByName(
                added.select(F.lit(label).alias("label"), array_to_vector("x").alias(SCALED), F.lit(True).alias("synthetic"))
            )
    return result


def _between_neighbours(points: DataFrame, key: str, k: int, n: int, wanted: int, seed: int) -> DataFrame:
    """``wanted`` new points for one class of ``n`` rows; every row gives the same number, and
    the first rows of a fixed pseudo-random order one more."""
    ranked = global_rank(points.select(key, "x"), sample_order(F.col(key), seed), F.col(key), name="_rank")
    near = nearest(points.select(key, "x"), points.select(key, "x"), k, key, "x", "x", skip_self=True)
    partners = near.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("rank", "near_x"))).alias("partners"))
    share = F.lit(wanted // n) + F.when(F.col("_rank") < wanted % n, 1).otherwise(0)
    # every draw comes from a hash of row and number, so a repeated task draws the same
    drawn = (
        ranked.join(partners, key)
        .withColumn("_share", share)
        .where("_share > 0")
        .withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_share"))))
    )
    partner = F.get("partners", F.pmod(F.xxhash64(key, "_i", F.lit(seed)), F.lit(k)).cast("int"))["near_x"]
    place = F.pmod(F.xxhash64(key, "_i", F.lit(seed + 1)), F.lit(1 << 40)) / float(1 << 40)
    placed = drawn.select("x", partner.alias("y"), place.alias("p"))
    return placed.select(F.zip_with("x", "y", lambda a, b: a + F.col("p") * (b - a)).alias("x"))
