"""Spend models on the log of total spend."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, functions as F

from tillwise.functions.columns import sample_order
from tillwise.ml.evaluate import regression_metrics
from tillwise.ml.prepare import SCALED, fit_spend_columns, scaling_stages, with_log_spend
from tillwise.operators.cleaning import require
from tillwise.operators.ranking import global_rank
from tillwise.operators.stat_tests import best_features
from tillwise.session import materialise

LABEL = "log_spend"


def split(features: DataFrame, key: str = "customer_id", test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of known spend, exactly ``test_share`` of them for the test."""
    rows = with_log_spend(require(features, "total_spend"))
    ranked = global_rank(rows, sample_order(F.col(key), seed), F.col(key), name="_rank")
    border = F.round(ranked.agg(F.count("*")).scalar() * test_share)
    marked = materialise(ranked.withColumn("_test", F.col("_rank") < border).drop("_rank"), "spend")
    return marked.where(~F.col("_test")).drop("_test"), marked.where("_test").drop("_test")


def fit_inputs(train: DataFrame, k: int = 12) -> tuple[PipelineModel, list[str]]:
    """Encoding, the ``k`` best columns by F-score on the training rows, and scaling."""
    stages, columns = fit_spend_columns(train)
    encoded = PipelineModel(stages).transform(train)
    chosen = best_features(encoded, columns, LABEL, min(k, len(columns)))
    return PipelineModel([*stages, *scaling_stages(encoded, chosen)]), chosen


def linear_models(train: DataFrame) -> dict[str, LinearRegression]:
    """Least squares, lasso 0.01, ridge 1.0 and elastic net (0.01, half and half).

    Penalties are meant as: mean squared error / 2 + a |w| + b w^2 / 2, and for the ridge:
    sum of squares + |w|^2, so b = 1/n. The estimator divides the label by its deviation
    first, which leaves ``a`` as it is and divides ``b`` by the deviation; hence the factor.
    """
    n, sd = train.agg(F.count("*"), F.stddev_pop(LABEL)).first()

    def penalised(a: float, b: float) -> LinearRegression:
        total = a + b * sd
        return LinearRegression(
            featuresCol=SCALED,
            labelCol=LABEL,
            standardization=False,
            solver="normal",  # one pass over the rows
            tol=1e-9,
            regParam=total,
            elasticNetParam=a / total if total else 0.0,
        )

    return {
        "least squares": penalised(0.0, 0.0),
        "lasso": penalised(0.01, 0.0),
        "ridge": penalised(0.0, 1.0 / n),
        "elastic net": penalised(0.005, 0.005),
    }


def boosted(rounds: int = 100, depth: int = 6, step: float = 0.3, seed: int = 42) -> GBTRegressor:
    return GBTRegressor(featuresCol=SCALED, labelCol=LABEL, maxIter=rounds, maxDepth=depth, stepSize=step, seed=seed)


def compare(train: DataFrame, test: DataFrame, models: dict, folds: int = 5, key: str = "customer_id", seed: int = 42) -> DataFrame:
    """Cross-validated RMSE and R2 on the log target, and test metrics, per model."""
    part = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(seed)), F.lit(folds))
    parted = train.withColumn("_fold", part).persist()
    result = None
    try:
        for name, estimator in models.items():
            held_out = []
            for fold in range(folds):
                fitted = estimator.fit(parted.where(F.col("_fold") != fold))
                held_out.append(regression_metrics(fitted.transform(parted.where(F.col("_fold") == fold))).first())
            row = regression_metrics(estimator.fit(parted).transform(test)).select(
                F.lit(name).alias("model"),
                F.lit(sum(m.rmse_log for m in held_out) / folds).alias("cv_rmse"),
                F.lit(sum(m.r2_log_target for m in held_out) / folds).alias("cv_r2"),
                "rmse",
                "mae",
                "r2_log_target",
            )
            row = train.sparkSession.createDataFrame(row.collect(), row.schema)
            result = row if result is None else result.unionByName(row)
    finally:
        parted.unpersist()
    return result.orderBy("rmse", "model")


def train_spend(
    features: DataFrame, key: str = "customer_id", k: int = 12, rounds: int = 100, depth: int = 6
) -> tuple[PipelineModel, dict[str, float]]:
    """The spend model with its preprocessing, and its test metrics."""
    train, test = split(features, key)
    inputs, _ = fit_inputs(train, k)
    fitted = boosted(rounds, depth).fit(inputs.transform(train))
    score = regression_metrics(fitted.transform(inputs.transform(test))).first()
    metrics = {
        "rmse": score.rmse,
        "mae": score.mae,
        "r2_log_target": score.r2_log_target,
        "n_train": train.count(),
        "n_test": score.n,
    }
    return PipelineModel([*inputs.stages, fitted]), metrics
