"""Metrics from predictions, computed by aggregation."""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.sql import DataFrame, functions as F

from tillwise.operators.analysis import histogram
from tillwise.operators.stat_tests import qq_points


def confusion(predictions: DataFrame, label: str, predicted: str) -> DataFrame:
    return predictions.groupBy(F.col(label).alias("label"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def class_report(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per label, over labels that occur or are predicted;
    0 where a measure is undefined. ``counts`` is a confusion table."""
    sides = counts.select(
        F.explode(
            F.array(
                F.struct(F.col("label").alias("label"), F.col("n").alias("actual"), F.lit(0).alias("claimed"), _hit()),
                F.struct(F.col("predicted").alias("label"), F.lit(0).alias("actual"), F.col("n").alias("claimed"), F.lit(0).alias("hit")),
            )
        ).alias("s")
    ).select("s.*")
    sums = sides.groupBy("label").agg(
        F.sum("hit").alias("hit"), F.sum("actual").alias("support"), F.sum("claimed").alias("claimed")
    )

    def or_zero(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    hit = F.col("hit").cast("double")
    return sums.select(
        "label",
        or_zero(hit, F.col("claimed")).alias("precision"),
        or_zero(hit, F.col("support")).alias("recall"),
        or_zero(2 * hit, F.col("claimed") + F.col("support")).alias("f1"),
        "support",
    )


def _hit():
    return F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit")


def classification_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, macro and weighted F1 in one row, from a confusion table."""
    total = F.sum("support")
    return class_report(counts).agg(
        F.try_divide(F.sum(F.col("recall") * F.col("support")), total).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        F.try_divide(F.sum(F.col("f1") * F.col("support")), total).alias("f1_weighted"),
        total.alias("n"),
    )


def regression_metrics(predictions: DataFrame, label: str = "log_spend", predicted: str = "prediction") -> DataFrame:
    """RMSE and MAE in original units and R2 on the log target, in one row and one pass."""
    y, p = F.col(label), F.col(predicted)
    gap = F.expm1(p) - F.expm1(y)
    return predictions.agg(
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
        F.avg(F.abs(gap)).alias("mae"),
        (1 - F.try_divide(F.avg((y - p) * (y - p)), F.var_pop(y))).alias("r2_log_target"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse_log"),
        F.count("*").alias("n"),
    )


def residuals(
    predictions: DataFrame, label: str = "log_spend", predicted: str = "prediction", key: str = "customer_id"
) -> DataFrame:
    """Residual beside prediction, per row."""
    return predictions.select(
        key, F.col(predicted).alias("predicted"), (F.col(label) - F.col(predicted)).alias("residual")
    )


def residual_histogram(predictions: DataFrame, bins: int = 50, **columns: str) -> DataFrame:
    return histogram(residuals(predictions, **columns), "residual", bins)


def residual_qq(predictions: DataFrame, key: str = "customer_id", **columns: str) -> DataFrame:
    return qq_points(residuals(predictions, key=key, **columns), "residual", key)


class F1Macro(Evaluator):
    """Unweighted mean F1, for model selection."""

    def __init__(self, label: str = "label", predicted: str = "prediction"):
        super().__init__()
        self.label, self.predicted = label, predicted

    def _evaluate(self, dataset: DataFrame) -> float:
        return float(classification_metrics(confusion(dataset, self.label, self.predicted)).first().f1_macro)

    def isLargerBetter(self) -> bool:
        return True
