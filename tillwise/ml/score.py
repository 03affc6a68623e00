"""Scoring: all customers with the three models, and hypothetical profiles."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tillwise import model
from tillwise.operators.marts import scoring_summary
from tillwise.operators.ranking import sample_rows
from tillwise.session import materialise


def save(fitted: PipelineModel, path: str) -> None:
    fitted.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predict_status(fitted: PipelineModel, rows: DataFrame) -> DataFrame:
    """Adds ``predicted_status`` and ``probabilities`` (map of status to probability)."""
    labels = fitted.stages[-1].getLabels()
    scored = fitted.transform(rows)
    names = F.array(*[F.lit(name) for name in labels])
    return scored.select(
        *rows.columns,
        "predicted_status",
        F.map_from_arrays(names, vector_to_array("probability")).alias("probabilities"),
    )


def predict_segment(fitted: PipelineModel, rows: DataFrame) -> DataFrame:
    return fitted.transform(rows).select(*rows.columns, "cluster")


def predict_spend(fitted: PipelineModel, rows: DataFrame) -> DataFrame:
    return fitted.transform(rows).select(*rows.columns, F.expm1("prediction").alias("predicted_total_spend"))


def score_customers(
    features: DataFrame,
    status: PipelineModel,
    segment: PipelineModel,
    spend: PipelineModel,
    key: str = "customer_id",
    limit: int | None = None,
) -> DataFrame:
    """All three predictions for every customer, or for a fixed sample of ``limit``."""
    rows = sample_rows(features, limit, key) if limit else features
    return predict_spend(spend, predict_segment(segment, predict_status(status, rows)))


def summarise(scored: DataFrame, versions: dict[str, str], source: str = "customers_features_train") -> DataFrame:
    """One row for the nightly notice; the scored rows are stored once for its parts."""
    stored = materialise(scored.select("predicted_status", "cluster", "predicted_total_spend"), "scored")
    summary = scoring_summary(stored, "predicted_status", "cluster", "predicted_total_spend")
    pairs = [F.lit(x) for pair in sorted(versions.items()) for x in pair]
    return summary.withColumns(
        {
            "generated_at": F.current_timestamp(),
            "source_table": F.lit(source),
            "model_versions": F.create_map(*pairs),
        }
    )


# --- hypothetical profiles -------------------------------------------------------------------

# Limits of the numeric profile fields.
LIMITS = {c: (0.0, 120.0 if c == "age" else None) for c in model.BEHAVIOUR}


def check_profiles(profiles: DataFrame, required: list[str]) -> DataFrame:
    """Adds ``missing`` (names of absent fields) and ``out_of_range``."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), c) for c in required]))

    def outside(c: str) -> Column:
        low, high = LIMITS[c]
        wrong = F.col(c) < low
        return wrong if high is None else wrong | (F.col(c) > high)

    ranged = [c for c in required if c in LIMITS]
    strange = F.array_compact(F.array(*[F.when(outside(c), c) for c in ranged]))
    return profiles.withColumn("missing", missing).withColumn("out_of_range", strange)


def split_profiles(profiles: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Profiles that can be scored, and the others with their reasons."""
    checked = check_profiles(profiles, required)
    good = (F.size("missing") == 0) & (F.size("out_of_range") == 0)
    return checked.where(good).drop("missing", "out_of_range"), checked.where(~good)
