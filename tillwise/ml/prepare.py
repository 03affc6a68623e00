"""Model inputs: filled, encoded and standardised columns as pipeline stages.

Every step is a stage of the fitted pipeline, so a saved model carries its preprocessing.
"""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import ElementwiseProduct, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F

from tillwise import model

SCALED = "scaled"


def fill_stage(columns: list[str]) -> SQLTransformer:
    """Adds ``x_<column>``: the column as a number, 0 where it is missing."""
    filled = ", ".join(f"coalesce(CAST(`{c}` AS DOUBLE), 0D) AS `x_{c}`" for c in columns)
    return SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")


def levels_of(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted levels per categorical column (status, newsletter, age group: a handful each)."""
    seen = df.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in columns]).first()
    return {c: list(seen[c]) for c in columns}


def dummy_stage(levels: dict[str, list[str]]) -> tuple[SQLTransformer, list[str]]:
    """One 0/1 column per level but the first; a level not seen in training is all zero."""
    parts, names = [], []
    for column, values in levels.items():
        for value in values[1:]:
            name = f"x_{column}_{value}"
            quoted = value.replace("\\", "\\\\").replace("'", "\\'")
            parts.append(f"CAST(`{column}` <=> '{quoted}' AS DOUBLE) AS `{name}`")
            names.append(name)
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__"), names


def scaling_stages(df: DataFrame, columns: list[str], output: str = SCALED) -> list[Transformer]:
    """Assemble ``columns`` and standardise them by the population deviation.

    The built-in scaler divides by the sample deviation; the last stage corrects for it.
    """
    raw, sampled = f"{output}_raw", f"{output}_sampled"
    assembler = VectorAssembler(inputCols=columns, outputCol=raw)
    vectors = assembler.transform(df)
    scaler = StandardScaler(inputCol=raw, outputCol=sampled, withMean=True, withStd=True).fit(vectors)
    n = df.count()
    factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
    correction = ElementwiseProduct(
        scalingVec=Vectors.dense([factor] * len(columns)), inputCol=sampled, outputCol=output
    )
    return [assembler, scaler, correction]


def fit_behaviour(train: DataFrame) -> PipelineModel:
    """Behaviour columns, missing as 0, standardised into ``scaled``."""
    fill = fill_stage(model.BEHAVIOUR)
    return PipelineModel([fill, *scaling_stages(fill.transform(train), [f"x_{c}" for c in model.BEHAVIOUR])])


def fit_spend_columns(train: DataFrame) -> tuple[list[Transformer], list[str]]:
    """Numeric and dummy columns of the spend model, not yet selected or scaled."""
    fill = fill_stage(model.SPEND_NUMERIC)
    dummies, names = dummy_stage(levels_of(train, model.SPEND_CATEGORICAL))
    return [fill, dummies], [f"x_{c}" for c in model.SPEND_NUMERIC] + names


def with_log_spend(df: DataFrame) -> DataFrame:
    return df.withColumn("log_spend", F.log1p(F.col("total_spend").cast("double")))
