"""Column summaries in the manner of a data-frame ``describe``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwise.operators.quantiles import exact_quantiles


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample deviation, min, exact quartiles and max; one row per column.

    The columns unfold to (column_name, value) rows, which the first aggregation collapses
    again, so every column is handled by the same two jobs.
    """
    values = df.unpivot([], [F.col(c).cast("double").alias(c) for c in columns], "column_name", "value").where(
        "value IS NOT NULL"
    )
    basics = values.groupBy("column_name").agg(
        F.count("*").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(values, "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, by=["column_name"])
    return basics.join(quartiles, "column_name")


def describe_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, distinct values, the most frequent value and its count; one row per column."""
    values = df.unpivot([], columns, "column_name", "value").where("value IS NOT NULL")
    counts = values.groupBy("column_name", "value").agg(F.count("*").alias("n"))
    return counts.groupBy("column_name").agg(
        F.sum("n").alias("n"),
        F.count("*").alias("n_unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )
