"""Drift of a feature table between two windows.

Numeric columns: Wasserstein distance over the reference standard deviation. Categorical
columns: Jensen-Shannon distance (base 2). A column has drifted at a distance of 0.1 or
more, the table when half of its columns have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tillwise.operators.ranking import global_rank
from tillwise.session import materialise

# Limit per column and share of drifted columns that raises the alert; distinct values of a slice.
COLUMN_LIMIT = 0.1
SHARE_LIMIT = 0.5
SLICE = 4096


def numeric_drift(reference: DataFrame, current: DataFrame, columns: list[str], rows: int = SLICE) -> DataFrame:
    """Area between both distribution functions, over the deviation of the reference.

    Exact, from the counts of every value in both windows. Distinct values are ranked and cut into slices of
    ``rows``; sums up to each slice come first, so no task orders more than a slice, however many values there are.
    """

    def values(df: DataFrame, side: str, other: str) -> DataFrame:
        long = df.unpivot([], [F.col(c).cast("double").alias(c) for c in columns], "column_name", "v")
        counted = long.where("v IS NOT NULL").groupBy("column_name", "v").agg(F.count("*").alias(side))
        return counted.withColumn(other, F.lit(0).cast("bigint"))

    both = values(reference, "ref", "cur").unionByName(values(current, "cur", "ref"))
    counts = materialise(both.groupBy("column_name", "v").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur")), "values")
    ranked = global_rank(counts, F.col("column_name"), F.col("v"), name="_rank")
    sliced = materialise(ranked.select("column_name", "v", "ref", "cur", F.floor(F.col("_rank") / rows).alias("slice")), "slices")

    order = Window.partitionBy("column_name").orderBy("slice")
    sums = sliced.groupBy("column_name", "slice").agg(F.sum("ref").alias("r"), F.sum("cur").alias("c"), F.min("v").alias("first"))
    whole = Window.partitionBy("column_name")
    before = sums.select(
        "column_name",
        "slice",
        (F.sum("r").over(order) - F.col("r")).alias("r_before"),
        (F.sum("c").over(order) - F.col("c")).alias("c_before"),
        F.sum("r").over(whole).alias("r_all"),
        F.sum("c").over(whole).alias("c_all"),
        F.lead("first").over(order).alias("next_first"),
    ).where("r_all > 0 AND c_all > 0")  # a column without values in a window has no distance
    inside = Window.partitionBy("column_name", "slice").orderBy("v")
    r = F.col("r_before") + F.sum("ref").over(inside)
    c = F.col("c_before") + F.sum("cur").over(inside)
    width = F.coalesce(F.lead("v").over(inside), F.col("next_first"), F.col("v")) - F.col("v")
    areas = sliced.join(before, ["column_name", "slice"]).select(
        "column_name", (F.abs(r / F.col("r_all") - c / F.col("c_all")) * width).alias("area")
    )
    spread = reference.select([F.stddev_samp(F.col(c).cast("double")).alias(c) for c in columns])
    spreads = spread.unpivot([], columns, "column_name", "sd")
    scale = F.when(F.col("sd") > 0, F.col("sd")).otherwise(0.001)
    return areas.groupBy("column_name").agg(F.sum("area").alias("area")).join(spreads, "column_name").select(
        "column_name", F.lit("wasserstein").alias("measure"), (F.col("area") / scale).alias("distance")
    )


def categorical_drift(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Distance between the shares of the values in both windows."""

    def shares(df: DataFrame, side: str) -> DataFrame:
        counts = (
            df.unpivot([], [F.col(c).cast("string").alias(c) for c in columns], "column_name", "v")
            .where("v IS NOT NULL")
            .groupBy("column_name", "v")
            .agg(F.count("*").alias("n"))
        )
        total = F.sum("n").over(Window.partitionBy("column_name"))
        return counts.select("column_name", "v", (F.col("n") / total).alias(f"_{side}"))

    both = shares(reference, "ref").join(shares(current, "cur"), ["column_name", "v"], "full").na.fill(
        0.0, ["_ref", "_cur"]
    )
    middle = (F.col("_ref") + F.col("_cur")) / 2

    def part(p: str):
        return F.when(F.col(p) > 0, F.col(p) * F.log2(F.col(p) / middle)).otherwise(0.0)

    divergence = F.sum((part("_ref") + part("_cur")) / 2)
    return both.groupBy("column_name").agg(
        F.lit("jensen_shannon").alias("measure"), F.sqrt(F.greatest(divergence, F.lit(0.0))).alias("distance")
    )


def drift_report(
    reference: DataFrame, current: DataFrame, numeric: list[str], categorical: list[str]
) -> DataFrame:
    """Distance and verdict per common column."""
    shared = set(reference.columns) & set(current.columns)
    numbers = [c for c in numeric if c in shared]
    labels = [c for c in categorical if c in shared]
    parts = []
    if numbers:
        parts.append(numeric_drift(reference, current, numbers))
    if labels:
        parts.append(categorical_drift(reference, current, labels))
    report = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return report.withColumn("drifted", F.col("distance") >= COLUMN_LIMIT)


def drift_summary(report: DataFrame) -> DataFrame:
    """One row: columns, drifted columns, their share, and the alert."""
    return (
        report.agg(F.count("*").alias("n_columns"), F.count_if("drifted").alias("n_drifted"))
        .withColumn("share", F.try_divide("n_drifted", "n_columns"))
        .withColumn("alert", F.col("share") >= SHARE_LIMIT)
    )
