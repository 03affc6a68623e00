"""Quality gates and promotion over a table of model runs.

``runs``: task, version (number as text), metric, value. ``champions``: task, version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Metric and direction of the comparison, metric and least value of the gate.
TASKS = [
    ("classification", "f1_macro", True, "f1_macro", 0.20),
    ("regression", "rmse", False, "r2_log_target", 0.50),
    ("clustering", "silhouette_score", True, "silhouette_score", 0.10),
]


def task_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        TASKS, "task STRING, metric STRING, higher_is_better BOOLEAN, gate_metric STRING, gate_min DOUBLE"
    )


def latest_versions(runs: DataFrame) -> DataFrame:
    """Newest version per task, by number and not by text."""
    return runs.groupBy("task").agg(F.max_by("version", F.col("version").cast("bigint")).alias("version"))


def gated(runs: DataFrame) -> DataFrame:
    """One row per task and version: gate value, verdict and comparison value. A missing
    gate metric fails."""
    rules = F.broadcast(task_rules(runs.sparkSession))  # three rows
    named = rules.withColumnRenamed("metric", "compare_metric")
    rows = runs.join(named, "task").groupBy(
        "task", "version", "compare_metric", "higher_is_better", "gate_metric", "gate_min"
    )
    measured = rows.agg(
        F.max(F.when(F.col("metric") == F.col("compare_metric"), F.col("value"))).alias("value"),
        F.max(F.when(F.col("metric") == F.col("gate_metric"), F.col("value"))).alias("gate_value"),
    )
    return measured.withColumn("passed", F.coalesce(F.col("gate_value") >= F.col("gate_min"), F.lit(False)))


def promotions(runs: DataFrame, champions: DataFrame) -> DataFrame:
    """Decision for the newest version of every task.

    It is promoted if it passes the gate, has the comparison metric, and is at least as good
    as the champion, or there is no champion with a value.
    """
    measured = gated(runs)
    newest = measured.join(latest_versions(runs), ["task", "version"])
    holders = champions.select("task", F.col("version").alias("champion_version"))
    current = (
        holders.join(
            measured.select("task", F.col("version").alias("champion_version"), F.col("value").alias("champion_value")),
            ["task", "champion_version"],
            "left",
        )
    )
    better = (
        F.when(F.col("champion_value").isNull(), True)
        .when(F.col("higher_is_better"), F.col("value") >= F.col("champion_value"))
        .otherwise(F.col("value") <= F.col("champion_value"))
    )
    promoted = F.col("passed") & F.col("value").isNotNull() & F.coalesce(better, F.lit(False))
    return (
        newest.join(current, "task", "left")
        .withColumn("promoted", promoted)
        .withColumn("champion_after", F.when(F.col("promoted"), F.col("version")).otherwise(F.col("champion_version")))
    )
