"""Reporting tables derived from sales and customer features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwise.functions.columns import date_key, ratio, share
from tillwise.operators.quantiles import exact_quantiles


def products_performance(sales: DataFrame, articles: DataFrame) -> DataFrame:
    """Number of sales per article; the names join the counts, not the sales."""
    return named_products(sales.groupBy("article_id").agg(F.count("*").alias("n_sales")), articles)


def named_products(counts: DataFrame, articles: DataFrame) -> DataFrame:
    names = articles.select("article_id", "prod_name", "product_group_name", "department_name", "index_name")
    return counts.join(names, "article_id", "left").orderBy(F.desc("n_sales"), "article_id")


def daily_sales(sales: DataFrame) -> DataFrame:
    return dated_sales(sales.groupBy("t_dat").agg(F.sum("price").alias("revenue"), F.count("*").alias("n_transactions")))


def dated_sales(sums: DataFrame) -> DataFrame:
    return (
        sums.select(date_key(F.col("t_dat")).alias("date_key"), F.col("t_dat").alias("date"), "revenue", "n_transactions")
        .orderBy("date_key")
    )


def segment_summary(features: DataFrame) -> DataFrame:
    """One row per value segment; the window runs over these few rows only."""
    spend = F.sum("total_spend")
    return (
        features.groupBy("value_segment")
        .agg(
            F.count("*").alias("n_customers"),
            ratio(spend, F.count("*")).alias("avg_spend"),
            ratio(F.sum("n_transactions"), F.count("*")).alias("avg_purchases"),
            spend.alias("segment_revenue"),
        )
        .withColumn(
            "revenue_share_pct",
            share(F.col("segment_revenue"), F.sum("segment_revenue").over(Window.partitionBy()), 1),
        )
    )


def age_group_summary(features: DataFrame) -> DataFrame:
    """Buyers by age group."""
    return (
        features.where("n_transactions > 0")
        .groupBy("age_group")
        .agg(
            F.count("*").alias("n_customers"),
            F.sum("total_spend").alias("revenue"),
            F.round(F.sum("total_spend") / F.count("*"), 2).alias("avg_revenue"),
            F.round(ratio(F.sum("n_transactions"), F.count("*")), 2).alias("avg_purchases"),
        )
    )


def _distribution(df: DataFrame, column: str) -> DataFrame:
    """One row: map of value to count, and the most frequent value (smallest on a tie).

    ``column`` is a class label or cluster number, so the map has as many entries as the
    model has classes.
    """
    counts = df.groupBy(F.col(column).cast("string").alias("k")).agg(F.count("*").alias("n"))
    entries = F.sort_array(F.collect_list(F.struct("k", "n")))
    return counts.agg(
        F.map_from_entries(entries).alias("distribution"),
        F.min_by("k", F.struct(-F.col("n"), F.col("k"))).alias("dominant"),
    )


def scoring_summary(scored: DataFrame, status: str, segment: str, spend: str) -> DataFrame:
    """Distributions and spend totals of a scored table, in one row."""
    by_status, by_segment = _distribution(scored, status), _distribution(scored, segment)
    middle = exact_quantiles(scored, spend, {"m": 0.5})

    def of(frame: DataFrame, column: str) -> Column:
        return frame.select(column).scalar()

    return scored.agg(
        F.count("*").alias("n_customers_scored"),
        F.round(F.avg(spend), 2).alias("predicted_spend_mean"),
        F.round(F.sum(spend), 2).alias("predicted_spend_total"),
    ).select(
        "*",
        F.round(of(middle, "m"), 2).alias("predicted_spend_median"),
        of(by_status, "distribution").alias("club_status_distribution"),
        of(by_status, "dominant").alias("dominant_club_status"),
        of(by_segment, "distribution").alias("segment_distribution"),
        of(by_segment, "dominant").alias("dominant_segment"),
    )
