"""The insight report: six aggregates as one markdown text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwise import model
from tillwise.functions.columns import labelled
from tillwise.operators import analysis, marts


def _table(df: DataFrame, order: list[Column]) -> Column:
    """A small grouped table as markdown lines, in a scalar subquery."""
    header = "| " + " | ".join(df.columns) + " |\n|" + " --- |" * len(df.columns)
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    keyed = df.select(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], line.alias("line")).alias("s"))
    lines = F.array_join(F.array_sort(F.collect_list("s")).getField("line"), "\n")
    return keyed.agg(F.concat(F.lit(header + "\n"), lines)).scalar()


def insight_report(
    sales: DataFrame, customers: DataFrame, articles: DataFrame, features: DataFrame
) -> DataFrame:
    """One row, column ``value``: a section per aggregate. Every table has one row per
    segment, age group, product group or channel, never per customer. ``sales`` and ``features`` are
    read several times, so hand in stored tables."""
    cover = analysis.coverage(sales, customers, articles)
    overview = cover.select(
        F.format_string(
            "- %d customers, %d articles, %d transactions (%s -> %s).\n- %d customers bought at least once.",
            "n_customers",
            "n_articles",
            "n_transactions",
            F.col("first_day").cast("string"),
            F.col("last_day").cast("string"),
            "n_buyers",
        )
    ).scalar()
    segments = marts.segment_summary(features).select(
        "value_segment",
        "n_customers",
        F.round("avg_spend", 2).alias("avg_spend"),
        F.round("avg_purchases", 2).alias("avg_purchases"),
        "revenue_share_pct",
    )
    groups = analysis.revenue_by(sales, "product_group_name").select(
        "product_group_name", F.round("revenue", 1).alias("revenue")
    )
    channels = (
        sales.groupBy("sales_channel_id")
        .agg(F.count("*").alias("n"))
        .select(labelled(F.col("sales_channel_id"), model.CHANNELS).alias("channel"), "n")
    )
    text = F.concat(
        F.lit("# Summary of insights\n\n## Overview\n"),
        overview,
        F.lit("\n\n## Customer segments\n"),
        _table(segments, [F.col("value_segment")]),
        F.lit("\n\n## Revenue by age group\n"),
        _table(marts.age_group_summary(features), [F.col("age_group")]),
        F.lit("\n\n## Revenue by product group\n"),
        _table(groups, [-F.col("revenue"), F.col("product_group_name")]),
        F.lit("\n\n## Sales channel\n"),
        _table(channels, [F.col("channel")]),
        F.lit("\n"),
    )
    return sales.sparkSession.range(1).select(text.alias("value"))
