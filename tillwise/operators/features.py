"""Recency, frequency and value features per customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwise import model
from tillwise.functions.columns import UNKNOWN_KEY
from tillwise.operators.quantiles import exact_quantiles
from tillwise.session import materialise


def category_sums(sales: DataFrame, by: str = "customer_id", *more: str) -> DataFrame:
    """Spend, purchases, first and last day per customer and category, and per what else is named.

    ``sales`` needs the customer column, price, t_dat and product_group_name. Sales of unknown customers are nobody's
    features and stay out. Such rows of several parts of the sales can be added up further: see ``rfm_of_sums``.
    """
    known = F.col(by).isNotNull()
    if by == "customer_key":
        known = known & (F.col(by) != UNKNOWN_KEY)
    return sales.where(known).groupBy(by, "product_group_name", *more).agg(
        F.sum("price").alias("spend"),
        F.count("*").alias("n"),
        F.min("t_dat").alias("first"),
        F.max("t_dat").alias("last"),
    )


def rfm_of_sums(sums: DataFrame, by: str = "customer_id") -> DataFrame:
    """Spend, purchases, first and last day and distinct categories per customer, from one row per customer and category."""
    return sums.groupBy(by).agg(
        F.sum("spend").alias("total_spend"),
        F.sum("n").alias("n_transactions"),
        F.min("first").alias("first_purchase"),
        F.max("last").alias("last_purchase"),
        F.count("product_group_name").alias("n_distinct_categories"),
    )


def rfm_base(sales: DataFrame, by: str = "customer_id") -> DataFrame:
    """Spend, purchases, first and last day and distinct categories per customer.

    The first grouping, by customer and category, shrinks the sales to a few rows per customer before
    the second, so a customer with a third of all sales costs no more than its categories.
    """
    return rfm_of_sums(category_sums(sales, by), by)


def with_behaviour(rfm: DataFrame, as_of: str) -> DataFrame:
    """Recency on day ``as_of``, tenure, mean basket and purchases per 30 days."""
    tenure = F.datediff("last_purchase", "first_purchase")
    return rfm.withColumns(
        {
            "recency_days": F.datediff(F.lit(as_of).cast("date"), "last_purchase"),
            "tenure_days": tenure,
            # decimal spend divides and rounds in decimal
            "avg_basket_value": F.round(F.col("total_spend") / F.col("n_transactions"), 4).cast("double"),
            # n / ((tenure + 1) / 30), with the division last so that it rounds once
            "purchase_frequency_per_month": F.round(F.col("n_transactions") * 30 / (tenure + 1), 3),
        }
    )


def _segment(value: Column, thresholds: list[Column]) -> Column:
    low, mid, high = thresholds
    return (
        F.when(value <= low, model.SEGMENTS[0])
        .when(value <= mid, model.SEGMENTS[1])
        .when(value <= high, model.SEGMENTS[2])
        .when(value.isNotNull(), model.SEGMENTS[3])
    )


def with_segment(features: DataFrame, exact: bool = True, strict_edges: bool = False) -> DataFrame:
    """Value segment by quartiles of spend.

    ``exact`` interpolates like a sorted column; otherwise a sketch with 1 % rank error
    decides. ``strict_edges`` makes equal quartile edges an error instead of empty segments.
    ``features`` is read twice, so hand in a stored table.
    """
    value = F.col("total_spend").cast("double")
    if exact:
        marks = {"lowest": 0.0, "low": 0.25, "mid": 0.5, "high": 0.75, "highest": 1.0}
        quartiles = exact_quantiles(features, "total_spend", marks)
    else:
        edges = F.percentile_approx(value, [0.0, 0.25, 0.5, 0.75, 1.0], 100)
        quartiles = features.agg(edges.alias("e")).select(
            *[F.col("e")[i].alias(n) for i, n in enumerate(["lowest", "low", "mid", "high", "highest"])]
        )
    if strict_edges:
        rising = (
            (F.col("lowest") < F.col("low"))
            & (F.col("low") < F.col("mid"))
            & (F.col("mid") < F.col("high"))
            & (F.col("high") < F.col("highest"))
        )
        repeated = F.raise_error(F.lit("quartile edges are not unique")).cast("double")
        quartiles = quartiles.withColumn("low", F.when(rising, F.col("low")).otherwise(repeated))
    edges = quartiles.select(F.struct("low", "mid", "high").alias("t")).scalar()
    named = _segment(value, [F.col(f"_edges.{mark}") for mark in ("low", "mid", "high")])
    return features.withColumn("_edges", edges).withColumn("value_segment", named).drop("_edges")


def with_demographics(
    features: DataFrame, customers: DataFrame, population: str = "buyers", by: str = "customer_id"
) -> DataFrame:
    """Features with customer attributes, for ``buyers`` only or for ``all`` customers."""
    attributes = customers.select(by, *model.DEMOGRAPHICS)
    if population == "buyers":
        return features.join(attributes, by, "left")
    if population == "all":
        return attributes.join(features, by, "left")
    raise ValueError("population is 'buyers' or 'all'")


def customer_features(
    sales: DataFrame,
    customers: DataFrame,
    as_of: str,
    exact: bool = True,
    population: str = "buyers",
    by: str = "customer_id",
) -> DataFrame:
    """The whole feature table, keyed by customer id or by surrogate key.

    The base is stored once: its scan of the sales is the cost. Customer attributes join
    the finished rows, never the sales.
    """
    return features_of_sums(category_sums(sales, by), customers, as_of, exact, population, by)


def features_of_sums(
    sums: DataFrame,
    customers: DataFrame,
    as_of: str,
    exact: bool = True,
    population: str = "buyers",
    by: str = "customer_id",
) -> DataFrame:
    """The feature table from one row per customer and category."""
    base = materialise(with_behaviour(rfm_of_sums(sums, by), as_of), "rfm")
    return with_demographics(with_segment(base, exact), customers, population, by)
