"""Dimensions and the fact of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwise import model
from tillwise.functions.columns import date_key, key_date, month_label, surrogate_key

ARTICLE_COLUMNS = [
    "article_id",
    "prod_name",
    "product_group_name",
    "product_type_name",
    "department_name",
    "colour_group_name",
    "index_name",
    "section_name",
]


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", *model.DEMOGRAPHICS, surrogate_key(F.col("customer_id")).alias("customer_key")
    )


def dim_article(articles: DataFrame) -> DataFrame:
    kept = [c for c in ARTICLE_COLUMNS if c in articles.columns]
    return articles.select(*kept, F.col("article_id").alias("article_key"))


def dim_date(sales: DataFrame) -> DataFrame:
    day = F.col("date")
    return (
        sales.select(F.col("t_dat").alias("date"))
        .distinct()
        .select("date", date_key(day).alias("date_key"), F.month(day).alias("month"), F.year(day).alias("year"))
    )


def fact_transaction(sales: DataFrame) -> DataFrame:
    """One row per sold item. Needs no dimension: the keys derive from the sale itself."""
    return sales.select(
        surrogate_key(F.col("customer_id")).alias("customer_key"),
        F.col("article_id").alias("article_key"),
        date_key(F.col("t_dat")).alias("date_key"),
        "price",
        "sales_channel_id",
    )


def with_month(fact: DataFrame) -> DataFrame:
    """The partition column of the stored fact."""
    return fact.withColumn("month_key", F.floor(F.col("date_key") / 100).cast("int"))


def missing_dates(sales: DataFrame, known: DataFrame) -> DataFrame:
    """``dim_date`` rows for sale days that ``known`` does not have yet."""
    return dim_date(sales).join(known.select("date_key"), "date_key", "left_anti")


def master(sales: DataFrame, customers: DataFrame, articles: DataFrame) -> DataFrame:
    """Sales with customer and article attributes.

    No join is hinted: AQE broadcasts a side whose measured size allows it, and splits hot
    customers or articles otherwise. Attributes nobody reads are pruned before the join.
    """
    return sales.join(customers, "customer_id", "left").join(articles, "article_id", "left")


def warehouse_master(fact: DataFrame, customers: DataFrame, articles: DataFrame) -> DataFrame:
    """The same rows from the stored star schema; ``t_dat`` comes back from the date key."""
    names = articles.select("article_key", "article_id", "product_group_name", "prod_name")
    return (
        fact.join(customers, "customer_key", "left")
        .join(names, "article_key", "left")
        .withColumn("t_dat", key_date(F.col("date_key")))
    )


def with_calendar_parts(sales: DataFrame) -> DataFrame:
    day = F.col("t_dat")
    return sales.withColumns(
        {"date_key": date_key(day), "month": F.month(day), "year": F.year(day), "month_label": month_label(day)}
    )
