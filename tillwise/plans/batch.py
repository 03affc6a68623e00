"""The batch load: cleaned inputs to star schema and marts, and the recompute from the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwise.operators import cleaning, features, marts, star
from tillwise.plans import upkeep
from tillwise.sources.warehouse import Warehouse
from tillwise.streaming import merge
from tillwise.streaming.merge import DIM_CUSTOMER, DIM_DATE, FACT, PIPELINE, last_merged, merged_dim_customer

MARTS = ["customers_features_train", "products_performance", "daily_sales", "customer_segments_summary"]
TABLES = ["dim_customer", "dim_article", "dim_date", "fact_transaction", *MARTS]


def load(
    warehouse: Warehouse,
    transactions: DataFrame,
    customers: DataFrame,
    articles: DataFrame,
    as_of: str,
    keep_merged: bool = False,
) -> None:
    """Load of all eight tables."""
    load_star(warehouse, transactions, customers, articles, keep_merged)
    recompute(warehouse, as_of)


def load_star(
    warehouse: Warehouse, transactions: DataFrame, customers: DataFrame, articles: DataFrame, keep_merged: bool = False
) -> None:
    """Dimensions and fact. The raw sales are scanned once, for the fact; everything after
    that reads the stored, columnar tables.

    A load replaces the fact with all that was merged into it. ``keep_merged``: the files hold
    none of the merged sales, which stay beside the new fact.
    """
    clean = cleaning.clean_customers(customers)
    sales = cleaning.clean_transactions(transactions) if dict(transactions.dtypes)["t_dat"] == "string" else transactions
    listed = cleaning.clean_articles(articles)
    warehouse.overwrite(DIM_CUSTOMER, star.dim_customer(clean))
    warehouse.overwrite("dim_article", star.dim_article(listed))
    upto = warehouse.holds_upto(FACT) if keep_merged else last_merged(warehouse)[1]
    warehouse.overwrite(FACT, star.with_month(star.fact_transaction(sales)), partition_by="month_key", holds_upto=upto)
    days = warehouse.read(FACT).select(star.key_date(F.col("date_key")).alias("t_dat"))
    warehouse.overwrite(DIM_DATE, star.dim_date(days))


def recompute(warehouse: Warehouse, as_of: str, pipeline: str = PIPELINE) -> str:
    """Rebuild the four marts from the sums of sales, which take in what was merged since; tells how they did.

    No sale is read but those of new batches, unless the star schema was loaded anew. Customer and article attributes join the sums.
    """
    done = upkeep.upkeep(warehouse, pipeline)
    articles, customers = warehouse.read("dim_article"), merged_dim_customer(warehouse, pipeline)
    by_category = upkeep.sums(warehouse, "sums_customer")
    frame = features.features_of_sums(by_category, customers, as_of, by="customer_key")
    warehouse.overwrite("customers_features_train", cleaning.guard_features(frame))
    counts = upkeep.sums(warehouse, "sums_article").withColumnRenamed("article_key", "article_id")
    products = marts.named_products(counts, articles)
    warehouse.overwrite("products_performance", products.withColumnRenamed("article_id", "article_key"))
    warehouse.overwrite("daily_sales", marts.dated_sales(upkeep.sums(warehouse, "sums_day")).drop("date"))
    summary = marts.segment_summary(warehouse.read("customers_features_train"))
    warehouse.overwrite("customer_segments_summary", summary)
    return done


def compact(warehouse: Warehouse, pipeline: str = PIPELINE) -> int:
    """The star schema written anew with all merged batches inside; the sums, which hold the same sales, stay."""
    before = upkeep.source(warehouse)
    upto = merge.compact(warehouse, pipeline)
    upkeep.moved(warehouse, before)
    return upto
