"""Cleaning of the three input tables and general column preparation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillwise import model
from tillwise.functions.columns import age_group


def drop_sparse(customers: DataFrame) -> DataFrame:
    """FN and Active are empty where the answer is "no"; they are not missing values."""
    return customers.drop("FN", "Active")


def null_profile(df: DataFrame, digits: int = 2) -> DataFrame:
    """Columns that contain NULL, with count and percent, most empty first; one pass."""
    counts = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns], F.count("*").alias("_rows")
    )
    return (
        counts.unpivot(["_rows"], df.columns, "column_name", "n_null")
        .where("n_null > 0")
        .select("column_name", "n_null", F.round(F.col("n_null") * 100.0 / F.col("_rows"), digits).alias("pct_null"))
        .orderBy(F.desc("n_null"), "column_name")
    )


def most_frequent(df: DataFrame, column: str) -> Column:
    """The most frequent value as a scalar subquery; the smallest one on a tie."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), column)
        .limit(1)
        .select(column)
        .scalar()
    )


def median_age(customers: DataFrame, exact: bool = True) -> Column:
    """Median age as a scalar subquery; an error if no age is known.

    Ages have few distinct values, so the exact form keeps a map of bounded size.
    """
    middle = F.median("age") if exact else F.percentile_approx("age", 0.5, 1000)
    checked = F.coalesce(middle, F.raise_error(F.lit("no valid age values found")).cast("double"))
    return customers.agg(checked.alias("m")).scalar()


def impute_customers(customers: DataFrame, exact: bool = True) -> DataFrame:
    fill = {c: most_frequent(customers, c) for c in ("club_member_status", "fashion_news_frequency")}
    fill["age"] = median_age(customers, exact)
    return customers.withColumns({c: F.coalesce(F.col(c), value) for c, value in fill.items()})


def clean_customers(customers: DataFrame, exact: bool = True, strict_ages: bool = False) -> DataFrame:
    """Drop sparse columns, fill age and the two categories, add the age group."""
    filled = impute_customers(drop_sparse(customers), exact)
    return filled.withColumn("age_group", age_group(F.col("age"), strict_ages))


def clean_articles(articles: DataFrame) -> DataFrame:
    return articles


def clean_transactions(transactions: DataFrame) -> DataFrame:
    """Parse the sale day; text that is not a day becomes NULL."""
    return transactions.withColumn("t_dat", F.try_to_date(F.col("t_dat"), "yyyy-MM-dd"))


def sale_rules() -> dict[str, Column]:
    """The conditions a sale must meet, by name. A NULL condition counts as failed."""
    price = F.col("price")
    rules = {
        "customer_id_missing": F.col("customer_id").isNotNull(),
        "article_id_missing": F.col("article_id").isNotNull(),
        "price_missing": price.isNotNull() & ~F.isnan(price.cast("double")),
        "price_not_positive": price.isNull() | F.isnan(price.cast("double")) | (price > 0),
        "t_dat_missing": F.col("t_dat").isNotNull(),
        "t_dat_not_a_date": F.col("t_dat").isNull()
        | F.try_to_date(F.col("t_dat").cast("string"), "yyyy-MM-dd").isNotNull(),
    }
    return {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}


def with_failed_rules(sales: DataFrame) -> DataFrame:
    """Adds ``rejection_reason``: names of the failed rules, empty for a valid sale."""
    failed = F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in sale_rules().items()]))
    return sales.withColumn("rejection_reason", failed)


def split_valid(sales: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid and rejected sales; every input row is in exactly one of them."""
    marked = with_failed_rules(sales)
    valid = marked.where(F.size("rejection_reason") == 0).drop("rejection_reason")
    return (
        valid.withColumn("t_dat", F.to_date(F.col("t_dat"), "yyyy-MM-dd")),
        marked.where(F.size("rejection_reason") > 0),
    )


def fill_missing(df: DataFrame, columns: list[str], value: float = 0) -> DataFrame:
    return df.na.fill(value, subset=columns)


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which all ``columns`` are known."""
    return df.na.drop(subset=list(columns))


def common_columns(a: DataFrame, b: DataFrame) -> list[str]:
    other = set(b.columns)
    return [c for c in a.columns if c in other]


def guard_features(features: DataFrame) -> DataFrame:
    """Stop if calendar enrichment has leaked into the customer features."""
    leaked = model.ENRICHMENT_COLUMNS & set(features.columns)
    if leaked:
        raise ValueError(f"calendar columns in the feature table: {sorted(leaked)}")
    return features


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
