"""Descriptive analyses of sales, customers and articles.

Analyses by a customer attribute first add up sales per customer and join the attribute to
these sums: the join then moves one row per customer, and a customer with very many sales
is no longer a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwise import model
from tillwise.functions.columns import labelled, month_label, ratio, share, week_ending
from tillwise.operators.quantiles import exact_quantiles, same_groups
from tillwise.operators.ranking import running_sum, top_per_group
from tillwise.session import small_side


# --- frequency tables and shares -------------------------------------------------------


def frequency(df: DataFrame, column: str, top: int | None = None, with_share: bool = False) -> DataFrame:
    """Values of a column by count. The share refers to all rows, also when cut to ``top``."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    if with_share:
        counts = with_share_of_total(counts, "n")
    ordered = counts.orderBy(F.desc("n"), column)
    return ordered.limit(top) if top else ordered


def distinct_counts(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.countDistinct
    return df.agg(*[count(c).alias(c) for c in columns])


def with_share_of_total(grouped: DataFrame, measure: str, digits: int | None = None) -> DataFrame:
    """Adds ``share_pct`` of a column to a grouped table. The total comes from the same
    shuffled groups, which Spark reuses, and not from a window over all of them."""
    total = grouped.agg(F.sum(measure)).scalar()
    return grouped.withColumn("share_pct", share(F.col(measure), total, digits))


def cumulative_share(grouped: DataFrame, measure: str, *order: Column) -> DataFrame:
    """Running percent over ordered groups, of which there may be any number; ``order`` ends in a unique key."""
    total = grouped.agg(F.sum(measure)).scalar()
    summed = running_sum(grouped, measure, *order, name="_upto")
    return summed.withColumn("cumulative_pct", share(F.col("_upto"), total)).drop("_upto")


def revenue_by(sales: DataFrame, column: str) -> DataFrame:
    return with_share_of_total(sales.groupBy(column).agg(F.sum("price").alias("revenue")), "revenue", 1)


def channel_mix(sales: DataFrame) -> DataFrame:
    counts = sales.groupBy("sales_channel_id").agg(F.count("*").alias("n"))
    return with_share_of_total(counts, "n", 1).withColumn(
        "channel", labelled(F.col("sales_channel_id"), model.CHANNELS)
    )


# --- time --------------------------------------------------------------------------------


def weekly_volume(sales: DataFrame) -> DataFrame:
    """Sales per week ending on Sunday; weeks without a sale count zero."""
    weeks = sales.groupBy(week_ending(F.col("t_dat")).alias("week")).agg(F.count("*").alias("n"))
    span = weeks.agg(F.sequence(F.min("week"), F.max("week"), F.expr("interval 7 days")).alias("weeks"))
    calendar = span.select(F.explode("weeks").alias("week"))
    return calendar.join(weeks, "week", "left").na.fill(0, ["n"]).orderBy("week")


def monthly_calendar(calendar: DataFrame) -> DataFrame:
    """Revenue and mean temperature per month of the enriched calendar."""
    return (
        calendar.groupBy(month_label(F.col("date")).alias("month"))
        .agg(F.sum("revenue").alias("revenue"), F.avg("temp_mean").alias("avg_temperature"))
        .orderBy("month")
    )


def enrich_calendar(daily: DataFrame, weather: DataFrame, holidays: DataFrame) -> DataFrame:
    """Daily sales with weather and a holiday flag; days without weather keep NULLs."""
    known = holidays.select("date").distinct().withColumn("_holiday", F.lit(True))
    return (
        daily.join(weather, "date", "left")
        .join(known, "date", "left")
        .withColumn("is_holiday", F.coalesce("_holiday", F.lit(False)))
        .withColumn("month", month_label(F.col("date")))
        .drop("_holiday")
    )


def flag_sale_periods(daily: DataFrame, periods: DataFrame) -> DataFrame:
    """Marks days inside any closed period (period_start, period_end).

    Periods unfold into their days, so the range test is an equality join, and a day inside
    two overlapping periods still comes out once.
    """
    days = (
        periods.select(F.explode(F.sequence("period_start", "period_end")).alias("date"))
        .distinct()
        .withColumn("_inside", F.lit(True))
    )
    return (
        daily.join(days, "date", "left")
        .withColumn("is_sale_period", F.coalesce("_inside", F.lit(False)))
        .drop("_inside")
    )


def compare_days(daily: DataFrame, flag: str) -> DataFrame:
    """Mean, median and count of revenue on flagged and other days (one row per day, so the
    built-in median holds a few thousand values)."""
    revenue = F.col("revenue").cast("double")
    return daily.groupBy(flag).agg(
        ratio(F.sum("revenue"), F.count("*")).alias("mean_revenue"),
        F.median(revenue).alias("median_revenue"),
        ratio(F.sum("n_transactions"), F.count("*")).alias("mean_transactions"),
        F.median("n_transactions").alias("median_transactions"),
        F.count("*").alias("n_days"),
    )


# --- customers ---------------------------------------------------------------------------


def _per_customer(sales: DataFrame, *more: str) -> DataFrame:
    return sales.groupBy("customer_id", *more).agg(F.count("*").alias("n"), F.sum("price").alias("spend"))


def price_by_age(sales: DataFrame, customers: DataFrame) -> DataFrame:
    sums = _per_customer(sales).join(customers.select("customer_id", "age_group"), "customer_id", "left")
    return sums.groupBy("age_group").agg(
        F.sum("n").alias("n_purchases"), ratio(F.sum("spend"), F.sum("n")).alias("mean_price")
    )


def age_category_counts(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Long table age_group, product_group_name, n."""
    sums = _per_customer(sales, "product_group_name")
    return (
        sums.join(customers.select("customer_id", "age_group"), "customer_id", "left")
        .groupBy("age_group", "product_group_name")
        .agg(F.sum("n").alias("n"))
    )


def pivot_counts(counts: DataFrame, row: str, column: str, values: list[str], measure: str = "n") -> DataFrame:
    """Wide form with 0 for absent pairs. ``values`` fixes the columns, so no extra pass."""
    return counts.groupBy(row).pivot(column, values).sum(measure).na.fill(0)


def row_percent(counts: DataFrame, row: str, measure: str = "n") -> DataFrame:
    """Share of each cell in its row, for grouped counts in long form."""
    return counts.withColumn("pct", share(F.col(measure), F.sum(measure).over(Window.partitionBy(row))))


def top_category(counts: DataFrame, group: str, label: str, measure: str = "n") -> DataFrame:
    """Label with the highest count per group; the first label on a tie."""
    best = F.min_by(label, F.struct(-F.col(measure), F.col(label)))
    return counts.groupBy(group).agg(best.alias(label), F.max(measure).alias(measure))


def crosstab_top(df: DataFrame, row: str, column: str, top: int = 10) -> DataFrame:
    """Counts of two columns, for the ``top`` most frequent row values."""
    counts = df.groupBy(row, column).agg(F.count("*").alias("n"))
    frequent = counts.groupBy(row).agg(F.sum("n").alias("_n")).orderBy(F.desc("_n"), row).limit(top)
    return counts.join(frequent.select(row), row, "left_semi")


def purchases_by_status(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Per club status: after the sum per customer, distinct buyers are simply the rows."""
    sums = _per_customer(sales).join(customers.select("customer_id", "club_member_status"), "customer_id", "left")
    return sums.groupBy("club_member_status").agg(
        F.sum("n").alias("n_transactions"),
        F.count("customer_id").alias("n_buyers"),
        ratio(F.sum("n"), F.count("customer_id")).alias("purchases_per_buyer"),
        ratio(F.sum("spend"), F.sum("n")).alias("mean_price"),
    )


def age_by(customers: DataFrame, group: str | Column, name: str) -> DataFrame:
    """Median, mean and number of known ages per group (few distinct ages: bounded map)."""
    key = F.col(group) if isinstance(group, str) else group
    return customers.groupBy(key.alias(name)).agg(
        F.median("age").alias("median_age"), F.avg("age").alias("mean_age"), F.count("age").alias("n")
    )


def vip_ages(features: DataFrame) -> DataFrame:
    return age_by(features, F.col("value_segment") == model.VIP, "is_vip")


def coverage(sales: DataFrame, customers: DataFrame, articles: DataFrame) -> DataFrame:
    """First and last day, buyers against customers, sold against listed articles; one row."""
    return sales.agg(
        F.min("t_dat").alias("first_day"),
        F.max("t_dat").alias("last_day"),
        F.count("*").alias("n_transactions"),
    ).select(
        "*",
        sales.select("customer_id").distinct().agg(F.count("customer_id")).scalar().alias("n_buyers"),
        customers.agg(F.count("*")).scalar().alias("n_customers"),
        sales.select("article_id").distinct().agg(F.count("article_id")).scalar().alias("n_sold_articles"),
        articles.agg(F.count("*")).scalar().alias("n_articles"),
    )


def against_segment(features: DataFrame, summary: DataFrame) -> DataFrame:
    """Every customer beside the mean of their own segment (one row per segment)."""
    means = summary.select("value_segment", "avg_spend", "avg_purchases", "revenue_share_pct")
    spend = F.col("total_spend").cast("double")
    delta = F.coalesce(F.try_divide((spend - F.col("avg_spend")) * 100, F.col("avg_spend")), F.lit(0.0))
    return features.join(small_side(means), "value_segment", "left").select(
        "customer_id",
        "value_segment",
        "total_spend",
        "avg_spend",
        F.round(delta, 1).alias("delta_pct"),
        "n_transactions",
        F.round("avg_purchases", 2).alias("segment_avg_purchases"),
        "revenue_share_pct",
    )


def profiles(features: DataFrame, keys: DataFrame) -> DataFrame:
    """Feature rows of the customers in ``keys`` (column customer_id)."""
    return features.join(keys.select("customer_id").distinct(), "customer_id", "left_semi")


def last_purchases(fact: DataFrame, customers: DataFrame, articles: DataFrame, n: int = 10) -> DataFrame:
    """Latest ``n`` purchases of every customer, with names; the cut comes before the joins."""
    recent = top_per_group(
        fact, ["customer_key"], n, F.desc("date_key"), F.asc("article_key"), F.asc("price"), F.asc("sales_channel_id")
    )
    return (
        recent.join(customers.select("customer_key", "customer_id"), "customer_key")
        .join(articles.select("article_key", "prod_name", "product_group_name"), "article_key")
        .withColumn("channel", labelled(F.col("sales_channel_id"), model.CHANNELS))
    )


def top_categories(sales: DataFrame, n: int = 5) -> DataFrame:
    counts = sales.groupBy("customer_id", "product_group_name").agg(F.count("*").alias("n_purchases"))
    return top_per_group(counts, ["customer_id"], n, F.desc("n_purchases"), F.asc("product_group_name"))


def top_articles(sales: DataFrame, articles: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` best-selling articles; names are attached to these rows only."""
    best = (
        sales.groupBy("article_id").agg(F.count("*").alias("n_sales")).orderBy(F.desc("n_sales"), "article_id").limit(n)
    )
    names = articles.select("article_id", "prod_name", "product_group_name")
    return best.join(names, "article_id", "left")


# --- conversations -----------------------------------------------------------------------


def recent_turns(turns: DataFrame, n: int = 6) -> DataFrame:
    """Last ``n`` turns of each conversation as labelled lines in reading order."""
    label = F.when(F.col("role") == "user", "User").otherwise("Assistant")
    last = top_per_group(turns, ["conv_id"], n, F.desc("turn")).withColumn(
        "line", F.concat(label, F.lit(" : "), F.col("text"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("turn", "line")))
    return last.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"), F.array_join(ordered.getField("line"), "\n").alias("history")
    )


# --- distributions -----------------------------------------------------------------------


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Counts in ``bins`` equal-width bins over the range; empty bins are listed with zero."""
    x = F.col(value).cast("double")
    limits = df.agg(F.struct(F.min(x).alias("low"), F.max(x).alias("high")).alias("l")).scalar()
    low, high = F.col("_l.low"), F.col("_l.high")
    width = (high - low) / bins
    number = F.when(high == low, F.lit(1)).otherwise(F.least(F.floor((F.col("_x") - low) / width) + 1, F.lit(bins)))
    placed = df.select(x.alias("_x")).where("_x IS NOT NULL").withColumn("_l", limits)
    counts = placed.select(number.cast("long").alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))
    every = df.sparkSession.range(1, bins + 1).withColumnRenamed("id", "bin").withColumn("_l", limits)
    return every.join(counts, "bin", "left").select(
        "bin",
        F.coalesce("n", F.lit(0)).alias("n"),
        (low + (F.col("bin") - 1) * width).alias("low"),
        (low + F.col("bin") * width).alias("high"),
    )


def box_summary(df: DataFrame, value: str, group: str) -> DataFrame:
    """Quartiles, whiskers at 1.5 interquartile ranges and outliers, per group. ``df`` is read
    three times: hand in a stored table."""
    marks = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    quartiles = exact_quantiles(df, value, marks, by=[group]).withColumnRenamed(group, f"{group}_of")
    spread = F.col("q3") - F.col("q1")
    fences = quartiles.withColumns(
        {"_low": F.col("q1") - 1.5 * spread, "_high": F.col("q3") + 1.5 * spread}
    )
    x = F.col(value).cast("double")
    inside = x.between(F.col("_low"), F.col("_high"))
    return (
        df.where(x.isNotNull())
        .join(small_side(fences), same_groups([group], "_of"))
        .groupBy(group, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, x)).alias("whisker_low"),
            F.max(F.when(inside, x)).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
            F.count("*").alias("n"),
        )
    )
