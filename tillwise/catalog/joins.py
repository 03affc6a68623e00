"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise.catalog.base import query
from tillwise.operators import analysis, features, star


@query(
    "j01_master_join",
    """SELECT age_group, product_group_name, COUNT(*) AS n, SUM(price)::DOUBLE AS revenue
  FROM tx LEFT JOIN cust_clean USING (customer_id) LEFT JOIN art USING (article_id) GROUP BY ALL""",
)
def j01(t):
    joined = star.master(t.sales, t.customers_clean, t.articles)
    return joined.groupBy("age_group", "product_group_name").agg(
        F.count("*").alias("n"), F.sum("price").alias("revenue")
    )


@query(
    "j02_warehouse_join",
    """SELECT customer_id, product_group_name, COUNT(*) AS n, SUM(price)::DOUBLE AS revenue,
  CAST(MAX(t_dat) AS VARCHAR) AS last_day FROM tx LEFT JOIN art USING (article_id) GROUP BY ALL""",
)
def j02(t):
    joined = star.warehouse_master(t.fact, t.dim_customer, t.dim_article)
    return joined.groupBy("customer_id", "product_group_name").agg(
        F.count("*").alias("n"), F.sum("price").alias("revenue"), F.max("t_dat").alias("last_day")
    )


@query(
    "j03_new_dates",
    """SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS date_key,
  CAST(month(ts) AS BIGINT) AS month, CAST(year(ts) AS BIGINT) AS year FROM events
  WHERE CAST(ts AS DATE) NOT IN (SELECT t_dat FROM tx)""",
)
def j03(t):
    streamed = t.raw("events").select(F.col("ts").cast("date").alias("t_dat"))
    return star.missing_dates(streamed, star.dim_date(t.sales))


@query(
    "j04_inner_joins",
    """SELECT c.age_group, a.department_name, COUNT(*) AS n FROM tx JOIN art a USING (article_id)
  JOIN cust_clean c USING (customer_id) GROUP BY ALL""",
)
def j04(t):
    sales = t.sales.groupBy("customer_id", "article_id").agg(F.count("*").alias("n"))
    return (
        sales.join(t.articles.select("article_id", "department_name"), "article_id")
        .join(t.customers_clean.select("customer_id", "age_group"), "customer_id")
        .groupBy("age_group", "department_name")
        .agg(F.sum("n").alias("n"))
    )


@query(
    "j05_star_join",
    """SELECT customer_id, article_id, prod_name, price::DOUBLE AS price, CAST(sales_channel_id AS BIGINT) AS sales_channel_id,
  CAST(t_dat AS VARCHAR) AS date FROM tx JOIN art USING (article_id) JOIN cust_clean USING (customer_id)
  WHERE age_group = '70+' ORDER BY t_dat DESC, customer_id, article_id, price LIMIT 50""",
)
def j05(t):
    dates = star.dim_date(t.sales)
    return (
        t.fact.join(t.dim_customer.where("age_group = '70+'").select("customer_key", "customer_id"), "customer_key")
        .join(t.dim_article.select("article_key", "article_id", "prod_name"), "article_key")
        .join(dates.select("date_key", "date"), "date_key")
        .select("customer_id", "article_id", "prod_name", "price", "sales_channel_id", "date")
        .orderBy(F.desc("date"), "customer_id", "article_id", "price")
        .limit(50)
    )


@query(
    "j06_features_buyers",
    """SELECT customer_id, n_transactions, age_group, club_member_status FROM rfm LEFT JOIN cust_clean USING (customer_id)""",
)
def j06(t):
    joined = features.with_demographics(features.rfm_base(t.named_sales), t.customers_clean, "buyers")
    return joined.select("customer_id", "n_transactions", "age_group", "club_member_status")


@query(
    "j06_features_all",
    """SELECT customer_id, n_transactions, age_group, club_member_status FROM cust_clean LEFT JOIN rfm USING (customer_id)""",
)
def j06_all(t):
    joined = features.with_demographics(features.rfm_base(t.named_sales), t.customers_clean, "all")
    return joined.select("customer_id", "n_transactions", "age_group", "club_member_status")


@query(
    "j07_weather_join",
    "SELECT CAST(d AS VARCHAR) AS date, n_transactions, temp_mean, precipitation FROM cal",
)
def j07(t):
    calendar = analysis.enrich_calendar(t.daily, t.weather, t.holidays)
    return calendar.select("date", "n_transactions", "temp_mean", "precipitation")


@query("j08_holiday_flag", "SELECT CAST(d AS VARCHAR) AS date, is_holiday, month FROM cal")
def j08(t):
    return analysis.enrich_calendar(t.daily, t.weather, t.holidays).select("date", "is_holiday", "month")


@query(
    "j09_period_join",
    """SELECT is_sale_period, COUNT(*) AS n_days, CAST(SUM(n_transactions) AS BIGINT) AS n FROM (
   SELECT n_transactions, EXISTS (SELECT 1 FROM sale_spans WHERE d BETWEEN s AND e) AS is_sale_period FROM dayrev) GROUP BY 1""",
)
def j09(t):
    flagged = analysis.flag_sale_periods(t.daily, t.sale_periods)
    return flagged.groupBy("is_sale_period").agg(F.count("*").alias("n_days"), F.sum("n_transactions").alias("n"))


@query(
    "j10_against_segment",
    """SELECT customer_id, value_segment, total_spend::DOUBLE AS total_spend, avg_spend,
  round((total_spend::DOUBLE - avg_spend) * 100 / avg_spend, 1) AS delta_pct, n_transactions,
  round(avg_purchases, 2) AS segment_avg_purchases,
  round(segment_revenue::DOUBLE * 100 / (SELECT SUM(total_spend)::DOUBLE FROM rfm), 1) AS revenue_share_pct
  FROM feat JOIN segsum USING (value_segment)""",
)
def j10(t):
    return analysis.against_segment(t.features, t.segment_summary)


@query(
    "j11_enriched_messages",
    """SELECT age_group, product_group_name, COUNT(*) AS n FROM events
  LEFT JOIN cust_clean ON customer_id = CAST(user_id AS VARCHAR) LEFT JOIN art ON article_id = event_id % 2000 GROUP BY ALL""",
)
def j11(t):
    from tillwise.streaming.ingest import enrich
    from tillwise.streaming.messages import parse_messages

    raw = t.encoded_sales().withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    enriched = enrich(parse_messages(raw), t.customers_clean, t.articles)
    return enriched.groupBy("age_group", "product_group_name").agg(F.count("*").alias("n"))


@query(
    "j12_top_articles_named",
    """SELECT article_id, n_sales, prod_name, product_group_name FROM (
  SELECT article_id, COUNT(*) AS n_sales FROM tx GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10) LEFT JOIN art USING (article_id)""",
)
def j12(t):
    return analysis.top_articles(t.sales, t.articles)


@query(
    "j13_customer_profiles",
    f"""SELECT customer_id, value_segment, club_member_status, total_spend::DOUBLE AS total_spend, n_transactions,
  avg_basket_value, tenure_days, recency_days, purchase_frequency_per_month, n_distinct_categories, age, age_group,
  fashion_news_frequency FROM feat WHERE customer_id IN (SELECT DISTINCT CAST(user_id AS VARCHAR) FROM events)""",
)
def j13(t):
    keys = t.raw("events").select(F.col("user_id").cast("string").alias("customer_id"))
    return analysis.profiles(t.features, keys).select(
        "customer_id",
        "value_segment",
        "club_member_status",
        "total_spend",
        "n_transactions",
        "avg_basket_value",
        "tenure_days",
        "recency_days",
        "purchase_frequency_per_month",
        "n_distinct_categories",
        "age",
        "age_group",
        "fashion_news_frequency",
    )
