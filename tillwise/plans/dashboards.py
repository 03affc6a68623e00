"""Dashboard queries as SQL over the marts.

``panel(spark, marts, name)`` runs one of them; ``marts`` maps table names to DataFrames.
Ties in ordered results fall to the label, so a top-k is the same on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_DAY = "to_date(CAST(date_key AS STRING), 'yyyyMMdd')"
_MONTH = f"date_format({_DAY}, 'yyyy-MM')"

PANELS: dict[str, str] = {
    # sales overview
    "g01_revenue_per_day": f"SELECT {_DAY} AS time, revenue FROM {{daily_sales}} ORDER BY date_key",
    "g02_transactions_per_month": f"""
        SELECT {_MONTH} AS month, sum(n_transactions) AS n_transactions
        FROM {{daily_sales}} GROUP BY ALL ORDER BY month""",
    "g03_revenue_per_month": f"""
        SELECT {_MONTH} AS month, sum(revenue) AS revenue FROM {{daily_sales}} GROUP BY ALL ORDER BY month""",
    "g04_average_basket": """
        SELECT round(sum(revenue) / nullif(sum(n_transactions), 0), 2) AS average_ticket FROM {daily_sales}""",
    "g05_total_sales": "SELECT sum(n_transactions) AS total_sales FROM {daily_sales}",
    "g06_transactions_per_day": f"SELECT {_DAY} AS time, n_transactions FROM {{daily_sales}} ORDER BY date_key",
    "g07_average_daily_revenue": "SELECT round(sum(revenue) / count(revenue), 2) AS avg_daily_revenue FROM {daily_sales}",
    # product analytics; the sales are added up per article before names come in
    "g08_top_products_by_count": """
        SELECT a.prod_name, sum(s.n) AS sales
        FROM (SELECT article_key, count(*) AS n FROM {fact_transaction} GROUP BY article_key) s
        JOIN {dim_article} a ON s.article_key = a.article_key
        GROUP BY a.prod_name ORDER BY sales DESC, prod_name LIMIT 10""",
    "g09_top_products_by_revenue": """
        SELECT a.prod_name, sum(s.spend) AS revenue
        FROM (SELECT article_key, sum(price) AS spend FROM {fact_transaction} GROUP BY article_key) s
        JOIN {dim_article} a ON s.article_key = a.article_key
        GROUP BY a.prod_name ORDER BY revenue DESC, prod_name LIMIT 10""",
    "g10_revenue_by_department": """
        SELECT a.department_name, sum(s.spend) AS revenue
        FROM (SELECT article_key, sum(price) AS spend FROM {fact_transaction} GROUP BY article_key) s
        JOIN {dim_article} a ON s.article_key = a.article_key
        GROUP BY a.department_name ORDER BY revenue DESC, department_name""",
    "g11_top_product_groups": """
        SELECT product_group_name, sum(n_sales) AS sales FROM {products_performance}
        GROUP BY product_group_name ORDER BY sales DESC, product_group_name LIMIT 10""",
    "g12_sales_by_colour": """
        SELECT a.colour_group_name, sum(s.n) AS sales
        FROM (SELECT article_key, count(*) AS n FROM {fact_transaction} GROUP BY article_key) s
        JOIN {dim_article} a ON s.article_key = a.article_key
        GROUP BY a.colour_group_name ORDER BY sales DESC, colour_group_name""",
    # customer analytics
    "g13_customers_by_age_group": """
        SELECT age_group, count(*) AS customers FROM {dim_customer} GROUP BY age_group ORDER BY age_group""",
    "g14_customers_by_club_status": """
        SELECT club_member_status, count(*) AS customers FROM {dim_customer} GROUP BY club_member_status""",
    "g15_customers_by_newsletter": """
        SELECT fashion_news_frequency, count(*) AS customers FROM {dim_customer} GROUP BY fashion_news_frequency""",
    "g16_top_customers": """
        SELECT c.customer_id, f.total_spend
        FROM {customers_features_train} f JOIN {dim_customer} c ON f.customer_key = c.customer_key
        ORDER BY f.total_spend DESC, c.customer_id LIMIT 20""",
    "g17_spend_by_age_group": """
        SELECT c.age_group, round(sum(f.total_spend) / count(f.total_spend), 2) AS avg_spend
        FROM {customers_features_train} f JOIN {dim_customer} c ON f.customer_key = c.customer_key
        GROUP BY c.age_group ORDER BY avg_spend DESC, age_group""",
    "g18_number_of_customers": "SELECT count(*) AS customers FROM {dim_customer}",
    # customer segmentation
    "g19_segment_sizes": "SELECT value_segment, n_customers FROM {customer_segments_summary}",
    "g20_revenue_by_segment": """
        SELECT value_segment, segment_revenue FROM {customer_segments_summary} ORDER BY segment_revenue DESC""",
    "g21_spend_by_segment": """
        SELECT value_segment, avg_spend FROM {customer_segments_summary} ORDER BY avg_spend DESC""",
    "g22_purchases_by_segment": """
        SELECT value_segment, avg_purchases FROM {customer_segments_summary} ORDER BY avg_purchases DESC""",
    # from the product mart
    "g23_top_products_of_mart": """
        SELECT prod_name, n_sales FROM {products_performance} ORDER BY n_sales DESC, article_key LIMIT 10""",
    "g24_sales_by_index": """
        SELECT index_name, sum(n_sales) AS sales FROM {products_performance}
        GROUP BY index_name ORDER BY sales DESC, index_name""",
}


def panel(spark: SparkSession, marts: dict[str, DataFrame], name: str) -> DataFrame:
    sql = PANELS[name]
    used = {table: frame for table, frame in marts.items() if f"{{{table}}}" in sql}
    return spark.sql(sql, **used)
