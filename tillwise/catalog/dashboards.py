"""Dashboard panels over marts that are derived on demand."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise.catalog.base import cents, query, rounded
from tillwise.functions.columns import surrogate_key
from tillwise.operators import marts
from tillwise.plans.dashboards import PANELS, panel

_MONTH = "strftime(d, '%Y-%m')"
_SPEND = "SELECT {0}, SUM(price)::DOUBLE AS revenue FROM tx JOIN art USING (article_id) GROUP BY 1"
_SALES = "SELECT {0}, COUNT(*) AS sales FROM tx JOIN art USING (article_id) GROUP BY 1"

CHECKS = {
    "g01_revenue_per_day": "SELECT CAST(d AS VARCHAR) AS time, revenue::DOUBLE AS revenue FROM dayrev",
    "g02_transactions_per_month": f"SELECT {_MONTH} AS month, CAST(SUM(n_transactions) AS BIGINT) AS n_transactions FROM dayrev GROUP BY 1",
    "g03_revenue_per_month": f"SELECT {_MONTH} AS month, SUM(revenue)::DOUBLE AS revenue FROM dayrev GROUP BY 1",
    "g04_average_basket": f"SELECT {rounded(cents('SUM(price)'), 'COUNT(*) * 100', 2)} AS average_ticket FROM tx",
    "g05_total_sales": "SELECT COUNT(*) AS total_sales FROM tx",
    "g06_transactions_per_day": "SELECT CAST(d AS VARCHAR) AS time, n_transactions FROM dayrev",
    "g07_average_daily_revenue": f"SELECT {rounded(cents('SUM(revenue)'), 'COUNT(*) * 100', 2)} AS avg_daily_revenue FROM dayrev",
    "g08_top_products_by_count": _SALES.format("prod_name") + " ORDER BY 2 DESC, 1 LIMIT 10",
    "g09_top_products_by_revenue": _SPEND.format("prod_name") + " ORDER BY 2 DESC, 1 LIMIT 10",
    "g10_revenue_by_department": _SPEND.format("department_name"),
    "g11_top_product_groups": _SALES.format("product_group_name") + " ORDER BY 2 DESC, 1 LIMIT 10",
    "g12_sales_by_colour": _SALES.format("colour_group_name"),
    "g13_customers_by_age_group": "SELECT age_group, COUNT(*) AS customers FROM cust_clean GROUP BY 1",
    "g14_customers_by_club_status": "SELECT club_member_status, COUNT(*) AS customers FROM cust_clean GROUP BY 1",
    "g15_customers_by_newsletter": "SELECT fashion_news_frequency, COUNT(*) AS customers FROM cust_clean GROUP BY 1",
    "g16_top_customers": "SELECT customer_id, total_spend::DOUBLE AS total_spend FROM rfm ORDER BY rfm.total_spend DESC, 1 LIMIT 20",
    "g17_spend_by_age_group": f"""SELECT age_group, {rounded(cents('SUM(total_spend)'), 'COUNT(*) * 100', 2)} AS avg_spend
        FROM rfm JOIN cust_clean USING (customer_id) GROUP BY 1""",
    "g18_number_of_customers": "SELECT COUNT(*) AS customers FROM cust",
    "g19_segment_sizes": "SELECT value_segment, n_customers FROM segsum",
    "g20_revenue_by_segment": "SELECT value_segment, segment_revenue::DOUBLE AS segment_revenue FROM segsum",
    "g21_spend_by_segment": "SELECT value_segment, avg_spend FROM segsum",
    "g22_purchases_by_segment": "SELECT value_segment, avg_purchases FROM segsum",
    "g23_top_products_of_mart": """SELECT prod_name, n_sales FROM (SELECT article_id, any_value(prod_name) AS prod_name, COUNT(*) AS n_sales
        FROM tx LEFT JOIN art USING (article_id) GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 10)""",
    "g24_sales_by_index": _SALES.format("index_name"),
}


class _Marts(dict):
    """Marts by name, derived when a panel first asks for one."""

    def __init__(self, t):
        super().__init__()
        self.builders = {
            "daily_sales": lambda: t.daily,
            "fact_transaction": lambda: t.fact,
            "dim_article": lambda: t.dim_article,
            "dim_customer": lambda: t.dim_customer,
            "products_performance": lambda: marts.products_performance(t.sales, t.articles).withColumnRenamed(
                "article_id", "article_key"
            ),
            "customers_features_train": lambda: t.sales.groupBy("customer_id")
            .agg(F.sum("price").alias("total_spend"))
            .withColumn("customer_key", surrogate_key(F.col("customer_id"))),
            "customer_segments_summary": lambda: t.segment_summary,
        }

    def used_by(self, sql: str):
        return {name: build() for name, build in self.builders.items() if f"{{{name}}}" in sql}


def _register(name: str) -> None:
    @query(name, CHECKS[name])
    def run(t):
        return panel(t.spark, _Marts(t).used_by(PANELS[name]), name)


for _name in PANELS:
    _register(_name)
