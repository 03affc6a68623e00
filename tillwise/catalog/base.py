"""Registration of queries and the SQL views that their checks share."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tillwise.sources.binding import AS_OF, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}

# SQL views over the raw tables, in an order in which each uses earlier ones only.
VIEWS: dict[str, str] = {}


def view(name: str, sql: str) -> None:
    VIEWS[name] = sql.strip()


def with_views(sql: str) -> str:
    """``sql`` preceded by the views it names, directly or through other views."""
    needed: set[str] = set()
    text = sql
    for name in reversed(VIEWS):
        if re.search(rf"\b{name}\b", text):
            needed.add(name)
            text += " " + VIEWS[name]
    views = ", ".join(f"{name} AS ({body})" for name, body in VIEWS.items() if name in needed)
    return f"WITH {views} {sql.strip()}" if views else sql.strip()


def portable(df: DataFrame) -> DataFrame:
    """The same rows in types that compare alike across engines."""
    columns = []
    for field in df.schema:
        kind, column = field.dataType, F.col(f"`{field.name}`")
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string")
        elif isinstance(kind, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("long")
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(column.cast("array<string>"), ",", "")
        elif isinstance(kind, T.MapType):
            entries = F.transform(
                F.array_sort(F.map_entries(column)),
                lambda e: F.concat_ws("=", e["key"].cast("string"), e["value"].cast("string")),
            )
            column = F.array_join(entries, ",")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(name: str, check: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``, with the SQL of its check."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: portable(fn(Tables(spark, folder)))
        if check:
            CHECKS[name] = with_views(check)
        return fn

    return register


def rounded(numerator: str, denominator: str, digits: int) -> str:
    """SQL for a quotient of non-negative integers, rounded half up without floating point."""
    scale = 10**digits
    top, bottom = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    return f"(CAST(({top} * {2 * scale} + {bottom}) // (2 * {bottom}) AS DOUBLE) / {scale})"


def cents(amount: str) -> str:
    return f"CAST({amount} * 100 AS HUGEINT)"


AGE_CASE = """CASE WHEN age < 20 THEN '16-19' WHEN age < 25 THEN '20-24' WHEN age < 30 THEN '25-29'
 WHEN age < 35 THEN '30-34' WHEN age < 40 THEN '35-39' WHEN age < 50 THEN '40-49' WHEN age < 60 THEN '50-59'
 WHEN age < 70 THEN '60-69' ELSE '70+' END"""

view(
    "tx",
    """SELECT CAST(l.l_shipdate AS DATE) AS t_dat, CAST(o.o_custkey AS VARCHAR) AS customer_id,
  l.l_partkey AS article_id, CAST(l.l_extendedprice AS DECIMAL(18,2)) AS price,
  CASE WHEN o.o_orderpriority IN ('1-URGENT','2-HIGH') THEN 1 ELSE 2 END AS sales_channel_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
)
view(
    "cust",
    """SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
  CASE WHEN c_custkey % 83 = 0 THEN NULL ELSE CAST(14 + (c_custkey * 7) % 90 AS DOUBLE) END AS age,
  CASE WHEN c_custkey % 251 = 0 THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN 'PRE-CREATE'
       WHEN c_custkey % 50 = 7 THEN 'LEFT CLUB' ELSE 'ACTIVE' END AS club_member_status,
  CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_nationkey % 3 = 0 THEN 'Regularly'
       WHEN c_nationkey = 1 THEN 'Monthly' ELSE 'NONE' END AS fashion_news_frequency,
  CAST(c_nationkey AS VARCHAR) AS postal_code,
  CASE WHEN c_acctbal > 5000 THEN '1' END AS FN, CASE WHEN c_acctbal > 8000 THEN '1' END AS Active
  FROM customer""",
)
view(
    "art",
    """SELECT p_partkey AS article_id, p_name AS prod_name, p_type AS product_group_name,
  split_part(p_name, ' ', 2) AS product_type_name, p_brand AS department_name,
  split_part(p_name, ' ', 1) AS colour_group_name,
  CASE WHEN p_size <= 15 THEN 'small' WHEN p_size <= 35 THEN 'medium' ELSE 'large' END AS index_name FROM part""",
)
view(
    "cust_clean",
    f"""SELECT *, {AGE_CASE} AS age_group FROM (SELECT customer_id,
  coalesce(age, (SELECT median(age) FROM cust)) AS age,
  coalesce(club_member_status, (SELECT club_member_status FROM cust WHERE club_member_status IS NOT NULL
    GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS club_member_status,
  coalesce(fashion_news_frequency, (SELECT fashion_news_frequency FROM cust WHERE fashion_news_frequency IS NOT NULL
    GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS fashion_news_frequency, postal_code FROM cust)""",
)
view(
    "rfm",
    """SELECT customer_id, SUM(price) AS total_spend, COUNT(*) AS n_transactions, MIN(t_dat) AS first_purchase,
  MAX(t_dat) AS last_purchase, COUNT(DISTINCT product_group_name) AS n_distinct_categories
  FROM tx LEFT JOIN art USING (article_id) GROUP BY customer_id""",
)
view(
    "behav",
    f"""SELECT *, CAST(datediff('day', last_purchase, DATE '{AS_OF}') AS BIGINT) AS recency_days,
  CAST(datediff('day', first_purchase, last_purchase) AS BIGINT) AS tenure_days,
  {rounded(cents("total_spend"), "n_transactions * 100", 4)} AS avg_basket_value,
  {rounded("n_transactions * 30", "datediff('day', first_purchase, last_purchase) + 1", 3)}
    AS purchase_frequency_per_month FROM rfm""",
)
view(
    "quart",
    """SELECT quantile_cont(CAST(total_spend AS DOUBLE), 0.25) AS a, quantile_cont(CAST(total_spend AS DOUBLE), 0.5) AS b,
  quantile_cont(CAST(total_spend AS DOUBLE), 0.75) AS c FROM rfm""",
)
view(
    "segm",
    """SELECT behav.*, CASE WHEN total_spend::DOUBLE <= a THEN 'Q1 low' WHEN total_spend::DOUBLE <= b THEN 'Q2 mid-low'
  WHEN total_spend::DOUBLE <= c THEN 'Q3 mid-high' ELSE 'Q4 VIP' END AS value_segment FROM behav, quart""",
)
view("feat", "SELECT * FROM segm LEFT JOIN cust_clean USING (customer_id)")
view(
    "dayrev",
    """SELECT t_dat AS d, CAST(strftime(t_dat, '%Y%m%d') AS BIGINT) AS date_key, SUM(price) AS revenue,
  COUNT(*) AS n_transactions FROM tx GROUP BY t_dat""",
)
view(
    "segsum",
    """SELECT value_segment, COUNT(*) AS n_customers, SUM(total_spend)::DOUBLE / COUNT(*) AS avg_spend,
  SUM(n_transactions)::DOUBLE / COUNT(*) AS avg_purchases, SUM(total_spend) AS segment_revenue
  FROM feat GROUP BY value_segment""",
)
view(
    "sale_spans",
    """SELECT make_date(y, m1, d1) AS s, make_date(y + later, m2, d2) AS e FROM (SELECT DISTINCT year(t_dat) AS y FROM tx),
  (VALUES (11, 20, 0, 12, 2), (12, 27, 1, 1, 15), (6, 25, 0, 7, 15), (7, 10, 0, 7, 20)) p(m1, d1, later, m2, d2)""",
)
view(
    "holi",
    """SELECT DISTINCT make_date(y, m, 1) AS h FROM (SELECT DISTINCT year(t_dat) AS y FROM tx),
  (VALUES (1), (5), (12)) p(m)""",
)
view(
    "weath",
    """SELECT DISTINCT t_dat AS wd, 10 + 12.0::DOUBLE * (dayofyear(t_dat) % 30) / 30 AS temp_mean,
  (dayofyear(t_dat) % 7) / 2 AS precipitation FROM tx WHERE dayofyear(t_dat) % 11 <> 0""",
)
view(
    "cal",
    """SELECT dayrev.*, temp_mean, precipitation, d IN (SELECT h FROM holi) AS is_holiday,
  strftime(d, '%Y-%m') AS month FROM dayrev LEFT JOIN weath ON d = wd""",
)
