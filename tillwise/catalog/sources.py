"""Source and sink queries: each writes to the shared folder and reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise import model
from tillwise.catalog.base import query
from tillwise.operators import analysis, features, star
from tillwise.plans import batch
from tillwise.plans.insights import insight_report
from tillwise.session import materialise, new_path
from tillwise.sources import files
from tillwise.sources.binding import AS_OF
from tillwise.sources.warehouse import Warehouse


def _sales_file(t) -> str:
    """The sales as CSV; every article 0, 97, 194, ... is written as text that is no number."""
    path = new_path(t.spark, "sales-csv")
    broken = F.when(F.col("article_id") % 97 == 0, "broken").otherwise(F.col("article_id").cast("string"))
    files.export_csv(t.sales.select("t_dat", "customer_id", broken.alias("article_id"), "price", "sales_channel_id"), path)
    return path


@query(
    "s01_csv_scan",
    """SELECT CAST(t_dat AS VARCHAR) AS t_dat, customer_id, CASE WHEN article_id % 97 <> 0 THEN article_id END AS article_id,
  price::DOUBLE AS price, CAST(sales_channel_id AS BIGINT) AS sales_channel_id, article_id % 97 = 0 AS is_bad FROM tx""",
)
def s01(t):
    rows = files.read_csv(t.spark, _sales_file(t), model.TRANSACTIONS, keep_bad=True)
    return rows.withColumn("is_bad", F.col("_bad_record").isNotNull()).drop("_bad_record")


@query(
    "s02_csv_inferred",
    """SELECT CAST(t_dat AS VARCHAR) AS t_dat, customer_id, CASE WHEN article_id % 97 <> 0 THEN article_id END AS article_id,
  price::DOUBLE AS price, CAST(sales_channel_id AS BIGINT) AS sales_channel_id FROM tx""",
)
def s02(t):
    overrides = {"customer_id": "string", "article_id": "bigint"}
    return files.read_csv_inferred(t.spark, _sales_file(t), overrides, dates=("t_dat",))


@query(
    "s03_full_pass",
    """SELECT product_group_name, COUNT(*) AS n, SUM(price)::DOUBLE AS revenue, CAST(MIN(t_dat) AS VARCHAR) AS first_day,
  CAST(MAX(t_dat) AS VARCHAR) AS last_day, COUNT(*) FILTER (sales_channel_id = 2) AS n_online FROM tx LEFT JOIN art USING (article_id) GROUP BY 1""",
)
def s03(t):
    return t.named_sales.groupBy("product_group_name").agg(
        F.count("*").alias("n"),
        F.sum("price").alias("revenue"),
        F.min("t_dat").alias("first_day"),
        F.max("t_dat").alias("last_day"),
        F.count_if(F.col("sales_channel_id") == 2).alias("n_online"),
    )


@query(
    "s04_table_scan",
    """SELECT CAST(strftime(t_dat, '%Y%m%d') AS BIGINT) AS date_key, article_id AS article_key, price::DOUBLE AS price,
  CAST(sales_channel_id AS BIGINT) AS sales_channel_id FROM tx""",
)
def s04(t):
    return _star(t).read("fact_transaction").select("date_key", "article_key", "price", "sales_channel_id")


@query(
    "s06_stored_master",
    """SELECT customer_id, COUNT(*) AS n, SUM(price)::DOUBLE AS spend, COUNT(DISTINCT product_group_name) AS n_groups,
  any_value(age_group) AS age_group FROM tx LEFT JOIN art USING (article_id) LEFT JOIN cust_clean USING (customer_id) GROUP BY 1""",
)
def s06(t):
    """The stored fact joined with its dimensions, by customer key."""
    warehouse = _star(t)
    rows = star.warehouse_master(
        warehouse.read("fact_transaction").drop("month_key"), warehouse.read("dim_customer"), warehouse.read("dim_article")
    )
    return rows.groupBy("customer_id").agg(
        F.count("*").alias("n"),
        F.sum("price").alias("spend"),
        F.countDistinct("product_group_name").alias("n_groups"),
        F.first("age_group").alias("age_group"),
    )


def _star(t) -> Warehouse:
    warehouse = Warehouse(t.spark, new_path(t.spark, "warehouse"))
    batch.load_star(warehouse, t.sales, t.customers, t.articles)
    return warehouse


@query(
    "s05_key_bounds",
    """SELECT MIN(CAST(strftime(t_dat, '%Y%m%d') AS BIGINT)) AS low, MAX(CAST(strftime(t_dat, '%Y%m%d') AS BIGINT)) AS high FROM tx""",
)
def s05(t):
    return t.spark.sql("SELECT MIN(date_key) AS low, MAX(date_key) AS high FROM {fact}", fact=t.fact)


def _loaded(t) -> Warehouse:
    warehouse = Warehouse(t.spark, new_path(t.spark, "warehouse"))
    batch.load(warehouse, t.sales, t.customers, t.articles, AS_OF)
    return warehouse


@query(
    "s07_warehouse_load",
    """SELECT 'dim_customer' AS table_name, COUNT(*) AS n FROM cust UNION ALL SELECT 'dim_article', COUNT(*) FROM art UNION ALL
  SELECT 'dim_date', COUNT(*) FROM dayrev UNION ALL SELECT 'fact_transaction', COUNT(*) FROM tx UNION ALL
  SELECT 'customers_features_train', COUNT(*) FROM feat UNION ALL SELECT 'products_performance', COUNT(DISTINCT article_id) FROM tx UNION ALL
  SELECT 'daily_sales', COUNT(*) FROM dayrev UNION ALL SELECT 'customer_segments_summary', COUNT(*) FROM segsum""",
)
def s07(t):
    warehouse = _loaded(t)
    counts = None
    for name in batch.TABLES:
        one = warehouse.read(name).agg(F.lit(name).alias("table_name"), F.count("*").alias("n"))
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query(
    "s07_stored_marts",
    """SELECT value_segment, n_customers, avg_spend, avg_purchases, segment_revenue::DOUBLE AS segment_revenue,
  (SELECT CAST(SUM(n_transactions) AS BIGINT) FROM dayrev) AS all_sales FROM segsum""",
)
def s07_marts(t):
    warehouse = _loaded(t)
    total = warehouse.read("daily_sales").agg(F.sum("n_transactions")).scalar()
    return (
        warehouse.read("customer_segments_summary").drop("revenue_share_pct").withColumn("all_sales", total)
    )


@query(
    "s08_append",
    """SELECT CAST(year(t_dat) AS BIGINT) AS year, COUNT(*) AS n FROM tx GROUP BY 1""",
)
def s08(t):
    """Yearly batches, each appended; the last one twice, as after a failed job."""
    warehouse = Warehouse(t.spark, new_path(t.spark, "warehouse"))
    yearly = materialise(t.sales.select("t_dat", "price", (F.year("t_dat").cast("long")).alias("batch_id")))
    warehouse.write_batches("sales", yearly)
    latest = yearly.agg(F.max("batch_id")).scalar()
    warehouse.write_batches("sales", yearly.where(F.col("batch_id") == latest))
    stored = warehouse.read_batches("sales", "t_dat DATE, price DECIMAL(18,2)")
    return stored.groupBy(F.year("t_dat").alias("year")).agg(F.count("*").alias("n"))


@query(
    "s12_flat_exports",
    """SELECT date_key, revenue::DOUBLE AS revenue, n_transactions, temp_mean, precipitation, is_holiday, month FROM cal""",
)
def s12(t):
    path = new_path(t.spark, "calendar-csv")
    calendar = analysis.enrich_calendar(t.daily, t.weather, t.holidays).drop("date")
    files.export_csv(calendar, path)
    schema = (
        "date_key BIGINT, revenue DOUBLE, n_transactions BIGINT, temp_mean DOUBLE, precipitation DOUBLE, "
        "is_holiday BOOLEAN, month STRING"
    )
    return files.read_csv(t.spark, path, schema)


@query("s13_insight_report")
def s13(t):
    path = new_path(t.spark, "insights")
    sales = materialise(t.named_sales, "sales")
    rows = materialise(features.customer_features(sales, t.customers_clean, AS_OF), "features")
    files.export_text(insight_report(sales, t.customers, t.articles, rows), path)
    return t.spark.read.text(path, wholetext=True)


@query(
    "s14_keyed_messages",
    """SELECT CAST(user_id AS VARCHAR) AS key, '{"t_dat":"' || strftime(ts, '%Y-%m-%d') || '","customer_id":"' || user_id || '","article_id":'
  || (event_id % 2000) || ',"price":' || CAST(value AS VARCHAR) || ',"sales_channel_id":' || CASE event_type WHEN 'click' THEN 1 ELSE 2 END || '}' AS value
  FROM events""",
)
def s14(t):
    return t.encoded_sales().withColumn("value", F.col("value").cast("string"))


@query(
    "s15_feature_read",
    "SELECT customer_id, n_transactions, value_segment FROM feat",
)
def s15(t):
    path = new_path(t.spark, "features")
    t.features.write.parquet(path)
    return files.read_features(t.spark, path=path).select("customer_id", "n_transactions", "value_segment")
