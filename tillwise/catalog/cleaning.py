"""Cleaning and projection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise import model
from tillwise.catalog.base import AGE_CASE, query
from tillwise.functions.columns import (
    age_group,
    date_key,
    key_date,
    labelled,
    readable,
    surrogate_key,
)
from tillwise.operators import analysis, cleaning, profiling, ranking, star
from tillwise.session import materialise
from tillwise.streaming import messages


@query("c01_drop_sparse", "SELECT customer_id, age, club_member_status, fashion_news_frequency, postal_code FROM cust")
def c01(t):
    return cleaning.drop_sparse(t.customers)


@query(
    "c02_null_profile",
    """SELECT column_name, CAST(n_null AS BIGINT) AS n_null,
  CAST((n_null * 10000 * 2 + n) // (2 * n) AS DOUBLE) / 100 AS pct_null FROM (
  SELECT COUNT(*) AS n, unnest(['age', 'club_member_status', 'fashion_news_frequency', 'FN', 'Active']) AS column_name,
   unnest([COUNT(*) FILTER (age IS NULL), COUNT(*) FILTER (club_member_status IS NULL),
     COUNT(*) FILTER (fashion_news_frequency IS NULL), COUNT(*) FILTER (FN IS NULL),
     COUNT(*) FILTER (Active IS NULL)]) AS n_null FROM cust) WHERE n_null > 0""",
)
def c02(t):
    return cleaning.null_profile(t.customers)


@query("c03_median_age", "SELECT customer_id, coalesce(age, (SELECT median(age) FROM cust)) AS age FROM cust")
def c03(t):
    middle = cleaning.median_age(t.customers)
    return t.customers.select("customer_id", F.coalesce("age", middle).alias("age"))


@query(
    "c04_mode_imputation",
    "SELECT customer_id, club_member_status, fashion_news_frequency FROM cust_clean",
)
def c04(t):
    return cleaning.impute_customers(t.customers).select(
        "customer_id", "club_member_status", "fashion_news_frequency"
    )


@query(
    "c05_age_groups",
    f"""SELECT customer_id, CASE WHEN age IS NULL THEN NULL ELSE {AGE_CASE} END AS age_group,
  CASE WHEN age >= 16 AND age < 100 THEN {AGE_CASE} END AS strict_age_group FROM cust""",
)
def c05(t):
    return t.customers.select(
        "customer_id",
        age_group(F.col("age")).alias("age_group"),
        age_group(F.col("age"), strict=True).alias("strict_age_group"),
    )


@query(
    "c06_parse_dates",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CASE WHEN l_linenumber = 3 THEN NULL
  ELSE strftime(l_shipdate, '%Y-%m-%d') END AS t_dat FROM lineitem""",
)
def c06(t):
    text = F.when(F.col("l_linenumber") == 3, "not-a-date").otherwise(
        F.date_format("l_shipdate", "yyyy-MM-dd")
    )
    items = t.raw("lineitem").select("l_orderkey", "l_linenumber", text.alias("t_dat"))
    return cleaning.clean_transactions(items)


@query(
    "c07_surrogate_keys",
    """SELECT COUNT(*) AS n_customers, COUNT(DISTINCT customer_id) AS n_keys, COUNT(*) AS n_joined_back,
  CAST(0 AS BIGINT) AS n_negative, CAST(-1 AS BIGINT) AS key_of_missing FROM cust""",
)
def c07(t):
    keyed = t.customers.select("customer_id", surrogate_key(F.col("customer_id")).alias("customer_key"))
    back = keyed.join(t.dim_customer.select("customer_key", F.col("customer_id").alias("found")), "customer_key")
    return back.agg(
        F.count("*").alias("n_customers"),
        F.countDistinct("customer_key").alias("n_keys"),
        F.count_if(F.col("customer_id") == F.col("found")).alias("n_joined_back"),
        F.count_if(F.col("customer_key") < 0).alias("n_negative"),
        F.max(surrogate_key(F.lit(None).cast("string"))).alias("key_of_missing"),
    )


@query(
    "c08_date_keys",
    """SELECT DISTINCT CAST(strftime(t_dat, '%Y%m%d') AS BIGINT) AS date_key, CAST(t_dat AS VARCHAR) AS date FROM tx""",
)
def c08(t):
    keys = t.sales.select(date_key(F.col("t_dat")).alias("date_key")).distinct()
    return keys.withColumn("date", key_date(F.col("date_key")))


@query(
    "c09_calendar_parts",
    """SELECT CAST(year(t_dat) AS BIGINT) AS year, CAST(month(t_dat) AS BIGINT) AS month,
  strftime(t_dat, '%Y-%m') AS month_label, COUNT(*) AS n FROM tx GROUP BY ALL""",
)
def c09(t):
    return star.with_calendar_parts(t.sales).groupBy("year", "month", "month_label").agg(F.count("*").alias("n"))


@query("c10_projection", "SELECT article_id AS article_key, prod_name, product_group_name AS product_group FROM art")
def c10(t):
    return (
        t.articles.select("article_id", "prod_name", "product_group_name", "index_name")
        .withColumnRenamed("article_id", "article_key")
        .withColumnRenamed("product_group_name", "product_group")
        .drop("index_name")
    )


VALID = """(event_id % 31 <> 0 AND event_id % 17 <> 0 AND event_id % 19 <> 0 AND event_id % 23 <> 0
  AND event_id % 41 <> 0 AND event_id % 29 <> 0 AND event_id % 37 <> 0 AND value > 0)"""


@query(
    "c11_valid_split",
    f"SELECT COUNT(*) AS n, COUNT(*) FILTER ({VALID}) AS n_valid, COUNT(*) FILTER (NOT {VALID}) AS n_rejected FROM events",
)
def c11(t):
    parsed = materialise(messages.parse_messages(t.raw_messages), "parsed")
    valid, rejected = cleaning.split_valid(parsed)
    sides = cleaning.union_all(
        valid.select(F.lit(1).alias("v"), F.lit(0).alias("r")), rejected.select(F.lit(0).alias("v"), F.lit(1).alias("r"))
    )
    return sides.agg(F.count("*").alias("n"), F.sum("v").alias("n_valid"), F.sum("r").alias("n_rejected"))


@query(
    "c12_rejection_reasons",
    """SELECT reason, COUNT(*) AS n FROM (SELECT unnest(list_filter([
   CASE WHEN event_id % 31 = 0 OR event_id % 29 = 0 THEN 'customer_id_missing' END,
   CASE WHEN event_id % 31 = 0 THEN 'article_id_missing' END,
   CASE WHEN event_id % 31 = 0 OR event_id % 17 = 0 OR (event_id % 19 <> 0 AND event_id % 23 <> 0 AND event_id % 41 = 0)
     THEN 'price_missing' END,
   CASE WHEN event_id % 31 <> 0 AND event_id % 17 <> 0
     AND (event_id % 19 = 0 OR event_id % 23 = 0 OR (event_id % 41 <> 0 AND value <= 0)) THEN 'price_not_positive' END,
   CASE WHEN event_id % 31 = 0 THEN 't_dat_missing' END,
   CASE WHEN event_id % 31 <> 0 AND event_id % 37 = 0 THEN 't_dat_not_a_date' END], lambda x: x IS NOT NULL)) AS reason
  FROM events) GROUP BY reason""",
)
def c12(t):
    _, rejected = cleaning.split_valid(messages.parse_messages(t.raw_messages))
    return rejected.select(F.explode("rejection_reason").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query(
    "c13_labels",
    """SELECT customer_id, CASE sales_channel_id WHEN 1 THEN 'store' ELSE 'online' END AS channel,
  'number of customers in value segment ' || customer_id AS caption, COUNT(*) AS n FROM tx GROUP BY ALL""",
)
def c13(t):
    counts = t.sales.groupBy("customer_id", "sales_channel_id").agg(F.count("*").alias("n"))
    raw = F.concat(F.lit("n_customers in value_segment "), F.col("customer_id"))
    return counts.select(
        "customer_id",
        labelled(F.col("sales_channel_id"), model.CHANNELS).alias("channel"),
        readable(raw).alias("caption"),
        "n",
    )


@query(
    "c15_fill_missing",
    """SELECT customer_id, coalesce(age, 0) AS age FROM cust""",
)
def c15(t):
    return cleaning.fill_missing(t.customers.select("customer_id", "age"), ["age"])


@query("c16_require_target", "SELECT customer_id, club_member_status FROM cust WHERE club_member_status IS NOT NULL")
def c16(t):
    return cleaning.require(t.customers.select("customer_id", "club_member_status"), "club_member_status")


@query(
    "c17_bounded_sample",
    """SELECT customer_id, age FROM cust ORDER BY md5(customer_id || '|42'), customer_id LIMIT 500""",
)
def c17(t):
    return ranking.sample_rows(t.customers.select("customer_id", "age"), 500, "customer_id")


STRATA = """(SELECT *, row_number() OVER (PARTITION BY club_member_status ORDER BY md5(customer_id || '|42'), customer_id) - 1 AS r,
   count(*) OVER (PARTITION BY club_member_status) AS n FROM cust WHERE club_member_status IS NOT NULL)"""


@query(
    "c17_stratified_split",
    f"SELECT customer_id, club_member_status, r < (n * 2 * 2 + 10) // 20 AS is_test FROM {STRATA}",
)
def c17_split(t):
    train, test = ranking.stratified_split(
        t.customers.select("customer_id", "club_member_status"), "club_member_status", "customer_id"
    )
    return train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))


@query("c17_cap_per_class", f"SELECT customer_id, club_member_status FROM {STRATA} WHERE r < 200")
def c17_cap(t):
    return ranking.cap_per_stratum(
        t.customers.select("customer_id", "club_member_status"), "club_member_status", "customer_id", 200
    )


@query("c18_distinct_pairs", "SELECT DISTINCT customer_id, product_group_name FROM tx LEFT JOIN art USING (article_id)")
def c18(t):
    return t.named_sales.select("customer_id", "product_group_name").distinct()


@query(
    "c19_describe_numeric",
    """SELECT column_name, COUNT(*) AS n, round(AVG(v), 4) AS mean, round(stddev_samp(v), 4) AS std, MIN(v) AS min, MAX(v) AS max,
   round(quantile_cont(v, 0.25), 4) AS q25, round(quantile_cont(v, 0.5), 4) AS q50, round(quantile_cont(v, 0.75), 4) AS q75 FROM (
   SELECT 'price' AS column_name, CAST(price AS DOUBLE) AS v FROM tx UNION ALL
   SELECT 'article_id', CAST(article_id AS DOUBLE) FROM tx) GROUP BY 1""",
)
def c19(t):
    stored = materialise(t.sales.select("price", "article_id"), "sales")
    return (
        profiling.describe_numeric(stored, ["price", "article_id"])
        .withColumns({c: F.round(c, 4) for c in ("mean", "std", "q25", "q50", "q75")})
    )


@query(
    "c19_describe_text",
    """SELECT column_name, CAST(SUM(n) AS BIGINT) AS n, COUNT(*) AS n_unique, first(v ORDER BY n DESC, v) AS top, MAX(n) AS freq FROM (
   SELECT column_name, v, COUNT(*) AS n FROM (
     SELECT 'club_member_status' AS column_name, club_member_status AS v FROM cust UNION ALL
     SELECT 'fashion_news_frequency', fashion_news_frequency FROM cust UNION ALL
     SELECT 'postal_code', postal_code FROM cust) WHERE v IS NOT NULL GROUP BY 1, 2) GROUP BY 1""",
)
def c19_text(t):
    return profiling.describe_text(t.customers, ["club_member_status", "fashion_news_frequency", "postal_code"])


@query(
    "c20_log_target",
    "SELECT customer_id, round(ln(1 + total_spend::DOUBLE), 9) AS log_spend, round(total_spend::DOUBLE, 2) AS back FROM rfm",
)
def c20(t):
    logged = F.log1p(F.col("total_spend").cast("double"))
    spend = t.sales.groupBy("customer_id").agg(F.sum("price").alias("total_spend"))
    return spend.select("customer_id", F.round(logged, 9).alias("log_spend"), F.round(F.expm1(logged), 2).alias("back"))


@query(
    "c21_common_columns",
    """SELECT customer_id, age, age_group, club_member_status, fashion_news_frequency, postal_code FROM cust_clean""",
)
def c21(t):
    shared = cleaning.common_columns(t.dim_customer, t.customers_clean)
    return t.customers_clean.select(*shared)


@query("c22_leakage_guard", "SELECT COUNT(*) AS n_features FROM feat")
def c22(t):
    return cleaning.guard_features(t.features).agg(F.count("*").alias("n_features"))


@query(
    "c14_sale_period_flag",
    """SELECT CAST(d AS VARCHAR) AS date, EXISTS (SELECT 1 FROM sale_spans WHERE d BETWEEN s AND e) AS is_sale_period FROM dayrev""",
)
def c14(t):
    return analysis.flag_sale_periods(t.daily, t.sale_periods).select("date", "is_sale_period")
