"""Aggregation, window, sort and set queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window, functions as F

from tillwise import model
from tillwise.catalog.base import cents, query, rounded
from tillwise.functions.columns import ratio
from tillwise.operators import analysis, cleaning, features, marts, quantiles, ranking, sketches
from tillwise.session import materialise, new_path
from tillwise.sources.binding import AS_OF
from tillwise.sources.warehouse import Warehouse

RATIO = "(SUM({0})::DOUBLE / COUNT(*))"


@query(
    "a01_rfm_base",
    """SELECT customer_id, total_spend::DOUBLE AS total_spend, n_transactions, CAST(first_purchase AS VARCHAR) AS first_purchase,
  CAST(last_purchase AS VARCHAR) AS last_purchase, n_distinct_categories FROM rfm""",
)
def a01(t):
    return features.rfm_base(t.named_sales)


@query(
    "a02_behaviour",
    """SELECT customer_id, recency_days, tenure_days, avg_basket_value, purchase_frequency_per_month FROM behav""",
)
def a02(t):
    return features.with_behaviour(features.rfm_base(t.named_sales), AS_OF).select(
        "customer_id", "recency_days", "tenure_days", "avg_basket_value", "purchase_frequency_per_month"
    )


@query(
    "a03_segment_approx",
    """SELECT unnest(['Q1 low', 'Q2 mid-low', 'Q3 mid-high', 'Q4 VIP']) AS value_segment, true AS near_a_quarter, true AS above_the_lower,
  (SELECT COUNT(*) FROM rfm) AS n_customers""",
)
def a03(t):
    """A sketch off by 1 % of the ranks at most cuts segments of 25 +- 2 %, and never out of order."""
    segments = features.with_segment(_stored_rfm(t), exact=False).groupBy("value_segment").agg(
        F.count("*").alias("n"), F.min("total_spend").alias("low"), F.max("total_spend").alias("high")
    )
    by_name, every = Window.orderBy("value_segment"), Window.partitionBy()
    share = F.col("n") / F.sum("n").over(every)
    return segments.select(
        "value_segment",
        share.between(0.23, 0.27).alias("near_a_quarter"),
        F.coalesce(F.col("low") > F.lag("high").over(by_name), F.lit(True)).alias("above_the_lower"),
        F.sum("n").over(every).alias("n_customers"),
    )


def _stored_rfm(t):
    return materialise(features.rfm_base(t.named_sales), "rfm")


@query("a04_segment_exact", "SELECT customer_id, total_spend::DOUBLE AS total_spend, value_segment FROM segm")
def a04(t):
    return features.with_segment(_stored_rfm(t), strict_edges=True).select(
        "customer_id", "total_spend", "value_segment"
    )


@query(
    "a04_quartiles",
    """SELECT product_group_name, round(quantile_cont(price::DOUBLE, 0.25), 4) AS q1, round(quantile_cont(price::DOUBLE, 0.5), 4) AS q2,
  round(quantile_cont(price::DOUBLE, 0.75), 4) AS q3 FROM tx JOIN art USING (article_id) GROUP BY 1""",
)
def a04_quartiles(t):
    marks = {"q1": 0.25, "q2": 0.5, "q3": 0.75}
    stored = materialise(t.named_sales.select("product_group_name", "price"), "prices")
    found = quantiles.exact_quantiles(stored, "price", marks, by=["product_group_name"])
    return found.withColumns({c: F.round(c, 4) for c in marks})


@query(
    "a05_products_performance",
    """SELECT article_id, COUNT(*) AS n_sales, any_value(prod_name) AS prod_name, any_value(product_group_name) AS product_group_name,
  any_value(department_name) AS department_name, any_value(index_name) AS index_name
  FROM tx LEFT JOIN art USING (article_id) GROUP BY 1""",
)
def a05(t):
    return marts.products_performance(t.sales, t.articles)


@query(
    "a06_daily_sales",
    "SELECT date_key, CAST(d AS VARCHAR) AS date, revenue::DOUBLE AS revenue, n_transactions FROM dayrev",
)
def a06(t):
    return t.daily


SEGMENT_COLUMNS = """value_segment, n_customers, avg_spend, avg_purchases, segment_revenue::DOUBLE AS segment_revenue,
  round(segment_revenue::DOUBLE * 100 / (SUM(segment_revenue) OVER ())::DOUBLE, 1) AS revenue_share_pct"""


@query("a07_segment_summary", f"SELECT {SEGMENT_COLUMNS} FROM segsum")
def a07(t):
    return t.segment_summary


@query("a08_segment_share", f"SELECT value_segment, n_customers, segment_revenue, revenue_share_pct FROM (SELECT {SEGMENT_COLUMNS} FROM segsum)")
def a08(t):
    return t.segment_summary.select("value_segment", "n_customers", "segment_revenue", "revenue_share_pct")


@query(
    "a09_weekly_volume",
    """SELECT CAST(CAST(week AS DATE) AS VARCHAR) AS week, coalesce(n, 0) AS n FROM (
  SELECT unnest(generate_series(MIN(w), MAX(w), INTERVAL 7 DAY)) AS week FROM (
    SELECT CAST(date_trunc('week', t_dat) AS DATE) + 6 AS w FROM tx))
  LEFT JOIN (SELECT CAST(date_trunc('week', t_dat) AS DATE) + 6 AS w, COUNT(*) AS n FROM tx GROUP BY 1) ON w = week""",
)
def a09(t):
    return analysis.weekly_volume(t.sales)


@query(
    "a10_monthly_calendar",
    """SELECT month, SUM(revenue)::DOUBLE AS revenue, round(AVG(temp_mean), 6) AS avg_temperature FROM cal GROUP BY month""",
)
def a10(t):
    calendar = analysis.enrich_calendar(t.daily, t.weather, t.holidays)
    return analysis.monthly_calendar(calendar).withColumn("avg_temperature", F.round("avg_temperature", 6))


@query(
    "a11_price_by_age",
    f"""SELECT age_group, COUNT(*) AS n_purchases, {RATIO.format("price")} AS mean_price
  FROM tx LEFT JOIN cust_clean USING (customer_id) GROUP BY 1""",
)
def a11(t):
    return analysis.price_by_age(t.sales, t.customers_clean)


AGE_CATEGORY = """(SELECT age_group, product_group_name, COUNT(*) AS n FROM tx LEFT JOIN cust_clean USING (customer_id)
  LEFT JOIN art USING (article_id) GROUP BY ALL)"""


@query(
    "a12_age_category_pivot",
    f"""SELECT product_group_name, {", ".join(
        f"CAST(coalesce(SUM(n) FILTER (age_group = '{a}'), 0) AS BIGINT) AS " + chr(34) + a + chr(34) for a in model.AGE_LABELS)}
  FROM {AGE_CATEGORY} GROUP BY 1""",
)
def a12(t):
    counts = analysis.age_category_counts(t.named_sales, t.customers_clean)
    return analysis.pivot_counts(counts, "product_group_name", "age_group", model.AGE_LABELS)


@query(
    "a13_row_percent",
    f"""SELECT age_group, product_group_name, n, n * 100::DOUBLE / (SUM(n) OVER (PARTITION BY age_group))::DOUBLE AS pct
  FROM {AGE_CATEGORY}""",
)
def a13(t):
    return analysis.row_percent(analysis.age_category_counts(t.named_sales, t.customers_clean), "age_group")


@query(
    "a13_status_by_age_share",
    """SELECT age_group, club_member_status, n, n * 100::DOUBLE / (SUM(n) OVER (PARTITION BY age_group))::DOUBLE AS pct FROM (
  SELECT age_group, club_member_status, COUNT(*) AS n FROM cust_clean GROUP BY ALL)""",
)
def a13_status(t):
    counts = t.customers_clean.groupBy("age_group", "club_member_status").agg(F.count("*").alias("n"))
    return analysis.row_percent(counts, "age_group")


@query(
    "a14_crosstab_top10",
    """SELECT department_name, product_group_name, COUNT(*) AS n FROM art WHERE department_name IN (
  SELECT department_name FROM art GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 10) GROUP BY ALL""",
)
def a14(t):
    return analysis.crosstab_top(t.articles, "department_name", "product_group_name")


@query(
    "a15_purchases_by_status",
    f"""SELECT club_member_status, COUNT(*) AS n_transactions, COUNT(DISTINCT customer_id) AS n_buyers,
  COUNT(*)::DOUBLE / COUNT(DISTINCT customer_id) AS purchases_per_buyer, {RATIO.format("price")} AS mean_price
  FROM tx LEFT JOIN cust_clean USING (customer_id) GROUP BY 1""",
)
def a15(t):
    return analysis.purchases_by_status(t.sales, t.customers_clean)


@query(
    "a16_channel_mix",
    """SELECT CAST(sales_channel_id AS BIGINT) AS sales_channel_id, COUNT(*) AS n,
  round(COUNT(*) * 100::DOUBLE / (SELECT COUNT(*) FROM tx), 1) AS share_pct,
  CASE sales_channel_id WHEN 1 THEN 'store' ELSE 'online' END AS channel FROM tx GROUP BY sales_channel_id""",
)
def a16(t):
    return analysis.channel_mix(t.sales)


@query(
    "a17_revenue_by_group",
    """SELECT product_group_name, SUM(price)::DOUBLE AS revenue,
  round(SUM(price)::DOUBLE * 100 / (SELECT SUM(price)::DOUBLE FROM tx), 1) AS share_pct
  FROM tx LEFT JOIN art USING (article_id) GROUP BY 1""",
)
def a17(t):
    return analysis.revenue_by(t.named_sales, "product_group_name")


@query("a18_value_counts", "SELECT colour_group_name, COUNT(*) AS n FROM art GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def a18(t):
    return analysis.frequency(t.articles, "colour_group_name", top=10)


@query(
    "a19_distinct_counts",
    """SELECT COUNT(DISTINCT prod_name) AS prod_name, COUNT(DISTINCT product_group_name) AS product_group_name,
  COUNT(DISTINCT department_name) AS department_name, COUNT(DISTINCT colour_group_name) AS colour_group_name FROM art""",
)
def a19(t):
    return analysis.distinct_counts(
        t.articles, ["prod_name", "product_group_name", "department_name", "colour_group_name"]
    )


@query(
    "a19_distinct_approx",
    """SELECT COUNT(DISTINCT customer_id) AS customer_id, COUNT(DISTINCT article_id) AS article_id, COUNT(DISTINCT t_dat) AS t_dat,
  true AS customer_id_near, true AS article_id_near, true AS t_dat_near FROM tx""",
)
def a19_approx(t):
    """The counts, and whether the estimates lie within three standard errors of 5 %."""
    columns = ["customer_id", "article_id", "t_dat"]
    near = analysis.distinct_counts(t.sales, columns, approximate=True)
    exact = analysis.distinct_counts(t.sales, columns)
    told = [(F.abs(near.select(c).scalar() - F.col(c)) <= 0.15 * F.col(c)).alias(f"{c}_near") for c in columns]
    return exact.select(*columns, *told)


@query(
    "a19_sketches_by_year",
    """SELECT year(t_dat) AS year, COUNT(*) AS n, COUNT(DISTINCT customer_id) AS customers, COUNT(DISTINCT article_id) AS articles,
  true AS distinct_within_bound, true AS ranks_within_bound FROM tx GROUP BY 1""",
)
def a19_sketches(t):
    """Years from stored summaries of days alone, beside exact counts of the sales."""
    stored = Warehouse(t.spark, new_path(t.spark, "sketches"))
    stored.overwrite("sketches_day", sketches.daily(t.sales))
    said = sketches.estimates(stored.read("sketches_day").withColumn("year", F.year("t_dat")), "year")
    dated = t.sales.withColumn("year", F.year("t_dat"))
    exact = dated.groupBy("year").agg(F.countDistinct("customer_id").alias("customers"), F.countDistinct("article_id").alias("articles"))
    marks = {s: F.col(f"price_{s}") for s in (25, 50, 75)}
    # a value may stand for many equal ones: its share lies between those below it and those up to it
    at = {f"lt{s}": F.avg((F.col("price").cast("double") < m).cast("double")) for s, m in marks.items()}
    at |= {f"le{s}": F.avg((F.col("price").cast("double") <= m).cast("double")) for s, m in marks.items()}
    ranks = dated.join(F.broadcast(said), "year").groupBy("year").agg(*[e.alias(k) for k, e in at.items()])
    close = lambda est, true: F.abs(F.col(est) - F.col(true)) <= sketches.COUNT_ERROR * F.col(true) + 1
    error = sketches.RANK_ERROR * 2  # rank errors of all years and marks, not of one
    within = [F.col(f"lt{s}") <= s / 100 + error for s in marks] + [F.col(f"le{s}") >= s / 100 - error for s in marks]
    return said.join(exact, "year").join(ranks, "year").select(
        "year", "n", "customers", "articles",
        (close("customer_id_hll", "customers") & close("customer_id_theta", "customers")
         & close("article_id_hll", "articles") & close("article_id_theta", "articles")).alias("distinct_within_bound"),
        reduce(lambda a, b: a & b, within).alias("ranks_within_bound"),
    )


@query(
    "a19_sketches_in_common",
    """SELECT COUNT(*) FILTER (a AND b) AS n_both, COUNT(*) AS n_either, true AS within_bound FROM (
  SELECT customer_id, bool_or(year(t_dat) = 1995) AS a, bool_or(year(t_dat) = 1999) AS b FROM tx WHERE year(t_dat) IN (1995, 1999) GROUP BY 1)""",
)
def a19_common(t):
    """Customers of one year who come back in another."""
    stored = materialise(sketches.daily(t.sales), "sketches")
    year = F.year("t_dat")
    said = sketches.in_both(stored.where(year == 1995), stored.where(year == 1999))
    years = t.sales.where(year.isin(1995, 1999)).groupBy("customer_id").agg(F.countDistinct(year).alias("years"))
    exact = years.agg(F.count_if(F.col("years") == 2).alias("n_both"), F.count("*").alias("n_either"))
    # an intersection is as uncertain as the union that it is a part of
    most = sketches.COUNT_ERROR * F.col("n_either") + 1
    close = (F.abs(said.select("in_both").scalar() - F.col("n_both")) <= most) & (F.abs(said.select("in_either").scalar() - F.col("n_either")) <= most)
    return exact.withColumn("within_bound", close)


@query(
    "a20_postal_concentration",
    """SELECT postal_code, COUNT(*) AS n, COUNT(*) * 100::DOUBLE / (SELECT COUNT(*) FROM cust) AS share_pct
  FROM cust GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def a20(t):
    return analysis.frequency(t.customers, "postal_code", top=10, with_share=True)


@query(
    "a21_age_by_status",
    """SELECT club_member_status, median(age) AS median_age, AVG(age) AS mean_age, COUNT(age) AS n FROM cust_clean GROUP BY 1""",
)
def a21(t):
    return analysis.age_by(t.customers_clean, "club_member_status", "club_member_status")


@query(
    "a22_vip_ages",
    """SELECT value_segment = 'Q4 VIP' AS is_vip, median(age) AS median_age, AVG(age) AS mean_age, COUNT(age) AS n FROM feat GROUP BY 1""",
)
def a22(t):
    return analysis.vip_ages(t.features)


@query(
    "a23_age_group_summary",
    f"""SELECT age_group, COUNT(*) AS n_customers, SUM(total_spend)::DOUBLE AS revenue,
  {rounded(cents("SUM(total_spend)"), "COUNT(*) * 100", 2)} AS avg_revenue,
  {rounded("SUM(n_transactions)", "COUNT(*)", 2)} AS avg_purchases FROM feat GROUP BY 1""",
)
def a23(t):
    return marts.age_group_summary(t.features)


DAYS = """{0}, SUM(revenue)::DOUBLE / COUNT(*) AS mean_revenue, median(revenue::DOUBLE) AS median_revenue,
  SUM(n_transactions)::DOUBLE / COUNT(*) AS mean_transactions, median(n_transactions)::DOUBLE AS median_transactions, COUNT(*) AS n_days"""


@query(
    "a24_sale_period_days",
    f"""SELECT {DAYS.format("is_sale_period")} FROM (SELECT *, EXISTS (SELECT 1 FROM sale_spans WHERE d BETWEEN s AND e)
  AS is_sale_period FROM dayrev) GROUP BY is_sale_period""",
)
def a24(t):
    return analysis.compare_days(analysis.flag_sale_periods(t.daily, t.sale_periods), "is_sale_period")


@query("a24_holiday_days", f"SELECT {DAYS.format('is_holiday')} FROM cal GROUP BY is_holiday")
def a24_holiday(t):
    return analysis.compare_days(analysis.enrich_calendar(t.daily, t.weather, t.holidays), "is_holiday")


@query(
    "a25_coverage",
    """SELECT CAST(MIN(t_dat) AS VARCHAR) AS first_day, CAST(MAX(t_dat) AS VARCHAR) AS last_day, COUNT(*) AS n_transactions,
  COUNT(DISTINCT customer_id) AS n_buyers, (SELECT COUNT(*) FROM cust) AS n_customers,
  COUNT(DISTINCT article_id) AS n_sold_articles, (SELECT COUNT(*) FROM art) AS n_articles FROM tx""",
)
def a25(t):
    return analysis.coverage(t.sales, t.customers, t.articles)


@query(
    "a26_histogram",
    """SELECT bin, coalesce(n, 0) AS n, lo + (bin - 1) * ((hi - lo) / 40) AS low, lo + bin * ((hi - lo) / 40) AS high
  FROM (SELECT CAST(unnest(range(1, 41)) AS BIGINT) AS bin) CROSS JOIN (SELECT MIN(price)::DOUBLE AS lo, MAX(price)::DOUBLE AS hi FROM tx)
  LEFT JOIN (SELECT CAST(least(floor((price::DOUBLE - lo) / ((hi - lo) / 40)) + 1, 40) AS BIGINT) AS bin, COUNT(*) AS n
    FROM tx, (SELECT MIN(price)::DOUBLE AS lo, MAX(price)::DOUBLE AS hi FROM tx) GROUP BY 1) USING (bin)""",
)
def a26(t):
    return analysis.histogram(t.sales, "price", 40)


@query(
    "a27_box_summary",
    """SELECT product_group_name, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, MIN(p) FILTER (p >= q1 - 1.5 * (q3 - q1) AND p <= q3 + 1.5 * (q3 - q1)) AS whisker_low,
  MAX(p) FILTER (p >= q1 - 1.5 * (q3 - q1) AND p <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
  COUNT(*) FILTER (p < q1 - 1.5 * (q3 - q1) OR p > q3 + 1.5 * (q3 - q1)) AS n_outliers, COUNT(*) AS n
  FROM (SELECT product_group_name, price::DOUBLE AS p FROM tx JOIN art USING (article_id))
  JOIN (SELECT product_group_name, quantile_cont(price::DOUBLE, 0.25) AS q1, quantile_cont(price::DOUBLE, 0.5) AS median,
    quantile_cont(price::DOUBLE, 0.75) AS q3 FROM tx JOIN art USING (article_id) GROUP BY 1) USING (product_group_name)
  GROUP BY product_group_name, q1, median, q3""",
)
def a27(t):
    stored = materialise(t.named_sales.select("product_group_name", "price"), "prices")
    boxes = analysis.box_summary(stored, "price", "product_group_name")
    return boxes.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})


@query(
    "a28_scoring_summary",
    """SELECT COUNT(*) AS n_customers_scored, round(SUM(total_spend)::DOUBLE / COUNT(*), 2) AS predicted_spend_mean,
  round(SUM(total_spend)::DOUBLE, 2) AS predicted_spend_total, round(median(total_spend::DOUBLE), 2) AS predicted_spend_median,
  (SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM (SELECT club_member_status AS k, COUNT(*) AS n FROM feat GROUP BY 1)) AS club_status_distribution,
  (SELECT club_member_status FROM feat GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1) AS dominant_club_status,
  (SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM (SELECT value_segment AS k, COUNT(*) AS n FROM feat GROUP BY 1)) AS segment_distribution,
  (SELECT value_segment FROM feat GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1) AS dominant_segment FROM feat""",
)
def a28(t):
    scored = materialise(t.features.select("club_member_status", "value_segment", "total_spend"), "scored")
    return marts.scoring_summary(scored, "club_member_status", "value_segment", "total_spend")


@query(
    "a29_global_kpis",
    f"""SELECT {rounded(cents("SUM(revenue)"), "SUM(n_transactions) * 100", 2)} AS avg_basket,
  CAST(SUM(n_transactions) AS BIGINT) AS total_sales, {rounded(cents("SUM(revenue)"), "COUNT(*) * 100", 2)} AS avg_daily_revenue,
  (SELECT COUNT(*) FROM cust) AS n_customers FROM dayrev""",
)
def a29(t):
    revenue, n = F.sum("revenue"), F.sum("n_transactions")
    return t.daily.agg(
        F.round(ratio(revenue, n), 2).alias("avg_basket"),
        n.alias("total_sales"),
        F.round(ratio(revenue, F.count("*")), 2).alias("avg_daily_revenue"),
    ).withColumn("n_customers", t.customers.agg(F.count("*")).scalar())


# --- windows -------------------------------------------------------------------------------


@query(
    "w01_share_of_total",
    """SELECT department_name, COUNT(*) AS n, COUNT(*) * 100::DOUBLE / (SELECT COUNT(*) FROM tx) AS share_pct
  FROM tx JOIN art USING (article_id) GROUP BY 1""",
)
def w01(t):
    sold = t.sales.groupBy("article_id").agg(F.count("*").alias("n"))
    grouped = sold.join(t.articles, "article_id").groupBy("department_name").agg(F.sum("n").alias("n"))
    return analysis.with_share_of_total(grouped, "n")


@query(
    "w02_cumulative_share",
    """SELECT age_group, n, (SUM(n) OVER (ORDER BY age_group))::DOUBLE * 100 / (SUM(n) OVER ())::DOUBLE AS cumulative_pct
  FROM (SELECT age_group, COUNT(*) AS n FROM cust_clean GROUP BY 1)""",
)
def w02(t):
    grouped = t.customers_clean.groupBy("age_group").agg(F.count("*").alias("n"))
    return analysis.cumulative_share(grouped, "n", F.asc("age_group"))


@query(
    "w03_equal_count_quartiles",
    """SELECT customer_id, total_spend::DOUBLE AS total_spend, CAST(ntile(4) OVER (ORDER BY total_spend, customer_id) AS BIGINT) AS quartile FROM rfm""",
)
def w03(t):
    spend = t.sales.groupBy("customer_id").agg(F.sum("price").alias("total_spend"))
    return ranking.equal_count_tiles(spend, 4, F.asc("total_spend"), F.asc("customer_id"), name="quartile")


@query(
    "w04_top_category_by_age",
    f"""SELECT age_group, first(product_group_name ORDER BY n DESC, product_group_name) AS product_group_name, MAX(n) AS n
  FROM {AGE_CATEGORY} GROUP BY 1""",
)
def w04(t):
    counts = analysis.age_category_counts(t.named_sales, t.customers_clean)
    return analysis.top_category(counts, "age_group", "product_group_name")


@query(
    "w05_last_purchases",
    """SELECT customer_id, rn, CAST(strftime(t_dat, '%Y%m%d') AS BIGINT) AS date_key, article_id AS article_key, prod_name,
  product_group_name, price::DOUBLE AS price, CASE sales_channel_id WHEN 1 THEN 'store' ELSE 'online' END AS channel FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY t_dat DESC, article_id, price, sales_channel_id) AS rn FROM tx)
  JOIN art USING (article_id) WHERE rn <= 10""",
)
def w05(t):
    return analysis.last_purchases(t.fact, t.dim_customer, t.dim_article).select(
        "customer_id", "rn", "date_key", "article_key", "prod_name", "product_group_name", "price", "channel"
    )


@query(
    "w06_top_categories",
    """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY n_purchases DESC, product_group_name) AS rn
  FROM (SELECT customer_id, product_group_name, COUNT(*) AS n_purchases FROM tx LEFT JOIN art USING (article_id) GROUP BY ALL))
  WHERE rn <= 5""",
)
def w06(t):
    return analysis.top_categories(t.named_sales)


@query(
    "w07_recent_turns",
    """SELECT conv_id, COUNT(*) AS n_turns, string_agg(CASE WHEN role = 'user' THEN 'User' ELSE 'Assistant' END || ' : ' || text,
  chr(10) ORDER BY turn) AS history FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn
  FROM conversations) WHERE rn <= 6 GROUP BY conv_id""",
)
def w07(t):
    return analysis.recent_turns(t.raw("conversations"))


# --- sort, limit, set operations --------------------------------------------------------------


@query("l01_global_sort", "SELECT CAST(d AS VARCHAR) AS date, revenue::DOUBLE AS revenue FROM dayrev ORDER BY revenue DESC, d")
def l01(t):
    return t.daily.select("date", "revenue").orderBy(F.desc("revenue"), "date")


@query(
    "l02_top_k",
    "SELECT customer_id, total_spend::DOUBLE AS total_spend FROM rfm ORDER BY rfm.total_spend DESC, customer_id LIMIT 20",
)
def l02(t):
    spend = t.sales.groupBy("customer_id").agg(F.sum("price").alias("total_spend"))
    return spend.orderBy(F.desc("total_spend"), "customer_id").limit(20)


@query(
    "l03_emptiness",
    """SELECT (SELECT COUNT(*) FROM tx WHERE price <= 0) = 0 AS no_bad_prices, (SELECT COUNT(*) FROM tx) = 0 AS no_sales""",
)
def l03(t):
    bad = t.sales.where("price <= 0")
    return t.spark.range(1).select(
        (~bad.exists()).alias("no_bad_prices"), (~t.sales.exists()).alias("no_sales")
    )


@query(
    "l04_union_all",
    """SELECT year, COUNT(*) AS n FROM (SELECT CAST(year(t_dat) AS BIGINT) AS year FROM tx UNION ALL
  SELECT CAST(year(ts) AS BIGINT) FROM events) GROUP BY 1""",
)
def l04(t):
    streamed = t.raw("events").select(F.col("ts").cast("date").alias("t_dat"))
    both = cleaning.union_all(t.sales.select("t_dat"), streamed)
    return both.groupBy(F.year("t_dat").alias("year")).agg(F.count("*").alias("n"))


@query(
    "l05_set_union",
    "SELECT customer_id FROM tx UNION SELECT CAST(user_id AS VARCHAR) FROM events",
)
def l05(t):
    seen = t.raw("events").select(F.col("user_id").cast("string").alias("customer_id"))
    return t.sales.select("customer_id").union(seen).distinct()
