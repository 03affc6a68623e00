"""Scalar function families, moments, tests and drift."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tillwise import model
from tillwise.catalog.base import query, view
from tillwise.functions import vectors
from tillwise.functions.columns import (
    date_key,
    month_label,
    surrogate_key,
    week_ending,
)
from tillwise.functions.probability import AS_241
from tillwise.ml import prepare
from tillwise.operators import analysis, drift, stat_tests
from tillwise.session import materialise
from tillwise.sources.binding import AS_OF
from tillwise.streaming.messages import parse_messages


@query(
    "f01_dates",
    f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS key,
  strftime(l_shipdate, '%Y-%m') AS month_label, CAST(month(l_shipdate) AS BIGINT) AS month, CAST(year(l_shipdate) AS BIGINT) AS year,
  CAST(datediff('day', CAST(l_shipdate AS DATE), DATE '{AS_OF}') AS BIGINT) AS age_days,
  CAST(CAST(date_trunc('week', l_shipdate) AS DATE) + 6 AS VARCHAR) AS week FROM lineitem""",
)
def f01(t):
    day = F.col("l_shipdate").cast("date")
    return t.raw("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        date_key(day).alias("key"),
        month_label(day).alias("month_label"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        F.datediff(F.lit(AS_OF).cast("date"), day).alias("age_days"),
        week_ending(day).alias("week"),
    )


@query(
    "f02_math",
    """SELECT c_custkey, CAST(round(CAST(c_acctbal AS DECIMAL(18,2)), 1) AS DOUBLE) AS rounded, abs(c_acctbal) AS magnitude,
  round(ln(1 + abs(c_acctbal)), 9) AS log1p, round(sqrt(abs(c_acctbal)), 9) AS root,
  least(greatest(c_acctbal, 0), 5000)::DOUBLE AS clipped, round(exp(c_acctbal / 10000) - 1, 9) AS expm1 FROM customer""",
)
def f02(t):
    x = F.col("c_acctbal")
    return t.raw("customer").select(
        "c_custkey",
        F.round(x.cast("decimal(18,2)"), 1).alias("rounded"),
        F.abs(x).alias("magnitude"),
        F.round(F.log1p(F.abs(x)), 9).alias("log1p"),
        F.round(F.sqrt(F.abs(x)), 9).alias("root"),
        F.least(F.greatest(x, F.lit(0.0)), F.lit(5000.0)).alias("clipped"),
        F.round(F.expm1(x / 10000), 9).alias("expm1"),
    )


@query(
    "f03_nulls",
    """SELECT customer_id, coalesce(club_member_status, 'unknown') AS status, nullif(fashion_news_frequency, 'NONE') AS news,
  age IS NOT NULL AS has_age, 100 / nullif(age - 14, 0) AS per_year FROM cust""",
)
def f03(t):
    return t.customers.select(
        "customer_id",
        F.coalesce("club_member_status", F.lit("unknown")).alias("status"),
        F.nullif(F.col("fashion_news_frequency"), F.lit("NONE")).alias("news"),
        F.col("age").isNotNull().alias("has_age"),
        F.try_divide(F.lit(100.0), F.col("age") - 14).alias("per_year"),
    )


@query(
    "f04_conditions",
    "SELECT article_id, CASE index_name WHEN 'small' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END::BIGINT AS size_rank FROM art",
)
def f04(t):
    name = F.col("index_name")
    return t.articles.select("article_id", F.when(name == "small", 1).when(name == "medium", 2).otherwise(3).alias("size_rank"))


@query(
    "f05_strings",
    """SELECT doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines, starts_with(text, 'The') AS starts_the,
  replace(text, 'the', 'THE') AS replaced, trim(string_split(text, chr(10))[1]) AS first_line,
  'doc ' || CAST(doc_id AS VARCHAR) AS label,
  CASE WHEN instr(text, 'e') > 0 THEN substr(text, instr(text, 'e'), length(text) - instr(reverse(text), 'e') + 2 - instr(text, 'e'))
    ELSE '' END AS inside FROM documents""",
)
def f05(t):
    text = F.col("text")
    return t.raw("documents").select(
        "doc_id",
        F.size(F.split(text, "\n")).alias("n_lines"),
        text.startswith("The").alias("starts_the"),
        F.replace(text, F.lit("the"), F.lit("THE")).alias("replaced"),
        F.trim(F.get(F.split(text, "\n"), 0)).alias("first_line"),
        F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("label"),
        F.regexp_extract(text, r"(?s)e.*e|e", 0).alias("inside"),
    )


@query(
    "f06_json",
    """SELECT CAST(user_id AS VARCHAR) AS customer_id, event_id % 2000 AS article_id, value AS price, strftime(ts, '%Y-%m-%d') AS t_dat,
  CAST(CASE event_type WHEN 'click' THEN 1 ELSE 2 END AS BIGINT) AS sales_channel_id FROM events""",
)
def f06(t):
    raw = t.encoded_sales().withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    return parse_messages(raw).select("customer_id", "article_id", "price", "t_dat", "sales_channel_id")


@query("f07_hash", "SELECT COUNT(*) AS n, COUNT(*) AS n_keys, CAST(0 AS BIGINT) AS n_negative FROM customer")
def f07(t):
    key = surrogate_key(F.col("c_custkey"))
    return t.raw("customer").agg(
        F.count("*").alias("n"), F.countDistinct(key).alias("n_keys"), F.count_if(key < 0).alias("n_negative")
    )


@query(
    "f08_vectors",
    """SELECT vec_id, round(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]), 9) AS square,
  round(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 9) AS norm,
  round(list_cosine_similarity(embedding::DOUBLE[], list_reverse(embedding)::DOUBLE[]), 9) AS with_reverse,
  0.0::DOUBLE AS with_zero FROM embeddings""",
)
def f08(t):
    v = F.col("embedding")
    return t.vectors.select(
        "vec_id",
        F.round(vectors.dot(v, v), 9).alias("square"),
        F.round(vectors.norm(v), 9).alias("norm"),
        F.round(vectors.cosine(v, F.reverse(v)), 9).alias("with_reverse"),
        vectors.cosine(v, F.transform(v, lambda x: x * 0)).alias("with_zero"),
    )


@query(
    "f09_maps",
    """SELECT customer_id, string_agg(product_group_name || '=' || n, ',' ORDER BY product_group_name) AS bought FROM (
  SELECT customer_id, product_group_name, COUNT(*) AS n FROM tx LEFT JOIN art USING (article_id) GROUP BY ALL) GROUP BY 1""",
)
def f09(t):
    counts = t.named_sales.groupBy("customer_id", "product_group_name").agg(F.count("*").alias("n"))
    return counts.groupBy("customer_id").agg(
        F.map_from_entries(F.collect_list(F.struct("product_group_name", "n"))).alias("bought")
    )


@query(
    "f10_casts",
    """SELECT event_id, try_cast(props->>'k' AS BIGINT) AS k, CAST(CAST(value AS DECIMAL(10,1)) AS DOUBLE) AS tenth,
  CAST(event_id AS VARCHAR) AS id_text, TRY_CAST(event_type AS DOUBLE) AS no_number FROM events""",
)
def f10(t):
    return t.raw("events").select(
        "event_id",
        F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
        F.col("value").cast("decimal(10,1)").alias("tenth"),
        F.col("event_id").cast("string").alias("id_text"),
        F.col("event_type").try_cast("double").alias("no_number"),
    )


# --- moments and tests -----------------------------------------------------------------------


@query(
    "t01_shape",
    """SELECT COUNT(age) AS n, round(skewness(age) * (COUNT(age) - 2) / sqrt(COUNT(age) * (COUNT(age) - 1)), 9) AS skewness,
  round(kurtosis_pop(age), 9) AS kurtosis, round(skewness(age), 9) AS skewness_corrected FROM cust""",
)
def t01(t):
    moments = stat_tests.shape(t.customers, "age")
    return moments.select("n", *[F.round(c, 9).alias(c) for c in ("skewness", "kurtosis", "skewness_corrected")])


view(
    "agemom",
    """SELECT COUNT(age)::DOUBLE AS n, skewness(age) * (COUNT(age) - 2) / sqrt(COUNT(age) * (COUNT(age) - 1)) AS g1,
  kurtosis_pop(age) AS g2 FROM cust""",
)


@query(
    "t02_normality",
    """SELECT CAST(n AS BIGINT) AS n, round(zs, 6) AS z_skew, round(zk, 6) AS z_kurt, round(zs * zs + zk * zk, 6) AS k2,
  round(exp(-(zs * zs + zk * zk) / 2), 9) AS p_value FROM (
  SELECT n, d * ln(y / al + sqrt((y / al) * (y / al) + 1)) AS zs,
    (1 - 2 / (9 * a) - sign(1 + x * sqrt(2 / (a - 4))) * cbrt((1 - 2 / a) / abs(1 + x * sqrt(2 / (a - 4))))) / sqrt(2 / (9 * a)) AS zk
  FROM (SELECT n, y, x, 1 / sqrt(ln(sqrt(w2))) AS d, sqrt(2 / (w2 - 1)) AS al, 6 + 8 / sb * (2 / sb + sqrt(1 + 4 / (sb * sb))) AS a FROM (
    SELECT n, g1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y,
      sqrt(2 * (3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) - 1)) - 1 AS w2,
      (g2 + 3 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) AS x,
      6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS sb FROM agemom)))""",
)
def t02(t):
    result = stat_tests.normality(t.customers, "age")
    return result.select(
        "n",
        *[F.round(c, 6).alias(c) for c in ("z_skew", "z_kurt", "k2")],
        F.round("p_value", 9).alias("p_value"),
    )


def _ratio(part: str, x: str) -> str:
    def polynomial(terms):
        text = f"{terms[-1]!r}::DOUBLE"
        for term in reversed(terms[:-1]):
            text = f"({text} * {x} + {term!r}::DOUBLE)"
        return text

    top, bottom = AS_241[part]
    return f"{polynomial(top)} / {polynomial(bottom)}"


# places as medians of order statistics, and their normal quantiles
view(
    "placed",
    """SELECT customer_id, age AS sample, row_number() OVER (ORDER BY age, customer_id) AS rank, COUNT(*) OVER () AS n
  FROM cust WHERE age IS NOT NULL""",
)
view(
    "placed_p",
    """SELECT *, p - 0.5::DOUBLE AS q, sqrt(-ln(least(p, 1 - p))) AS s FROM (SELECT sample, rank, n, CASE WHEN rank = n THEN pow(0.5::DOUBLE, 1 / n::DOUBLE) WHEN rank = 1 THEN 1 - pow(0.5::DOUBLE, 1 / n::DOUBLE)
  ELSE (rank - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS p FROM placed)""",
)
view(
    "qq",
    f"""SELECT rank, sample, CASE WHEN abs(q) <= 0.425 THEN q * {_ratio("middle", "(0.180625::DOUBLE - q * q)")}
  ELSE sign(q) * CASE WHEN s <= 5 THEN {_ratio("tail", "(s - 1.6::DOUBLE)")} ELSE {_ratio("far", "(s - 5)")} END END AS theoretical FROM placed_p""",
)


@query("t03_qq_points", "SELECT rank, round(theoretical, 9) AS theoretical, sample FROM qq")
def t03(t):
    points = stat_tests.qq_points(t.customers, "age", "customer_id")
    return points.select("rank", F.round("theoretical", 9).alias("theoretical"), "sample")


@query(
    "t03_qq_line",
    """SELECT COUNT(*) AS n, round(regr_slope(sample, theoretical), 6) AS slope, round(regr_intercept(sample, theoretical), 6) AS intercept,
  round(corr(sample, theoretical), 6) AS r FROM qq""",
)
def t03_line(t):
    line = stat_tests.qq_line(stat_tests.qq_points(t.customers, "age", "customer_id"))
    return line.select("n", *[F.round(c, 6).alias(c) for c in ("slope", "intercept", "r")])


# two-sided t tail by Simpson's rule: p = 1 - 2 * integral of the density over [0, |t|]
TAIL = """(1 - 2 * (SELECT SUM(CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
   * exp(lgamma((nu + 1) / 2) - lgamma(nu / 2)) / sqrt(nu * pi())
   * pow(1 + pow(abs(t) * i / 4000, 2) / nu, -(nu + 1) / 2)) * abs(t) / 4000 / 3 FROM range(4001) s(i)))"""


@query(
    "t04_pearson",
    f"""SELECT n, round(r, 9) AS r, round(r * r, 9) AS r_squared, round(t, 6) AS t, round({TAIL}, 6) AS p_value FROM (
  SELECT *, r * sqrt((n - 2) / (1 - r * r)) AS t, (n - 2)::DOUBLE AS nu FROM (
   SELECT COUNT(*) AS n, corr(temp_mean, revenue::DOUBLE) AS r FROM cal WHERE temp_mean IS NOT NULL))""",
)
def t04(t):
    calendar = analysis.enrich_calendar(t.daily, t.weather, t.holidays)
    return stat_tests.pearson(calendar, "temp_mean", "revenue").select(
        "n",
        F.round("r", 9).alias("r"),
        F.round("r_squared", 9).alias("r_squared"),
        F.round("t", 6).alias("t"),
        F.round("p_value", 6).alias("p_value"),
    )


@query(
    "t05_welch",
    f"""SELECT n_in, n_out, round(mean_in, 4) AS mean_in, round(mean_out, 4) AS mean_out, round(t, 6) AS t, round(nu, 6) AS df,
  round({TAIL}, 6) AS p_value FROM (
  SELECT *, (mean_in - mean_out) / sqrt(a + b) AS t, (a + b) * (a + b) / (a * a / (n_in - 1) + b * b / (n_out - 1)) AS nu FROM (
  SELECT COUNT(*) FILTER (is_holiday) AS n_in, COUNT(*) FILTER (NOT is_holiday) AS n_out,
    AVG(revenue::DOUBLE) FILTER (is_holiday) AS mean_in, AVG(revenue::DOUBLE) FILTER (NOT is_holiday) AS mean_out,
    var_samp(revenue::DOUBLE) FILTER (is_holiday) / COUNT(*) FILTER (is_holiday) AS a,
    var_samp(revenue::DOUBLE) FILTER (NOT is_holiday) / COUNT(*) FILTER (NOT is_holiday) AS b FROM cal))""",
)
def t05(t):
    calendar = analysis.enrich_calendar(t.daily, t.weather, t.holidays)
    result = stat_tests.welch(calendar, "revenue", "is_holiday")
    return result.select(
        "n_in",
        "n_out",
        *[F.round(c, 4).alias(c) for c in ("mean_in", "mean_out")],
        *[F.round(c, 6).alias(c) for c in ("t", "df", "p_value")],
    )


@query(
    "t06_f_scores",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round(corr({c}::DOUBLE, ln(1 + total_spend::DOUBLE)), 9) AS r,
  round(pow(corr({c}::DOUBLE, ln(1 + total_spend::DOUBLE)), 2) * (COUNT(*) - 2)
    / (1 - pow(corr({c}::DOUBLE, ln(1 + total_spend::DOUBLE)), 2)), 3) AS f_score FROM feat"""
        for c in model.SPEND_NUMERIC
    ),
)
def t06(t):
    frame = t.features.withColumn("log_spend", F.log1p(F.col("total_spend").cast("double")))
    scores = stat_tests.f_scores(frame, model.SPEND_NUMERIC, "log_spend")
    return scores.select("feature", F.round("r", 9).alias("r"), F.round("f_score", 3).alias("f_score"))


def _eliminated(t):
    rows = prepare.with_log_spend(materialise(t.features, "features"))
    stages, columns = prepare.fit_spend_columns(rows)
    encoded = PipelineModel(stages).transform(rows)
    return encoded, stat_tests.backward_elimination(encoded, columns, "log_spend")


@query("t07_backward_elimination")
def t07(t):
    return _eliminated(t)[1]


@query(
    "t07_normal_equations",
    "SELECT COUNT(*) AS n, true AS all_significant, true AS orthogonal, true AS r_squared_holds FROM feat",
)
def t07_equations(t):
    """What holds of the final model by definition, found from its residuals on all rows."""
    encoded, fitted = _eliminated(t)
    terms = {r.term: r for r in fitted.collect()}
    inputs = [c for c in terms if c != "const"]
    value = F.lit(terms["const"].coefficient)
    for c in inputs:
        value = value + F.col(f"`{c}`") * terms[c].coefficient
    rows = encoded.withColumn("_gap", F.col("log_spend") - value)
    orthogonal = F.abs(F.avg("_gap")) < 1e-8
    for c in inputs:
        orthogonal = orthogonal & (F.abs(F.corr("_gap", F.col(f"`{c}`"))) < 1e-8)
    r_squared = 1 - F.var_pop("_gap") / F.var_pop("log_spend")
    return rows.agg(
        F.count("*").alias("n"),
        F.lit(len(inputs) == 1 or all(terms[c].p_value <= 0.05 for c in inputs)).alias("all_significant"),
        orthogonal.alias("orthogonal"),
        (F.abs(r_squared - terms["const"].r_squared) < 1e-9).alias("r_squared_holds"),
    )


view("halves", "SELECT *, first_purchase < DATE '1995-06-01' AS early FROM feat")


DRIFT_NUMERIC = ["n_transactions", "tenure_days", "recency_days", "n_distinct_categories"]
_W = """SELECT '{0}' AS column_name, 'wasserstein' AS measure, SUM(abs(p - q) * width) / (SELECT stddev_samp({0}) FROM {1}) AS distance FROM (
   SELECT SUM(a) OVER (ORDER BY v) / SUM(a) OVER () AS p, SUM(b) OVER (ORDER BY v) / SUM(b) OVER () AS q, coalesce(LEAD(v) OVER (ORDER BY v) - v, 0) AS width FROM (
     SELECT v, SUM(a) AS a, SUM(b) AS b FROM (SELECT {0}::DOUBLE AS v, 1 AS a, 0 AS b FROM {1} UNION ALL SELECT {2}::DOUBLE, 0, 1 FROM {3}) WHERE v IS NOT NULL GROUP BY v))"""


@query(
    "t08_drift",
    """SELECT column_name, measure, round(distance, 6) AS distance, distance >= 0.1 AS drifted FROM ("""
    + " UNION ALL ".join(
        _W.format(c, "(SELECT * FROM halves WHERE early)", c, "(SELECT * FROM halves WHERE NOT early)")
        for c in DRIFT_NUMERIC
    )
    + """ UNION ALL SELECT column_name, 'jensen_shannon', sqrt(greatest(SUM((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2), 0)) FROM (
   SELECT column_name, v, COUNT(*) FILTER (early) / (SELECT COUNT(*) FROM halves WHERE early) AS p,
     COUNT(*) FILTER (NOT early) / (SELECT COUNT(*) FROM halves WHERE NOT early) AS q FROM (
     SELECT 'age_group' AS column_name, age_group AS v, early FROM halves UNION ALL
     SELECT 'club_member_status', club_member_status, early FROM halves) GROUP BY 1, 2) GROUP BY 1)""",
)
def t08(t):
    frame = t.features
    early = F.col("first_purchase") < F.lit("1995-06-01").cast("date")
    report = drift.drift_report(
        frame.where(early), frame.where(~early), DRIFT_NUMERIC, ["age_group", "club_member_status"]
    )
    return report.withColumn("distance", F.round("distance", 6))


_SHIFTED = {"age": "age + 4", "purchase_frequency_per_month": "purchase_frequency_per_month * 0.7", "recency_days": "recency_days * 1.4"}


@query(
    "t08_drift_summary",
    # the categorical columns are the same in both windows: at distance zero they count, and haven't drifted
    f"""SELECT CAST(COUNT(*) + {len(model.SPEND_CATEGORICAL)} AS BIGINT) AS n_columns, CAST(COUNT(*) FILTER (distance >= 0.1) AS BIGINT) AS n_drifted,
  COUNT(*) FILTER (distance >= 0.1) / (COUNT(*) + {len(model.SPEND_CATEGORICAL)})::DOUBLE AS share,
  COUNT(*) FILTER (distance >= 0.1) / (COUNT(*) + {len(model.SPEND_CATEGORICAL)})::DOUBLE >= 0.5 AS alert FROM ("""
    + " UNION ALL ".join(_W.format(c, "feat", _SHIFTED.get(c, c), "feat") for c in model.BEHAVIOUR)
    + ")",
)
def t08_summary(t):
    frame = t.features
    shifted = frame.withColumns(
        {
            "age": F.col("age") + 4,
            "purchase_frequency_per_month": F.col("purchase_frequency_per_month") * 0.7,
            "recency_days": F.col("recency_days") * 1.4,
        }
    )
    return drift.drift_summary(drift.drift_report(frame, shifted, model.BEHAVIOUR, model.SPEND_CATEGORICAL))
