"""Edges of cleaning, features and reports on hand-made rows."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from tillwise.functions.columns import age_group, share, surrogate_key, week_ending
from tillwise.functions.vectors import cosine
from tillwise.operators import analysis, cleaning, features, replies, retrieval, star, stat_tests

DAY = dt.date


def test_age_edges(spark):
    ages = [None, 15.9, 16.0, 19.99, 20.0, 25.0, 30.0, 35.0, 40.0, 50.0, 60.0, 70.0, 99.9, 100.0]
    rows = spark.createDataFrame([(a,) for a in ages], "age DOUBLE").select(
        "age", age_group(F.col("age")).alias("g"), age_group(F.col("age"), strict=True).alias("s")
    )
    got = {r.age: (r.g, r.s) for r in rows.collect()}
    assert got[None] == (None, None)
    assert got[15.9] == ("16-19", None)
    assert got[16.0] == got[19.99] == ("16-19", "16-19")
    assert [got[a][0] for a in (20.0, 25.0, 30.0, 35.0, 40.0, 50.0, 60.0, 70.0)] == [
        "20-24", "25-29", "30-34", "35-39", "40-49", "50-59", "60-69", "70+",
    ]
    assert got[99.9] == ("70+", "70+") and got[100.0] == ("70+", None)


def test_mode_tie_takes_the_smallest(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c STRING")
    assert spark.range(1).select(cleaning.most_frequent(rows, "c").alias("m")).first().m == "a"


def test_no_known_age_is_an_error(spark):
    rows = spark.createDataFrame(
        [("1", None, "A", "N", "x")],
        "customer_id STRING, age DOUBLE, club_member_status STRING, fashion_news_frequency STRING, postal_code STRING",
    )
    with pytest.raises(Exception, match="no valid age"):
        cleaning.impute_customers(rows).collect()


def test_split_keeps_every_row(spark):
    options = {
        "t_dat": ["2020-01-01", None, "soon"],
        "customer_id": ["c", None, ""],
        "article_id": [1, None],
        "price": [1.0, None, 0.0, -1.0, float("nan"), 1e-9],
    }
    rows = [(*values, 1) for values in itertools.product(*options.values())]
    frame = spark.createDataFrame(
        rows, "t_dat STRING, customer_id STRING, article_id BIGINT, price DOUBLE, sales_channel_id INT"
    )
    valid, rejected = cleaning.split_valid(frame)
    good = valid.collect()
    assert len(good) + rejected.count() == len(rows)
    # a readable day, an id (also an empty one), an article and a price above zero
    assert len(good) == 1 * 2 * 1 * 2
    assert all(r.t_dat == DAY(2020, 1, 1) for r in good)
    reasons = rejected.where("price IS NULL AND customer_id IS NULL AND article_id IS NULL AND t_dat IS NULL").first()
    assert set(reasons.rejection_reason) == {
        "price_missing", "customer_id_missing", "article_id_missing", "t_dat_missing",
    }


def test_surrogate_key_of_nothing(spark):
    rows = spark.createDataFrame([("x",), (None,)], "id STRING").select("id", surrogate_key(F.col("id")).alias("k"))
    got = {r.id: r.k for r in rows.collect()}
    assert got[None] == -1 and got["x"] >= 0


def _sales(spark, rows):
    return spark.createDataFrame(
        rows, "customer_id STRING, t_dat DATE, price DECIMAL(18,2), product_group_name STRING, article_id BIGINT"
    )


def test_one_purchase_customer(spark):
    from decimal import Decimal

    sales = _sales(spark, [("c", DAY(2020, 9, 12), Decimal("10.00"), "Shoes", 1)])
    row = features.with_behaviour(features.rfm_base(sales), "2020-09-22").first()
    assert (row.recency_days, row.tenure_days, row.n_distinct_categories) == (10, 0, 1)
    assert row.purchase_frequency_per_month == 30.0 and row.avg_basket_value == 10.0


def test_unknown_customers_have_no_features(spark):
    from decimal import Decimal

    sales = _sales(
        spark, [(None, DAY(2020, 1, 1), Decimal("5.00"), "A", 1), ("c", DAY(2020, 1, 1), Decimal("7.00"), None, 2)]
    )
    rows = features.rfm_base(sales).collect()
    assert [(r.customer_id, r.n_distinct_categories) for r in rows] == [("c", 0)]


def test_equal_spend_and_repeated_edges(spark):
    rows = spark.createDataFrame([(str(i), 5.0) for i in range(8)], "customer_id STRING, total_spend DOUBLE")
    assert {r.value_segment for r in features.with_segment(rows).collect()} == {"Q1 low"}
    with pytest.raises(Exception, match="not unique"):
        features.with_segment(rows, strict_edges=True).collect()


def test_fewer_customers_than_segments(spark):
    rows = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", None)], "customer_id STRING, total_spend DOUBLE")
    got = {r.customer_id: r.value_segment for r in features.with_segment(rows).collect()}
    assert got == {"a": "Q1 low", "b": "Q4 VIP", "c": None}


def test_weeks_end_on_sunday_and_gaps_count_zero(spark):
    sunday, monday, later = DAY(2020, 3, 1), DAY(2020, 3, 2), DAY(2020, 3, 20)
    rows = spark.createDataFrame([(sunday,), (monday,), (later,)], "t_dat DATE")
    assert rows.select(week_ending(F.col("t_dat")).alias("w")).first().w == sunday
    got = [(r.week, r.n) for r in analysis.weekly_volume(rows).collect()]
    assert got == [(sunday, 1), (DAY(2020, 3, 8), 1), (DAY(2020, 3, 15), 0), (DAY(2020, 3, 22), 1)]


def test_share_of_nothing_is_null(spark):
    row = spark.range(1).select(share(F.lit(0), F.lit(0)).alias("z"), share(F.lit(3), F.lit(3)).alias("one")).first()
    assert row.z is None and row.one == 100.0


def test_overlapping_periods_do_not_double_days(spark):
    daily = spark.createDataFrame([(DAY(2020, 1, i),) for i in range(1, 11)], "date DATE")
    periods = spark.createDataFrame(
        [(DAY(2020, 1, 2), DAY(2020, 1, 4)), (DAY(2020, 1, 4), DAY(2020, 1, 5))], "period_start DATE, period_end DATE"
    )
    got = {r.date.day: r.is_sale_period for r in analysis.flag_sale_periods(daily, periods).collect()}
    assert len(got) == 10 and sorted(d for d, f in got.items() if f) == [2, 3, 4, 5]


def test_histogram_holds_the_maximum(spark):
    rows = spark.createDataFrame([(float(i),) for i in range(11)], "x DOUBLE")
    got = [r.n for r in analysis.histogram(rows, "x", 5).orderBy("bin").collect()]
    assert got == [2, 2, 2, 2, 3]


def test_orphan_sales_survive_the_master_join(spark):
    from decimal import Decimal

    sales = _sales(spark, [("ghost", DAY(2020, 1, 1), Decimal("1.00"), None, 99), (None, DAY(2020, 1, 1), Decimal("1.00"), None, None)])
    customers = spark.createDataFrame([("c", 30.0)], "customer_id STRING, age DOUBLE")
    articles = spark.createDataFrame([(1, "shirt")], "article_id BIGINT, prod_name STRING")
    assert star.master(sales, customers, articles).count() == 2


def test_cosine_edges(spark):
    pairs = [([1.0, 0.0], [1.0, 0.0], 1.0), ([1.0, 0.0], [-1.0, 0.0], -1.0), ([0.0, 0.0], [1.0, 0.0], 0.0)]
    rows = spark.createDataFrame(pairs, "a ARRAY<DOUBLE>, b ARRAY<DOUBLE>, want DOUBLE")
    for r in rows.withColumn("got", cosine(F.col("a"), F.col("b"))).collect():
        assert r.got == pytest.approx(r.want)


def test_search_limits_first_and_keeps_the_threshold_itself(spark):
    queries = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 0.0])], "query_id INT, embedding ARRAY<DOUBLE>")
    corpus = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [0.3, (1 - 0.09) ** 0.5]), (3, [1.0, 0.1])], "vec_id INT, embedding ARRAY<DOUBLE>"
    )
    def found(n):
        return [(r.query_id, r.vec_id) for r in retrieval.search(queries, corpus, n=n).orderBy("query_id", "rank").collect()]

    assert found(2) == [(0, 1), (0, 3)]
    assert found(3) == [(0, 1), (0, 3), (0, 2)]


MARKDOWN = [
    ("no heading", "just text\nmore", [("T", "just text\nmore")]),
    ("title only", "# title", []),
    ("sections", "# title\nintro\n## One \nbody\n# dropped\n\n## Two\n   \n## Three\n x \n##not a heading", [
        ("T", "intro"), ("One", "body"), ("Three", "x \n##not a heading")]),
    ("starts with a section", "## A\r\nline\r\n## B\r\n", [("A", "line")]),
    ("empty", "", []),
]


@pytest.mark.parametrize("case,text,want", MARKDOWN, ids=[m[0] for m in MARKDOWN])
def test_markdown_sections(spark, case, text, want):
    docs = spark.createDataFrame([(1, text)], "doc_id INT, text STRING")
    rows = retrieval.markdown_sections(docs, "T").orderBy("section").collect()
    assert [(r.title, r.content) for r in rows] == want


REPLIES = [
    ('{"tool": "a", "parameters": {}}', True, True, "a"),
    ('```json\n{"tool": "a", "parameters": {"x": {"y": 1}}}\n```', True, True, "a"),
    ('text ``` no ``` and ```json{"tool": "b", "parameters": {}}``` end', True, True, "b"),
    ('before {"tool": "c", "parameters": {"q": "}"}} after', True, True, "c"),
    ('{"tool": "a"}', True, False, "a"),
    ('{"tool": "a", "parameters": null}', True, False, "a"),
    ('{"tool": "", "parameters": {}}', True, False, ""),
    ('{"tool": "a", "parameters": {}} {"more": 1', True, True, "a"),
    ('{"tool": "a", "parameters": {}} {"more": 1}', False, False, None),
    ("nothing here", False, False, None),
    (None, False, False, None),
]


@pytest.mark.parametrize("reply,valid,structure,tool", REPLIES)
def test_replies(spark, reply, valid, structure, tool):
    row = replies.parsed_replies(spark.createDataFrame([(reply,)], "reply STRING")).first()
    assert (row.valid_json, bool(row.valid_structure)) == (valid, structure)
    if valid:
        assert row.tool == tool


def test_affirmed_needs_a_sentence_without_negation(spark):
    texts = [
        ("Il y a 5 million de clients.", True),
        ("Il n'y a pas 5 million de clients.", False),
        ("Ce n'est pas cela. Il y a 5 million.", True),
        ("Le chiffre 5 million est erroné", False),
        ("Rien à dire", False),
    ]
    rows = spark.createDataFrame(texts, "text STRING, want BOOLEAN")
    got = rows.withColumn("got", replies.affirmed(F.lower("text"), replies.WRONG_CLIENTS)).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_points_round_half_to_even(spark):
    rows = spark.createDataFrame(
        [("a", 8.0, 2.9, 90.0, 90.0, True), ("b", 8.1, 8.0, 100.0, None, False)],
        "model_id STRING, ttft_avg DOUBLE, throughput_avg DOUBLE, valid_json_pct DOUBLE, correct_tool_pct DOUBLE, hallucination_free BOOLEAN",
    )
    got = {r.model_id: r for r in replies.ranking(replies.model_scores(rows)).collect()}
    assert got["a"].tool_points == 22 and got["a"].ttft_points == 10 and got["a"].throughput_points == 0
    assert got["b"].tool_points == 0 and got["b"].ttft_points == 0 and got["b"].throughput_points == 20
    assert got["a"].score_100 == 10 + 0 + 18 + 22 + 15 and got["a"].winner


def test_leaked_columns_stop_the_job(spark):
    with pytest.raises(ValueError, match="temp_mean"):
        cleaning.guard_features(spark.createDataFrame([(1, 2.0)], "customer_id INT, temp_mean DOUBLE"))


def test_p_values_match_published_tables():
    from tillwise.functions.probability import beta_share, student_two_sided

    for t, df, p in [(12.706, 1, 0.05), (2.228, 10, 0.05), (2.750, 30, 0.01), (1.96, 1e6, 0.05), (0.0, 5, 1.0)]:
        assert student_two_sided(t, df) == pytest.approx(p, abs=2e-4)
    assert beta_share(2, 3, 0.5) == pytest.approx(0.6875)


def test_normal_quantiles_equal_the_library(spark):
    from statistics import NormalDist

    from tillwise.functions.probability import normal_quantile

    shares = [1e-300, 1e-20, 1e-9, 0.001, 0.074, 0.076, 0.3, 0.5, 0.7, 0.975, 0.9999999]
    rows = spark.createDataFrame([(p,) for p in [*shares, 0.0, 1.0, None]], "p DOUBLE")
    got = {r.p: r.z for r in rows.select("p", normal_quantile(F.col("p")).alias("z")).collect()}
    assert got[0.0] is None and got[1.0] is None and got[None] is None
    for p in shares:
        assert got[p] == pytest.approx(NormalDist().inv_cdf(p), rel=1e-12, abs=1e-12)


def test_qq_points_cover_every_value(spark):
    rows = spark.createDataFrame([(i, float(i % 3)) for i in range(9)] + [(9, None)], "k INT, v DOUBLE")
    points = stat_tests.qq_points(rows, "v", "k").orderBy("rank").collect()
    assert [p.rank for p in points] == list(range(1, 10))
    assert [p.sample for p in points] == [0.0] * 3 + [1.0] * 3 + [2.0] * 3
    assert points[4].theoretical == pytest.approx(0) and points[0].theoretical == pytest.approx(-points[8].theoretical)
    line = stat_tests.qq_line(stat_tests.qq_points(rows, "v", "k")).first()
    assert line.n == 9 and line.intercept == pytest.approx(1) and 0.9 < line.r <= 1
    assert stat_tests.qq_points(rows.limit(0), "v", "k").count() == 0


def test_elimination_holds_for_columns_far_from_zero(spark):
    import numpy as np

    rows = spark.range(500).select(
        (F.lit(2.0e9) + F.col("id") % 7).alias("day"), (F.col("id") * 13 % 11).cast("double").alias("b"), F.lit(5.0).alias("same")
    ).withColumn("y", 1e-3 * F.col("day") + F.col("b") + F.sin(F.col("day") * 3) + F.sin(F.col("b") * 5))
    got = {r.term: r for r in stat_tests.backward_elimination(rows, ["day", "b", "same"], "y", limit=1.0).collect()}
    assert set(got) == {"const", "day", "b"}
    frame = rows.toPandas()
    x = np.column_stack([np.ones(500), frame["day"] - 2.0e9, frame["b"]])
    beta = np.linalg.lstsq(x, frame["y"], rcond=None)[0]
    gap = frame["y"] - x @ beta
    errors = np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * (gap @ gap) / 497)
    for i, term in [(1, "day"), (2, "b")]:
        assert got[term].coefficient == pytest.approx(beta[i], rel=1e-6)
        assert got[term].t == pytest.approx(beta[i] / errors[i], rel=1e-6)
    assert got["const"].r_squared == pytest.approx(1 - (gap @ gap) / (500 * frame["y"].var(ddof=0)), abs=1e-9)


def test_backward_elimination_drops_noise(spark):
    rows = spark.range(400).select(
        F.col("id").cast("double").alias("a"),
        (F.col("id") * 37 % 101).cast("double").alias("b"),
        F.rand(1).alias("noise"),
    ).withColumn("y", 3 * F.col("a") - 2 * F.col("b") + F.randn(2))
    got = {r.term: r.coefficient for r in stat_tests.backward_elimination(rows, ["a", "b", "noise"], "y").collect()}
    assert got["a"] == pytest.approx(3, abs=0.01) and got["b"] == pytest.approx(-2, abs=0.01)
    assert "const" in got
