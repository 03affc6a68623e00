"""Distributed operators against brute force, with hot groups and many equal values."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillwise.operators import analysis, drift, features, inverted, ranking, retrieval, sketches
from tillwise.operators.neighbours import nearest
from tillwise.operators.quantiles import exact_quantiles

MARKS = {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q3": 0.9, "q4": 1.0}


def skewed(n=3000, seed=1):
    """A third of the rows in one group, and a third of the values equal."""
    random = np.random.default_rng(seed)
    group = np.where(random.random(n) < 0.34, "hot", random.integers(0, 7, n).astype(str))
    value = np.where(random.random(n) < 0.34, 5.0, np.round(random.gamma(2, 50, n), 2))
    return pd.DataFrame({"id": np.arange(n), "g": group, "v": value})


def test_quantiles_of_a_table(spark):
    pdf = skewed()
    row = exact_quantiles(spark.createDataFrame(pdf), "v", MARKS).first()
    for name, q in MARKS.items():
        assert row[name] == pytest.approx(np.quantile(pdf.v, q), abs=1e-12)


def test_quantiles_by_group(spark):
    pdf = skewed()
    rows = exact_quantiles(spark.createDataFrame(pdf), "v", MARKS, by=["g"]).collect()
    assert {r.g for r in rows} == set(pdf.g)
    for r in rows:
        values = pdf.v[pdf.g == r.g]
        assert [r[n] for n in MARKS] == pytest.approx([np.quantile(values, q) for q in MARKS.values()], abs=1e-12)


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [3.0, 3.0, 3.0], [None, 4.0, 1.0]])
def test_quantiles_of_few_values(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    row = exact_quantiles(frame, "v", MARKS).first()
    known = [v for v in values if v is not None]
    assert [row[n] for n in MARKS] == pytest.approx([np.quantile(known, q) for q in MARKS.values()])


@pytest.mark.parametrize("by", [None, ["g"]])
def test_quantiles_slice_by_slice(spark, by):
    """Brackets of more values than a window may hold: slices give the same result."""
    pdf = skewed(4000, seed=2)
    frame = spark.createDataFrame(pdf).repartition(5)
    plain = exact_quantiles(frame, "v", MARKS, by=by).collect()
    sliced = exact_quantiles(frame, "v", MARKS, by=by, window_rows=0).collect()
    assert sorted(map(str, sliced)) == sorted(map(str, plain)) and plain


def test_a_slice_holds_few_of_the_distinct_values(spark):
    from tillwise.operators.quantiles import _summed_upto

    cells = spark.range(1_000_000).select(
        F.lit(0).alias("_i"), (F.col("id") * 7919 % 1_000_003).cast("double").alias("_v"), F.lit(1).alias("_n")
    )
    summed = _summed_upto(cells, ["_i"], True)
    at = summed.where("_v IN (0.0, 7919.0)").collect()
    values = np.sort(np.arange(1_000_000) * 7919 % 1_000_003)
    assert {r["_v"]: r["_end"] for r in at} == {float(v): int(np.searchsorted(values, v) + 1) for v in (0, 7919)}
    largest = summed.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest < 600_000


def test_no_group_is_a_group(spark):
    rows = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0), ("a", None)], "g STRING, v DOUBLE")
    got = {r.g: r.m for r in exact_quantiles(rows, "v", {"m": 0.5}, by=["g"]).collect()}
    assert got == {None: 2.0, "a": 5.0}
    boxes = {r.g: (r.n, r.median) for r in analysis.box_summary(rows, "v", "g").collect()}
    assert boxes == {None: (2, 2.0), "a": (1, 5.0)}


def test_rows_are_not_shuffled_by_a_key_of_few_values(spark):
    """With thresholds as small as they are beside large inputs, the summary is still broadcast."""
    frame = spark.createDataFrame(skewed(500))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        train, _ = ranking.stratified_split(frame, "g", "id")
        for planned in (analysis.box_summary(frame, "v", "g"), exact_quantiles(frame, "v", {"m": 0.5}, by=["g"]), train):
            plan = planned._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_quantiles_with_a_coarse_sketch(spark, monkeypatch):
    """Brackets much wider than one value still give the exact result."""
    import tillwise.operators.quantiles as module

    monkeypatch.setattr(module, "ACCURACY", 50)
    pdf = skewed(5000, seed=3)
    row = exact_quantiles(spark.createDataFrame(pdf).repartition(7), "v", MARKS).first()
    assert [row[n] for n in MARKS] == pytest.approx([np.quantile(pdf.v, q) for q in MARKS.values()], abs=1e-12)


def test_rank_and_tiles(spark):
    pdf = skewed(1003)
    frame = spark.createDataFrame(pdf).repartition(5)
    got = ranking.equal_count_tiles(
        ranking.global_rank(frame, F.asc("v"), F.asc("id")), 4, F.asc("v"), F.asc("id")
    ).toPandas().sort_values("rank")
    want = pdf.sort_values(["v", "id"]).id.to_numpy()
    assert (got["id"].to_numpy() == want).all()
    sizes = got.groupby("tile").size().tolist()
    assert sizes == [251, 251, 251, 250] and got.tile.is_monotonic_increasing


def test_fewer_rows_than_tiles(spark):
    frame = spark.range(2)
    assert sorted(r.tile for r in ranking.equal_count_tiles(frame, 4, F.asc("id")).collect()) == [1, 2]


def test_split_is_exact_and_independent_of_partitioning(spark):
    frame = spark.createDataFrame(skewed())
    train, test = ranking.stratified_split(frame, "g", "id")
    train_2, test_2 = ranking.stratified_split(frame.repartition(11), "g", "id")
    ids = {r.id for r in test.collect()}
    assert ids == {r.id for r in test_2.collect()}
    assert train.count() + len(ids) == frame.count()
    sizes = {r.g: r["count"] for r in frame.groupBy("g").count().collect()}
    for r in test.groupBy("g").count().collect():
        assert r["count"] == int(sizes[r.g] * 0.2 + 0.5)


@pytest.mark.parametrize("n", [10, 100, 2000, 9999])
def test_sample_is_exact_and_fixed(spark, n):
    frame = spark.createDataFrame(skewed())
    ids = [r.id for r in ranking.sample_rows(frame, n, "id").collect()]
    again = [r.id for r in ranking.sample_rows(frame.repartition(9), n, "id").collect()]
    assert len(set(ids)) == min(n, 3000) and ids == again
    # also when one key fills a third of the rows
    assert ranking.sample_rows(frame, n, "g").count() == min(n, 3000)


def test_cap_per_stratum(spark):
    capped = ranking.cap_per_stratum(spark.createDataFrame(skewed()), "g", "id", 100)
    assert {r["count"] for r in capped.groupBy("g").count().collect()} == {100}


def test_features_with_one_customer_holding_a_third(spark):
    pdf = skewed(4000).rename(columns={"g": "customer_id", "v": "price"})
    pdf["product_group_name"] = (pdf.id % 5).astype(str)
    pdf["t_dat"] = pd.to_datetime("2020-01-01") + pd.to_timedelta(pdf.id % 200, unit="D")
    sales = spark.createDataFrame(pdf).withColumn("t_dat", F.col("t_dat").cast("date"))
    got = features.rfm_base(sales).toPandas().set_index("customer_id").sort_index()
    want = pdf.groupby("customer_id").agg(
        spend=("price", "sum"), n=("id", "size"), categories=("product_group_name", "nunique")
    )
    assert got.n_transactions.tolist() == want.n.tolist()
    assert got.total_spend.tolist() == pytest.approx(want.spend.tolist())
    assert got.n_distinct_categories.tolist() == want.categories.tolist()


def test_box_summary(spark):
    pdf = skewed()
    for r in analysis.box_summary(spark.createDataFrame(pdf), "v", "g").collect():
        v = pdf.v[pdf.g == r.g]
        q1, q3 = np.quantile(v, 0.25), np.quantile(v, 0.75)
        inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
        assert (r.whisker_low, r.whisker_high) == (inside.min(), inside.max())
        assert r.n_outliers == len(v) - len(inside) and r.n == len(v)


@pytest.mark.parametrize("block", [7, 1000])
def test_search_in_blocks_equals_brute_force(spark, block):
    random = np.random.default_rng(4)
    corpus, queries = random.normal(size=(200, 8)), random.normal(size=(20, 8))
    found = retrieval.search(
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query_id INT, embedding ARRAY<DOUBLE>"),
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(corpus)], "vec_id INT, embedding ARRAY<DOUBLE>").repartition(5),
        n=3,
        threshold=-1.0,
        block=block,
    ).collect()
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    order = np.argsort(-(unit(queries) @ unit(corpus).T), axis=1)[:, :3]
    assert {(r.query_id, r["rank"], r.vec_id) for r in found} == {
        (q, i + 1, int(order[q, i])) for q in range(20) for i in range(3)
    }


@pytest.mark.parametrize("block", [13, 1000])
def test_neighbours_in_blocks_equal_brute_force(spark, block):
    random = np.random.default_rng(5)
    x = random.normal(size=(120, 3))
    frame = spark.createDataFrame([(str(i), v.tolist()) for i, v in enumerate(x)], "id STRING, x ARRAY<DOUBLE>")
    found = nearest(frame.repartition(4), frame, 4, "id", "x", "x", skip_self=True, block=block).collect()
    gaps = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(gaps, np.inf)
    order = np.argsort(gaps, axis=1)[:, :4]
    assert {(int(r.id), r["rank"], int(r.near_key)) for r in found} == {
        (i, j + 1, int(order[i, j])) for i in range(120) for j in range(4)
    }


def test_equal_neighbours_go_to_the_smaller_key(spark):
    """A third of the pool is one and the same vector."""
    rows = [(i, [1.0, 0.0] if i % 3 == 0 else [0.0, float(i + 1)]) for i in range(90)]
    pool = spark.createDataFrame(rows, "vec_id INT, embedding ARRAY<DOUBLE>")
    queries = spark.createDataFrame([(0, [1.0, 0.0])], "query_id INT, embedding ARRAY<DOUBLE>")
    for parts in (1, 7):
        found = retrieval.search(queries, pool.repartition(parts), n=4).orderBy("rank").collect()
        assert [r.vec_id for r in found] == [0, 3, 6, 9]
    named = pool.select(F.col("vec_id").alias("id"), F.col("embedding").alias("x"))
    near = nearest(named.where("id = 30"), named.repartition(5), 3, "id", "x", "x", skip_self=True, block=20)
    assert [r.near_key for r in near.orderBy("rank").collect()] == [0, 3, 6]


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "query_id INT, embedding ARRAY<DOUBLE>")
    corpus = spark.createDataFrame([(1, [1.0])], "vec_id INT, embedding ARRAY<DOUBLE>")
    assert retrieval.search(empty, corpus).count() == 0
    assert exact_quantiles(spark.createDataFrame([], "v DOUBLE"), "v", MARKS).count() in (0, 1)


def test_running_sum_over_slices(spark):
    rows = [(i, None if i % 7 == 0 else (i * 37) % 11) for i in range(500)]
    df = spark.createDataFrame(rows, "id INT, v INT").repartition(5)
    got = {r.id: r.s for r in ranking.running_sum(df, "v", F.desc("id"), name="s", rows=16).collect()}
    total, want = 0, {}
    for i, v in reversed(rows):
        total += v or 0
        want[i] = total
    assert got == want


def test_drift_in_small_slices_is_the_same(spark):
    r = random.Random(3)
    ref = spark.createDataFrame([(r.gauss(0, 1), r.choice([1.0, 2.0])) for _ in range(400)], "a DOUBLE, b DOUBLE")
    cur = spark.createDataFrame([(r.gauss(0.3, 1), r.choice([1.0, 3.0])) for _ in range(300)], "a DOUBLE, b DOUBLE")
    whole = {x.column_name: x.distance for x in drift.numeric_drift(ref, cur, ["a", "b"]).collect()}
    small = {x.column_name: x.distance for x in drift.numeric_drift(ref, cur, ["a", "b"], rows=7).collect()}
    assert whole.keys() == small.keys() and all(abs(whole[c] - small[c]) < 1e-9 for c in whole)


def test_day_sketches_merge_to_those_of_all_days(spark):
    r = random.Random(4)
    rows = [(f"c{r.randrange(3000)}", r.randrange(200), float(r.randrange(10_000)), d) for d in range(20) for _ in range(400)]
    df = spark.createDataFrame(rows, "customer_id STRING, article_id INT, price DOUBLE, t_dat INT")
    days = sketches.daily(df).collect()
    stored = spark.createDataFrame(days, sketches.daily(df).schema)
    said = sketches.estimates(stored).first()
    customers, articles = len({x[0] for x in rows}), len({x[1] for x in rows})
    assert said.n == len(rows) and abs(said.customer_id_hll - customers) <= sketches.COUNT_ERROR * customers
    assert abs(said.customer_id_theta - customers) <= sketches.COUNT_ERROR * customers and said.article_id_theta == articles
    assert abs(sum(x[2] <= said.price_50 for x in rows) / len(rows) - 0.5) < 2 * sketches.RANK_ERROR
    early, late = ({x[0] for x in rows if lo <= x[3] < lo + 10} for lo in (0, 10))
    both = sketches.in_both(stored.where("t_dat < 10"), stored.where("t_dat >= 10")).first()
    assert abs(both.in_both - len(early & late)) <= sketches.COUNT_ERROR * len(early | late)
    assert sketches.estimates(stored.limit(0)).first().n is None


def test_inverted_file_finds_neighbours_and_leaves_out_what_has_no_direction(spark, monkeypatch):
    monkeypatch.setattr(inverted, "BLOCK", 60)
    monkeypatch.setattr(inverted, "QUERIES", 7)
    r = np.random.default_rng(9)
    rows = [(i, [float(x) for x in r.normal(size=16)]) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(150)]  # a hot cell of copies
    rows += [(2000, [0.0] * 16), (2001, None)]
    corpus = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    probe = corpus.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    index = inverted.build(corpus, cells=8, parts=4, codes=32)
    assert index.rows.count() == 550 and index.rows.groupBy("cell", "block").count().agg(F.max("count")).first()[0] < 150
    found = inverted.search(index, probe, n=3, probes=8, keep=60, skip_self=True).collect()
    exact = {(x.query_id, x.vec_id): x.similarity for x in retrieval.search(probe, corpus.where("vec_id < 2000"), n=600, threshold=-1.0).collect()}
    best = {}
    for (q, v), s in exact.items():
        if q != v:
            best.setdefault(q, []).append((-s, v))
    got = {}
    for x in found:
        assert x.query_id != x.vec_id and abs(x.similarity - exact[x.query_id, x.vec_id]) < 1e-9
        got.setdefault(x.query_id, set()).add(x.similarity)
    hits = [round(-s, 9) in {round(v, 9) for v in got[q]} for q in best if q < 2000 for s, _ in sorted(best[q])[:3]]
    assert np.mean(hits) >= 0.9
    assert inverted.search(inverted.build(corpus.limit(0)), probe).count() == 0
    assert inverted.search(index, probe.limit(0)).count() == 0
