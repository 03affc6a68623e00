"""The jobs, run on files from their command lines."""

import pytest
from pyspark.sql import functions as F

from tillwise import model
from tillwise.jobs import ingest, load, merge
from tillwise.sources.streams import encode_messages
from tillwise.sources.warehouse import Warehouse


def test_load_ingest_and_merge(spark, tables, tmp_path):
    for name, frame, schema in (
        ("transactions_train", tables.sales.limit(500), model.TRANSACTIONS),
        ("customers", tables.customers, model.CUSTOMERS),
        ("articles", tables.articles, model.ARTICLES),
    ):
        names = [c.split()[0] for c in schema.split(", ")]
        full = frame.withColumns({c: F.lit(None).cast("string") for c in names if c not in frame.columns})
        full.select(names).coalesce(1).write.option("header", True).csv(f"{tmp_path}/raw/{name}.csv")
    home, day = f"{tmp_path}/home", "2001-11-04"
    load.main(["--input", f"{tmp_path}/raw", "--warehouse", home, "--as-of", day])
    warehouse = Warehouse(spark, home)
    before = warehouse.read("fact_transaction").count()
    assert before == 500 and warehouse.read("customers_features_train").count() > 0

    sales = tables.sales.limit(20).withColumn("t_dat", F.col("t_dat").cast("string"))
    messages = encode_messages(sales).withColumn("timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    messages.write.parquet(f"{tmp_path}/messages")
    ingest.main(["--folder", f"{tmp_path}/messages", "--warehouse", home, "--checkpoint", f"{tmp_path}/check", "--once", "--enrich"])
    enriched = spark.read.parquet(f"{home}/stream_transactions_enriched/batches")
    assert enriched.count() == 20 and "club_member_status" in enriched.columns
    assert merge.main(["--warehouse", home, "--as-of", day]) == 0
    assert merge.main(["--warehouse", home, "--as-of", day]) is None
    # a load after the merge brings the stream's customers too: each stays once
    load.main(["--input", f"{tmp_path}/raw", "--warehouse", home, "--as-of", day])
    from tillwise.streaming.merge import merged_dim_customer, merged_dim_date

    people, days = merged_dim_customer(warehouse), merged_dim_date(warehouse)
    assert people.count() == people.select("customer_id").distinct().count()
    assert days.count() == days.select("date_key").distinct().count()


def test_a_broken_log_is_not_an_empty_table(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    assert not warehouse.exists("nothing")
    warehouse.overwrite("t", spark.range(3).toDF("a"))
    assert warehouse.read("t").count() == 3
    with pytest.raises(SystemExit):
        ingest.main(["--warehouse", "w", "--checkpoint", "c"])


def test_small_sides_are_broadcast(spark):
    from tillwise.operators.analysis import against_segment

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(1000).select(
            F.col("id").alias("customer_id"), F.concat(F.lit("s"), F.col("id") % 4).alias("value_segment"),
            F.col("id").alias("total_spend"), F.lit(1).alias("n_transactions"),
        )
        summary = rows.groupBy("value_segment").agg(
            F.avg("total_spend").alias("avg_spend"), F.avg("n_transactions").alias("avg_purchases"), F.lit(25.0).alias("revenue_share_pct")
        )
        plan = against_segment(rows, summary)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning(value_segment" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
