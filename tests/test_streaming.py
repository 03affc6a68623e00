"""Ingestion and merge under restarts, replays and crashes."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tillwise.operators import star
from tillwise.plans import batch, upkeep
from tillwise.sources import streams
from tillwise.sources.warehouse import Warehouse
from tillwise.streaming import ingest, merge, windows

AT = dt.datetime(2024, 1, 1, 12, 0, 0)


def message(customer="c1", article=1, price=2.5, day="2024-01-01", channel=1, **extra):
    return json.dumps({"t_dat": day, "customer_id": customer, "article_id": article, "price": price, "sales_channel_id": channel, **extra})


def arrive(spark, folder, texts, at=AT):
    rows = [("k", bytearray(t, "utf-8"), at) for t in texts]
    frame = spark.createDataFrame(rows, "key STRING, value BINARY, timestamp TIMESTAMP")
    frame.coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, warehouse, checkpoint):
    query = ingest.start(streams.file_messages(spark, folder), warehouse, checkpoint, interval=None)
    query.awaitTermination()


@pytest.fixture()
def folders(tmp_path):
    return str(tmp_path / "messages"), str(tmp_path / "checkpoint")


@pytest.fixture()
def star_schema(spark, warehouse):
    sales = spark.createDataFrame(
        [("c1", dt.date(2023, 12, 31), 1, 9.0, 1), ("c2", dt.date(2023, 12, 31), 2, 4.0, 2)],
        "customer_id STRING, t_dat DATE, article_id BIGINT, price DOUBLE, sales_channel_id INT",
    )
    customers = spark.createDataFrame(
        [(c, None, None, "ACTIVE", "NONE", 30.0 + i, "p") for i, c in enumerate(["c1", "c2"])],
        "customer_id STRING, FN STRING, Active STRING, club_member_status STRING, fashion_news_frequency STRING, age DOUBLE, postal_code STRING",
    )
    articles = spark.createDataFrame(
        [(i, "shirt", "Upper", "T", "D", "Red", "I", "S") for i in (1, 2)],
        "article_id BIGINT, prod_name STRING, product_group_name STRING, product_type_name STRING, department_name STRING, "
        "colour_group_name STRING, index_name STRING, section_name STRING",
    )
    batch.load_star(warehouse, sales, customers, articles)
    return warehouse


def test_restart_continues_after_the_last_batch(spark, warehouse, folders):
    folder, checkpoint = folders
    arrive(spark, folder, [message(), "{broken", message(price=None), message(more=1)])
    run(spark, folder, warehouse, checkpoint)
    arrive(spark, folder, [message("c2")])
    run(spark, folder, warehouse, checkpoint)
    rows = warehouse.read_batches(ingest.INGESTED, ingest.SALE).collect()
    assert sorted((r.batch_id, r.customer_id) for r in rows) == [(0, "c1"), (0, "c1"), (1, "c2")]
    rejected = warehouse.read_batches(ingest.REJECTED, ingest.REJECT).collect()
    assert sorted(r.raw_value == "{broken" for r in rejected) == [False, True]
    ledger = warehouse.read_batches(ingest.LEDGER, ingest.ENTRY).orderBy("batch_id").collect()
    assert [(r.n_valid, r.n_rejected) for r in ledger] == [(2, 2), (1, 0)]


def test_replayed_batch_replaces_itself(spark, warehouse):
    frame = spark.createDataFrame([(bytearray(message(), "utf-8"), AT)], "value BINARY, timestamp TIMESTAMP")
    for _ in range(3):
        ingest.write_batch(warehouse, frame, 4)
    assert warehouse.read_batches(ingest.INGESTED, ingest.SALE).count() == 1


def test_merge_keeps_equal_timestamps_and_unseen_customers(spark, star_schema, folders):
    folder, checkpoint = folders
    arrive(spark, folder, [message("c1"), message("new")])
    run(spark, folder, star_schema, checkpoint)
    assert merge.merge(star_schema) == 0
    # later rows with the very same message time
    arrive(spark, folder, [message("new2", day="2024-01-02")])
    run(spark, folder, star_schema, checkpoint)
    assert merge.merge(star_schema) == 1
    assert merge.merge(star_schema) is None
    assert merge.merged_fact(star_schema).count() == 5
    people = {r.customer_id for r in merge.merged_dim_customer(star_schema).collect()}
    assert people == {"c1", "c2", "new", "new2"}
    days = sorted(r.date_key for r in merge.merged_dim_date(star_schema).collect())
    assert days == [20231231, 20240101, 20240102]


def test_crash_before_the_control_row_is_invisible_and_repeatable(spark, star_schema, folders, monkeypatch):
    folder, checkpoint = folders
    arrive(spark, folder, [message("c1"), message("new")])
    run(spark, folder, star_schema, checkpoint)

    def crash(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(merge, "set_merged", crash)
        with pytest.raises(RuntimeError):
            merge.merge(star_schema)
    assert merge.merged_fact(star_schema).count() == 2
    assert merge.merged_dim_customer(star_schema).count() == 2
    # one more batch arrives before the repeat
    arrive(spark, folder, [message("new"), message("newer")])
    run(spark, folder, star_schema, checkpoint)
    assert merge.merge(star_schema) == 1
    assert merge.merged_fact(star_schema).count() == 6
    assert merge.merged_dim_customer(star_schema).groupBy("customer_id").count().where("count > 1").isEmpty()
    assert merge.merged_dim_customer(star_schema).count() == 4


def test_batch_without_ledger_entry_waits(spark, star_schema):
    rows = spark.createDataFrame(
        [("c1", 1, dt.date(2024, 1, 1), 1.0, 1, AT)], ingest.SALE
    )
    star_schema.write_batch(ingest.INGESTED, rows, 0)
    assert merge.merge(star_schema) is None


def test_other_pipelines_keep_their_control_rows(spark, star_schema):
    merge.ensure_control(star_schema)
    merge.set_merged(star_schema, "other", 9, AT)
    merge.set_merged(star_schema, merge.PIPELINE, 3, AT)
    rows = {r.pipeline_name: r.last_batch_id for r in star_schema.read(merge.CONTROL).collect()}
    assert rows == {"other": 9, merge.PIPELINE: 3}


def test_recompute_equals_a_full_load(spark, star_schema, folders, tmp_path):
    folder, checkpoint = folders
    arrive(spark, folder, [message("c1", 2, 7.0), message("c2", 1, 1.5, day="2024-01-05")])
    run(spark, folder, star_schema, checkpoint)
    merge.merge(star_schema)
    batch.recompute(star_schema, "2024-01-31")
    whole = Warehouse(spark, str(tmp_path / "whole"))
    fact = merge.merged_fact(star_schema)
    whole.overwrite("fact_transaction", star.with_month(fact), partition_by="month_key")
    for name in ("dim_customer", "dim_article", "dim_date"):
        whole.overwrite(name, star_schema.read(name))
    batch.recompute(whole, "2024-01-31")
    for name in batch.MARTS:
        a, b = star_schema.read(name), whole.read(name)
        assert a.count() > 0
        assert a.exceptAll(b.select(a.columns)).isEmpty() and b.exceptAll(a.select(b.columns)).isEmpty()


def test_unknown_member_is_no_customer(spark, warehouse):
    sales = spark.createDataFrame(
        [(None, dt.date(2024, 1, 1), 1, 9.0, 1), ("c1", dt.date(2024, 1, 1), 1, 4.0, 2)],
        "customer_id STRING, t_dat DATE, article_id BIGINT, price DOUBLE, sales_channel_id INT",
    )
    keys = {r.customer_key for r in star.fact_transaction(sales).collect()}
    assert -1 in keys and len(keys) == 2


def test_processing_time_trigger_and_wait(spark, warehouse, folders):
    folder, checkpoint = folders
    arrive(spark, folder, [message()])
    spark.streams.resetTerminated()
    query = ingest.start(streams.file_messages(spark, folder), warehouse, checkpoint, interval="1 second")
    try:
        query.processAllAvailable()
        assert ingest.run_until_any_stops(spark, 1) in (False, None)
    finally:
        query.stop()
    assert warehouse.read_batches(ingest.INGESTED, ingest.SALE).count() == 1


def test_messages_round_trip(spark):
    from tillwise.streaming.messages import parse_messages

    sales = spark.createDataFrame(
        [("2024-01-01", "c", 1, 2.5, 1)], "t_dat STRING, customer_id STRING, article_id BIGINT, price DOUBLE, sales_channel_id INT"
    )
    encoded = streams.encode_messages(sales).withColumn("timestamp", F.lit(AT))
    row = parse_messages(encoded).first()
    assert (row.t_dat, row.customer_id, row.article_id, row.price, row.sales_channel_id) == ("2024-01-01", "c", 1, 2.5, 1)


def test_reload_replaces_what_was_merged_before(spark, star_schema, folders):
    folder, checkpoint = folders
    arrive(spark, folder, [message("c1"), message("new")])
    run(spark, folder, star_schema, checkpoint)
    merge.merge(star_schema)
    assert merge.merged_fact(star_schema).count() == 4
    # the next files hold the streamed sales and the new customer
    sales = spark.createDataFrame(
        [("c1", dt.date(2023, 12, 31), 1, 9.0, 1), ("c1", dt.date(2024, 1, 1), 1, 2.5, 1), ("new", dt.date(2024, 1, 1), 1, 2.5, 1)],
        "customer_id STRING, t_dat DATE, article_id BIGINT, price DOUBLE, sales_channel_id INT",
    )
    customers = spark.createDataFrame(
        [(c, None, None, "ACTIVE", "NONE", 30.0, "p") for c in ("c1", "new")],
        "customer_id STRING, FN STRING, Active STRING, club_member_status STRING, fashion_news_frequency STRING, age DOUBLE, postal_code STRING",
    )
    articles = star_schema.read("dim_article").withColumns({c: F.lit("x") for c in ("colour_group_name", "section_name")})
    batch.load_star(star_schema, sales, customers, articles)
    assert merge.merged_fact(star_schema).count() == 3
    assert sorted(r.customer_id for r in merge.merged_dim_customer(star_schema).collect()) == ["c1", "new"]
    # later batches come on top
    arrive(spark, folder, [message("c1"), message("newer", day="2024-01-03")])
    run(spark, folder, star_schema, checkpoint)
    merge.merge(star_schema)
    assert merge.merged_fact(star_schema).count() == 5
    assert sorted(r.customer_id for r in merge.merged_dim_customer(star_schema).collect()) == ["c1", "new", "newer"]
    # files without the streamed sales keep them beside the new fact
    batch.load_star(star_schema, sales, customers, articles, keep_merged=True)
    assert merge.merged_fact(star_schema).count() == 5


def test_compaction_changes_no_row(spark, star_schema, folders):
    folder, checkpoint = folders

    def contents():
        tables = (merge.merged_fact(star_schema), merge.merged_dim_date(star_schema), merge.merged_dim_customer(star_schema))
        return [sorted(map(str, t.select(sorted(t.columns)).collect())) for t in tables]

    for customer in ("c1", "new"):
        arrive(spark, folder, [message(customer, day="2024-01-02")])
        run(spark, folder, star_schema, checkpoint)
        merge.merge(star_schema)
    before = contents()
    assert merge.compact(star_schema) == 1
    assert contents() == before
    assert star_schema.read("fact_transaction").count() == 4 and star_schema.holds_upto("fact_transaction") == 1
    arrive(spark, folder, [message("c2")])
    run(spark, folder, star_schema, checkpoint)
    merge.merge(star_schema)
    assert merge.merged_fact(star_schema).count() == 5


def test_crash_inside_compaction_is_invisible(spark, star_schema, folders, monkeypatch):
    folder, checkpoint = folders
    arrive(spark, folder, [message("new", day="2024-01-02")])
    run(spark, folder, star_schema, checkpoint)
    merge.merge(star_schema)

    def crash(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(star, "with_month", crash)
        with pytest.raises(RuntimeError):
            merge.compact(star_schema)
    assert merge.merged_fact(star_schema).count() == 3
    assert merge.merged_dim_customer(star_schema).count() == 3
    assert merge.merged_dim_date(star_schema).count() == 2


def test_streamed_prices_keep_all_digits(spark, star_schema, folders):
    folder, checkpoint = folders
    fact = star_schema.read("fact_transaction").withColumn("price", F.col("price").cast("decimal(18,2)"))
    star_schema.overwrite("fact_transaction", fact, partition_by="month_key")
    arrive(spark, folder, [message("c1", price=0.0508)])
    run(spark, folder, star_schema, checkpoint)
    merge.merge(star_schema)
    assert 0.0508 in {float(r.price) for r in merge.merged_fact(star_schema).collect()}


def test_broken_version_log_is_an_error(spark, warehouse, tmp_path):
    """A log that can't be read isn't the same as no table: the merge must not start anew."""
    merge.ensure_control(warehouse)
    log = tmp_path / "warehouse" / merge.CONTROL / "versions"
    for checksum in log.glob(".*.crc"):
        checksum.write_bytes(b"")
    for part in log.glob("*.json"):
        part.write_text("{broken\n")
    with pytest.raises(Exception):
        merge.last_merged(warehouse)


def hours(n):
    return AT + dt.timedelta(hours=n)


def window_run(spark, folders, warehouse, shape, name, lateness="2 hours"):
    folder, checkpoint = folders
    windows.start(streams.file_messages(spark, folder), shape, warehouse, name, checkpoint, lateness, interval=None).awaitTermination()


def hourly(sales):
    return windows.windowed(sales, windows.tumbling("1 hour"), "customer_id")


COUNTS = "begins TIMESTAMP, ends TIMESTAMP, customer_id STRING, n_sales BIGINT, revenue DECIMAL(28,2)"


def test_windows_stay_open_over_a_restart_and_drop_what_is_late(spark, warehouse, folders):
    read = lambda: sorted((r.begins.hour, r.customer_id, r.n_sales, float(r.revenue)) for r in warehouse.read_batches(windows.WINDOWS, COUNTS).collect())
    arrive(spark, folders[0], [message(price=1.5), message("c2")], hours(0))
    window_run(spark, folders, warehouse, hourly, windows.WINDOWS)
    assert read() == []  # nothing is final before the watermark
    arrive(spark, folders[0], [message(price=2.0)], hours(0.5))  # the same window, by another run
    arrive(spark, folders[0], [message("c3"), message(price=-1.0)], hours(3.5))
    window_run(spark, folders, warehouse, hourly, windows.WINDOWS)
    assert read() == [(12, "c1", 2, 3.5), (12, "c2", 1, 2.5)]
    arrive(spark, folders[0], [message("late")], hours(0.25))  # its window is final
    arrive(spark, folders[0], [message("c4")], hours(2))  # late, but waited for
    window_run(spark, folders, warehouse, hourly, windows.WINDOWS)
    arrive(spark, folders[0], [message("c5")], hours(12))
    window_run(spark, folders, warehouse, hourly, windows.WINDOWS)
    assert read() == [(12, "c1", 2, 3.5), (12, "c2", 1, 2.5), (14, "c4", 1, 2.5), (15, "c3", 1, 2.5)]


def test_sessions_close_after_a_gap(spark, warehouse, folders):
    shape = lambda sales: windows.windowed(sales, windows.sessions("1 hour"), "customer_id")
    for at in (0, 0.9, 1.8, 4, 9):
        arrive(spark, folders[0], [message()], hours(at))
    window_run(spark, folders, warehouse, shape, windows.WINDOWS)
    rows = warehouse.read_batches(windows.WINDOWS, COUNTS).orderBy("begins").collect()
    assert [(r.begins, r.n_sales) for r in rows] == [(hours(0), 3), (hours(4), 1)]  # the last one may go on


def test_a_sale_is_taken_once_within_the_watermark(spark, warehouse, folders):
    count = lambda: warehouse.read_batches(windows.ONCE, ingest.SALE).count()
    arrive(spark, folders[0], [message(), message(), message("c2")], hours(0))
    window_run(spark, folders, warehouse, windows.taken_once, windows.ONCE)
    assert count() == 2
    arrive(spark, folders[0], [message(), message("c2")], hours(0))  # the file again, in a run of its own
    window_run(spark, folders, warehouse, windows.taken_once, windows.ONCE)
    assert count() == 2
    arrive(spark, folders[0], [message("c3")], hours(10))  # moves the watermark beyond both
    window_run(spark, folders, warehouse, windows.taken_once, windows.ONCE)
    arrive(spark, folders[0], [message()], hours(0))  # too late to be told apart
    arrive(spark, folders[0], [message()], hours(11))  # sent anew, and forgotten by then
    window_run(spark, folders, warehouse, windows.taken_once, windows.ONCE)
    assert count() == 4


MARTS = ("customers_features_train", "products_performance", "daily_sales", "customer_segments_summary")


def marts_of(warehouse):
    return {name: sorted(map(str, (r.asDict() for r in warehouse.read(name).collect()))) for name in MARTS}


def full_marts(spark, warehouse, as_of="2024-01-31"):
    """The marts after the sums have been forgotten and built anew from all sales."""
    warehouse.overwrite(upkeep.CONTROL, spark.createDataFrame([("none", -1)], "source STRING, upto BIGINT"))
    assert batch.recompute(warehouse, as_of) == "built"
    return marts_of(warehouse)


def test_marts_from_kept_sums_equal_a_full_recompute(spark, star_schema, folders, monkeypatch):
    folder, checkpoint = folders
    assert batch.recompute(star_schema, "2024-01-31") == "built"
    read = []
    increments = upkeep.fact_increments
    monkeypatch.setattr(upkeep, "fact_increments", lambda *a: (df := increments(*a), read.append({r[0] for r in df.select(F.input_file_name()).distinct().collect()}))[0])
    for i in range(3):
        arrive(spark, folder, [message("c1", price=1.0 + i), message(f"new{i}", article=2), message("c2", day=f"2022-0{i + 1}-01")])
        run(spark, folder, star_schema, checkpoint)
        merge.merge(star_schema)
        assert batch.recompute(star_schema, "2024-01-31") == "added"
        # a merge reads its own batch, however many came before
        assert all(f"batch_id={i}/" in f for f in read[-1]) and len(read) == i + 1
        assert batch.recompute(star_schema, "2024-01-31") == "kept"
    kept = marts_of(star_schema)
    assert kept == full_marts(spark, star_schema)


def test_sums_are_folded_and_survive_compaction(spark, star_schema, folders):
    folder, checkpoint = folders
    batch.recompute(star_schema, "2024-01-31")
    for i, done in enumerate(["added", "folded", "added"]):
        arrive(spark, folder, [message("c1"), message(f"n{i}")])
        run(spark, folder, star_schema, checkpoint)
        merge.merge(star_schema)
        assert upkeep.upkeep(star_schema, fold=2) == done
    assert batch.compact(star_schema) == 2
    assert batch.recompute(star_schema, "2024-01-31") == "kept"
    kept = marts_of(star_schema)
    assert kept == full_marts(spark, star_schema)


def test_a_late_load_rebuilds_the_sums(spark, star_schema, folders):
    folder, checkpoint = folders
    batch.recompute(star_schema, "2024-01-31")
    arrive(spark, folder, [message("c1")])
    run(spark, folder, star_schema, checkpoint)
    merge.merge(star_schema)
    batch.recompute(star_schema, "2024-01-31")
    corrected = spark.createDataFrame(
        [("c1", dt.date(2023, 12, 31), 1, 19.0, 1)], "customer_id STRING, t_dat DATE, article_id BIGINT, price DOUBLE, sales_channel_id INT"
    )
    star_schema.overwrite(merge.FACT, star.with_month(star.fact_transaction(corrected)), partition_by="month_key")
    assert batch.recompute(star_schema, "2024-01-31") == "built"
    row = star_schema.read("customers_features_train").first()
    assert (row.total_spend, row.n_transactions) == (21.5, 2)


def test_an_upkeep_that_dies_leaves_no_trace(spark, star_schema, folders, monkeypatch):
    folder, checkpoint = folders
    batch.recompute(star_schema, "2024-01-31")
    arrive(spark, folder, [message("c1")])
    run(spark, folder, star_schema, checkpoint)
    merge.merge(star_schema)
    with monkeypatch.context() as broken:
        broken.setattr(upkeep, "_record", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            upkeep.upkeep(star_schema)
    arrive(spark, folder, [message("c2")])
    run(spark, folder, star_schema, checkpoint)
    merge.merge(star_schema)
    assert batch.recompute(star_schema, "2024-01-31") == "added"
    kept = marts_of(star_schema)
    assert kept == full_marts(spark, star_schema)


def test_another_pipeline_reads_what_it_merged(spark, star_schema, folders):
    folder, checkpoint = folders
    arrive(spark, folder, [message("c1"), message("n")])
    run(spark, folder, star_schema, checkpoint)
    assert merge.merge(star_schema, "hourly") == 0
    assert merge.merged_fact(star_schema).count() == 2
    assert merge.merged_fact(star_schema, "hourly").count() == 4
    assert merge.merged_dim_customer(star_schema, "hourly").count() == 3
    assert batch.compact(star_schema, "hourly") == 0 and star_schema.read(merge.FACT).count() == 4


def test_late_batches_list_their_own_blocks(spark, warehouse):
    frame = spark.createDataFrame([(1,)], "x INT")
    for number in (0, 1, 127, 128, 300):
        warehouse.write_batch("grown", frame, number)
    assert [b.batch_id for b in warehouse.read_batches("grown", "x INT", after=127).orderBy("batch_id").collect()] == [128, 300]
    assert all("block=2/" in f for f in warehouse.read_batches("grown", "x INT", after=255).inputFiles())  # all that is listed
    assert warehouse.read_batches("grown", "x INT", upto=126).count() == 2
    assert warehouse.read_batches("never", "x INT").count() == 0
