"""Streaming ingestion, merge and recompute over messages that arrive in three parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise.catalog.base import query, view
from tillwise.catalog.cleaning import VALID

from tillwise.plans import batch
from tillwise.session import new_path

from tillwise.sources.streams import file_messages
from tillwise.sources.warehouse import Warehouse
from tillwise.streaming import ingest, merge, messages, windows

# the first and the last part have no outer end
PARTS = [("0001-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "9999-12-31")]

view(
    "goodev",
    f"""SELECT event_id, CASE WHEN event_id % 43 = 0 THEN user_id + 1000000 ELSE user_id END AS user_id, event_id % 2000 AS article_id,
  CAST(ts AS DATE) AS t_dat, value AS price, CASE event_type WHEN 'click' THEN 1 ELSE 2 END AS sales_channel_id, ts
  FROM events WHERE {VALID}""",
)


class _Stream:
    """Arriving files, and one ingestion run for each arrival, all from one checkpoint."""

    def __init__(self, t, warehouse: Warehouse):
        self.t, self.warehouse = t, warehouse
        self.folder, self.checkpoint = new_path(t.spark, "messages"), new_path(t.spark, "checkpoint")

    def arrive(self, part: tuple[str, str]) -> None:
        inside = (F.col("timestamp") >= part[0]) & (F.col("timestamp") < part[1])
        self.t.raw_messages.where(inside).write.mode("append").parquet(self.folder)
        run = ingest.start(
            file_messages(self.t.spark, self.folder), self.warehouse, self.checkpoint, interval=None
        )
        run.awaitTermination()

    def arrive_all(self) -> None:
        for part in PARTS:
            self.arrive(part)


def _ingested(t) -> Warehouse:
    warehouse = Warehouse(t.spark, new_path(t.spark, "stream"))
    _Stream(t, warehouse).arrive_all()
    return warehouse


@query(
    "st02_parse_messages",
    """SELECT CASE WHEN event_id % 31 = 0 OR event_id % 29 = 0 THEN NULL ELSE CAST(CASE WHEN event_id % 43 = 0 THEN user_id + 1000000 ELSE user_id END AS VARCHAR) END AS customer_id,
  COUNT(*) AS n, COUNT(*) FILTER (event_id % 31 <> 0) AS n_parsed FROM events GROUP BY 1""",
)
def st02(t):
    parsed = messages.parse_messages(t.raw_messages)
    return parsed.groupBy("customer_id").agg(
        F.count("*").alias("n"), F.count("article_id").alias("n_parsed")
    )


@query(
    "st01_s10_ingested",
    """SELECT CAST(user_id AS VARCHAR) AS customer_id, article_id, CAST(t_dat AS VARCHAR) AS t_dat, price,
  CAST(sales_channel_id AS BIGINT) AS sales_channel_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS arrived,
  CAST(CASE WHEN ts < '2024-01-11' THEN 0 WHEN ts < '2024-01-21' THEN 1 ELSE 2 END AS BIGINT) AS batch_id FROM goodev""",
)
def st01(t):
    rows = _ingested(t).read_batches(ingest.INGESTED, ingest.SALE)
    return rows.withColumn("arrived", F.date_format("kafka_timestamp", "yyyy-MM-dd HH:mm:ss")).drop("kafka_timestamp")


@query(
    "st03_rejected",
    f"""SELECT CAST(CASE WHEN ts < '2024-01-11' THEN 0 WHEN ts < '2024-01-21' THEN 1 ELSE 2 END AS BIGINT) AS batch_id,
  COUNT(*) AS n, COUNT(*) FILTER (event_id % 31 = 0) AS n_unreadable FROM events WHERE NOT {VALID} GROUP BY 1""",
)
def st03(t):
    rows = _ingested(t).read_batches(ingest.REJECTED, ingest.REJECT)
    unreadable = F.array_contains("rejection_reason", "article_id_missing")
    return rows.groupBy("batch_id").agg(F.count("*").alias("n"), F.count_if(unreadable).alias("n_unreadable"))


@query(
    "st04_interval_trigger",
    f"SELECT COUNT(*) FILTER ({VALID}) AS n_valid, COUNT(*) FILTER (NOT {VALID}) AS n_rejected FROM events",
)
def st04(t):
    """A stream on a processing-time trigger, stopped when it has taken all files."""
    warehouse = Warehouse(t.spark, new_path(t.spark, "stream"))
    folder, checkpoint = new_path(t.spark, "messages"), new_path(t.spark, "checkpoint")
    t.raw_messages.write.parquet(folder)
    running = ingest.start(file_messages(t.spark, folder), warehouse, checkpoint, interval="1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    ledger = warehouse.read_batches(ingest.LEDGER, ingest.ENTRY)
    return ledger.agg(F.sum("n_valid").alias("n_valid"), F.sum("n_rejected").alias("n_rejected"))


@query(
    "st05_restart_ledger",
    f"""SELECT CAST(CASE WHEN ts < '2024-01-11' THEN 0 WHEN ts < '2024-01-21' THEN 1 ELSE 2 END AS BIGINT) AS batch_id,
  COUNT(*) FILTER ({VALID}) AS n_valid, COUNT(*) FILTER (NOT {VALID}) AS n_rejected, strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS last_timestamp
  FROM events GROUP BY 1""",
)
def st05(t):
    """The ledger after three runs that each continued from the same checkpoint."""
    ledger = _ingested(t).read_batches(ingest.LEDGER, ingest.ENTRY)
    return ledger.withColumn("last_timestamp", F.date_format("last_timestamp", "yyyy-MM-dd HH:mm:ss"))


@query("st07_replayed_batch", "SELECT COUNT(*) AS n, ROUND(SUM(price), 2) AS spend FROM goodev")
def st07(t):
    """The same micro-batch written twice, as after a failure before its commit."""
    warehouse = Warehouse(t.spark, new_path(t.spark, "stream"))
    for _ in range(2):
        ingest.write_batch(warehouse, t.raw_messages, 0)
    rows = warehouse.read_batches(ingest.INGESTED, ingest.SALE)
    return rows.agg(F.count("*").alias("n"), F.round(F.sum(F.col("price").cast("decimal(18,2)")), 2).alias("spend"))


@query(
    "st08_control_table",
    """SELECT 'stream_to_warehouse' AS pipeline_name, CAST(2 AS BIGINT) AS last_batch_id,
  strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS last_merged_at FROM events UNION ALL SELECT 'other', 7, '2024-01-01 00:00:00'""",
)
def st08(t):
    """Control rows after a merge: the own row moved, the row of another pipeline is still there."""
    warehouse = _merged(t)
    rows = warehouse.read(merge.CONTROL)
    return rows.withColumn("last_merged_at", F.date_format("last_merged_at", "yyyy-MM-dd HH:mm:ss"))


def _merged(t) -> Warehouse:
    """Star schema, then arrive, merge, arrive twice, merge, and a merge with nothing new."""
    warehouse = Warehouse(t.spark, new_path(t.spark, "warehouse"))
    batch.load_star(warehouse, t.sales, t.customers, t.articles)
    merge.ensure_control(warehouse)
    other = t.spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00' AS at").first().at
    merge.set_merged(warehouse, "other", 7, other)
    stream = _Stream(t, warehouse)
    stream.arrive(PARTS[0])
    merge.merge(warehouse)
    stream.arrive(PARTS[1])
    stream.arrive(PARTS[2])
    merge.merge(warehouse)
    if merge.merge(warehouse) is not None:
        raise AssertionError("a merge without new batches must do nothing")
    return warehouse


@query(
    "st09_merged_fact",
    """SELECT date_key, COUNT(*) AS n, SUM(price)::DOUBLE AS revenue, COUNT(DISTINCT c) AS n_customers FROM (
  SELECT CAST(strftime(t_dat, '%Y%m%d') AS BIGINT) AS date_key, price, customer_id AS c FROM tx UNION ALL
  SELECT CAST(strftime(t_dat, '%Y%m%d') AS BIGINT), CAST(price AS DECIMAL(18,2)), CAST(user_id AS VARCHAR) FROM goodev) GROUP BY 1""",
)
def st09(t):
    fact = merge.merged_fact(_merged(t))
    return fact.groupBy("date_key").agg(
        F.count("*").alias("n"), F.sum("price").alias("revenue"), F.countDistinct("customer_key").alias("n_customers")
    )


@query(
    "st09_merged_dimensions",
    """SELECT (SELECT COUNT(DISTINCT d) FROM (SELECT t_dat AS d FROM tx UNION SELECT t_dat FROM goodev)) AS n_days,
  (SELECT COUNT(DISTINCT c) FROM (SELECT customer_id AS c FROM cust UNION SELECT CAST(user_id AS VARCHAR) FROM goodev)) AS n_customers""",
)
def st09_dimensions(t):
    warehouse = _merged(t)
    people = merge.merged_dim_customer(warehouse)
    return merge.merged_dim_date(warehouse).agg(F.count("date_key").alias("n_days")).withColumn(
        "n_customers", people.agg(F.count("customer_key")).scalar()
    )


@query(
    "st10_no_op",
    "SELECT COUNT(*) AS n, CAST(2 AS BIGINT) AS last_batch_id FROM (SELECT article_id FROM tx UNION ALL SELECT article_id FROM goodev)",
)
def st10(t):
    warehouse = _merged(t)
    before = merge.last_merged(warehouse)[1]
    return merge.merged_fact(warehouse).agg(F.count("*").alias("n")).withColumn("last_batch_id", F.lit(before))


_RECOMPUTED = """SELECT c AS customer_id, COUNT(*) AS n_transactions, SUM(price)::DOUBLE AS total_spend, COUNT(DISTINCT product_group_name) AS n_distinct_categories,
  CAST(datediff('day', MIN(d), MAX(d)) AS BIGINT) AS tenure_days FROM (
  SELECT customer_id AS c, article_id, t_dat AS d, price FROM tx UNION ALL
  SELECT CAST(user_id AS VARCHAR), article_id, t_dat, CAST(price AS DECIMAL(18,2)) FROM goodev) LEFT JOIN art USING (article_id) GROUP BY 1"""


def _customer_marts(warehouse: Warehouse):
    people = merge.merged_dim_customer(warehouse).select("customer_key", "customer_id")
    return (
        warehouse.read("customers_features_train")
        .join(people, "customer_key")
        .select("customer_id", "n_transactions", "total_spend", "n_distinct_categories", "tenure_days")
    )


@query("st11_recompute", _RECOMPUTED)
def st11(t):
    warehouse = _merged(t)
    batch.recompute(warehouse, "2024-01-31")
    return _customer_marts(warehouse)


@query("st11_kept_sums", _RECOMPUTED)
def st11_kept(t):
    """The marts after two merges whose batches alone were added to the sums of the load."""
    warehouse = Warehouse(t.spark, new_path(t.spark, "warehouse"))
    batch.load(warehouse, t.sales, t.customers, t.articles, "2024-01-31")
    stream = _Stream(t, warehouse)
    for parts in (PARTS[:1], PARTS[1:]):
        for part in parts:
            stream.arrive(part)
        merge.merge(warehouse)
        if batch.recompute(warehouse, "2024-01-31") != "added":
            raise AssertionError("a merge must not read sales of earlier batches")
    return _customer_marts(warehouse)


# Arrivals of the window queries: messages of one second in seven come later than their time, of the first days far
# too late, of the day before the first cut within the two days that are waited for.
_LATE = "CAST(date_part('second', {ts}) AS INT) % 7 = 0"
_ARRIVAL = f"""CASE WHEN {_LATE} AND {{ts}} < TIMESTAMP '2024-01-06' THEN 2
  WHEN {_LATE} AND {{ts}} >= TIMESTAMP '2024-01-10' AND {{ts}} < TIMESTAMP '2024-01-11' THEN 1
  WHEN {{ts}} < TIMESTAMP '2024-01-11' THEN 0 WHEN {{ts}} < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END"""
_LATENESS = "2 days"

view("arriv", f"SELECT *, {_ARRIVAL.format(ts='ts')} AS arrival FROM goodev")
# the watermark in milliseconds while an arrival is read, and after the last
view(
    "marks",
    """SELECT a.arrival, coalesce((SELECT CAST(floor(epoch_us(MAX(ts)) / 1000) AS BIGINT) FROM arriv b WHERE b.arrival < a.arrival)
  - 2 * 86400000, 0) AS mark FROM (VALUES (0), (1), (2), (3)) a(arrival)""",
)


def _arrive_late(t, shape, name: str) -> Warehouse:
    """Three arrivals, each read by a run of its own that goes on from the checkpoint of the last."""
    warehouse = Warehouse(t.spark, new_path(t.spark, "stream"))
    folder, checkpoint = new_path(t.spark, "messages"), new_path(t.spark, "checkpoint")
    sent = t.raw_messages.withColumn("arrival", F.expr(_ARRIVAL.format(ts="timestamp")))
    for arrival in range(3):
        sent.where(F.col("arrival") == arrival).drop("arrival").write.mode("append").parquet(folder)
        messages_ = file_messages(t.spark, folder)
        windows.start(messages_, shape, warehouse, name, checkpoint, _LATENESS, interval=None).awaitTermination()
    return warehouse


def _spans(warehouse: Warehouse, keys: str):
    rows = warehouse.read_batches(windows.WINDOWS, f"begins TIMESTAMP, ends TIMESTAMP, {keys}, n_sales BIGINT, revenue DECIMAL(28,2)")
    stamps = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("begins", "ends")}
    return rows.withColumns(stamps).drop("batch_id")


def _window_check(spans: str, keys: str) -> str:
    """Windows in milliseconds from ``spans`` (columns a, b); late rows out, windows that are not final out."""
    stamp = "strftime(make_timestamp({} * 1000), '%Y-%m-%d %H:%M:%S.%f')"
    return f"""SELECT {stamp.format('a')} AS begins, {stamp.format('b')} AS ends, {keys}, COUNT(*) AS n_sales,
  SUM(CAST(price AS DECIMAL(18,2)))::DOUBLE AS revenue FROM ({spans}) s JOIN marks USING (arrival)
  WHERE b > mark AND b <= (SELECT mark FROM marks WHERE arrival = 3) GROUP BY ALL"""


@query(
    "x1_tumbling_windows",
    _window_check(
        "SELECT *, epoch_ms(ts) // 86400000 * 86400000 AS a, a + 86400000 AS b FROM arriv",
        "CAST(sales_channel_id AS BIGINT) AS sales_channel_id",
    ),
)
def x1_tumbling(t):
    """Sales a day and channel, of days that are final two days after the last message."""
    shape = lambda sales: windows.windowed(sales, windows.tumbling("1 day"), "sales_channel_id")
    return _spans(_arrive_late(t, shape, windows.WINDOWS), "sales_channel_id INT")


@query(
    "x1_sliding_windows",
    _window_check(
        """SELECT *, epoch_ms(ts) // 21600000 * 21600000 - 21600000 * i AS a, a + 86400000 AS b
  FROM arriv, (VALUES (0), (1), (2), (3)) o(i)""",
        "CAST(sales_channel_id AS BIGINT) AS sales_channel_id",
    ),
)
def x1_sliding(t):
    """Sales of a day's length, from every sixth hour on."""
    shape = lambda sales: windows.windowed(sales, windows.sliding("1 day", "6 hours"), "sales_channel_id")
    return _spans(_arrive_late(t, shape, windows.WINDOWS), "sales_channel_id INT")


@query(
    "x1_session_windows",
    """SELECT strftime(MIN(ts), '%Y-%m-%d %H:%M:%S.%f') AS begins, strftime(MAX(ts) + INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS ends,
  CAST(user_id AS VARCHAR) AS customer_id, COUNT(*) AS n_sales, SUM(CAST(price AS DECIMAL(18,2)))::DOUBLE AS revenue FROM (
  SELECT *, SUM(CASE WHEN ts <= before THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS visit FROM (
    SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 3 HOUR AS before
    FROM arriv JOIN marks USING (arrival) WHERE epoch_us(ts) + 3 * 3600000000 > mark * 1000))
  GROUP BY user_id, visit HAVING epoch_us(MAX(ts)) + 3 * 3600000000 <= (SELECT mark FROM marks WHERE arrival = 3) * 1000""",
)
def x1_sessions(t):
    """Visits of a customer: sales with less than three hours between two."""
    shape = lambda sales: windows.windowed(sales, windows.sessions("3 hours"), "customer_id")
    return _spans(_arrive_late(t, shape, windows.WINDOWS), "customer_id STRING")


@query(
    "x2_taken_once",
    """SELECT CAST(user_id AS VARCHAR) AS customer_id, article_id, CAST(t_dat AS VARCHAR) AS t_dat, price, COUNT(*) AS n FROM (
  SELECT user_id, article_id, t_dat, price FROM goodev UNION ALL
  SELECT user_id, article_id, t_dat, price FROM goodev WHERE ts < TIMESTAMP '2024-01-06') GROUP BY ALL""",
)
def x2(t):
    """Files of three parts, the last days of each delivered again with the next; and the first days sent anew, long after.

    What is delivered again is known still, or too old. What is sent anew has been forgotten, and is taken again.
    """
    warehouse = Warehouse(t.spark, new_path(t.spark, "stream"))
    folder, checkpoint = new_path(t.spark, "messages"), new_path(t.spark, "checkpoint")
    at = F.col("timestamp")
    again = t.raw_messages.where(at < F.lit("2024-01-06").cast("timestamp"))
    for i, (begin, end) in enumerate(PARTS):
        part = t.raw_messages.where((at >= begin) & (at < end))
        if i:
            repeated = t.raw_messages.where((at >= F.lit(begin).cast("timestamp") - F.expr("INTERVAL 3 DAYS")) & (at < begin))
            part = part.unionByName(repeated)
        if i == 2:
            part = part.unionByName(again.withColumn("timestamp", at + F.expr("INTERVAL 20 DAYS")))
        part.write.mode("append").parquet(folder)
        messages_ = file_messages(t.spark, folder)
        windows.start(messages_, windows.taken_once, warehouse, windows.ONCE, checkpoint, _LATENESS, interval=None).awaitTermination()
    rows = warehouse.read_batches(windows.ONCE, ingest.SALE)
    return rows.groupBy("customer_id", "article_id", "t_dat", "price").agg(F.count("*").alias("n"))
