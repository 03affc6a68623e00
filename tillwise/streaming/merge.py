"""Incremental merge of ingested batches into the warehouse.

Progress is counted in batches of the ingestion, not in message times: every batch is whole
and never changes once it is in the ledger, so equal or late message times cannot be missed.
The merged rows are stored per batch and replaced on a repeat. Readers take only batches up
to the control row, which is written last; a merge that dies half-way is invisible, and the
next one overwrites what it left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DecimalType

from tillwise import model
from tillwise.functions.columns import date_key, surrogate_key
from tillwise.operators import cleaning, star
from tillwise.sources.warehouse import Warehouse
from tillwise.streaming.ingest import ENTRY, INGESTED, LEDGER, SALE

PIPELINE = "stream_to_warehouse"
CONTROL = "merge_watermark"
FACT, DIM_DATE, DIM_CUSTOMER = "fact_transaction", "dim_date", "dim_customer"
FACT_COLUMNS = "customer_key BIGINT, article_key BIGINT, date_key INT, price DOUBLE, sales_channel_id INT"
DATE_COLUMNS = "date DATE, date_key INT, month INT, year INT"
CUSTOMER_COLUMNS = "customer_id STRING, customer_key BIGINT"
# Loaded prices may be decimals, streamed ones are doubles: 18 digits behind the point keep both.
WIDE = "decimal(38,18)"


def ensure_control(warehouse: Warehouse) -> None:
    if not warehouse.exists(CONTROL):
        warehouse.overwrite(CONTROL, warehouse.spark.createDataFrame([], model.CONTROL))


def last_merged(warehouse: Warehouse, pipeline: str = PIPELINE) -> tuple:
    """(message time, batch) up to which ``pipeline`` has merged; the epoch and -1 at first."""
    ensure_control(warehouse)
    row = warehouse.read(CONTROL).where(F.col("pipeline_name") == pipeline).first()
    return (row.last_merged_at, row.last_batch_id) if row else ("1970-01-01 00:00:00", -1)


def set_merged(warehouse: Warehouse, pipeline: str, batch_id: int, last_timestamp) -> None:
    """Replace the row of one pipeline and keep the others."""
    spark = warehouse.spark
    others = warehouse.read(CONTROL).where(F.col("pipeline_name") != pipeline)
    mine = spark.createDataFrame([(pipeline, last_timestamp, batch_id)], model.CONTROL)
    warehouse.overwrite(CONTROL, others.unionByName(mine).coalesce(1))


def _merged_batches(warehouse: Warehouse, name: str, schema: str, pipeline: str) -> DataFrame:
    upto = last_merged(warehouse, pipeline)[1]
    return warehouse.read_batches(name, schema, after=warehouse.holds_upto(FACT), upto=upto).drop("batch_id")


def common_price(warehouse: Warehouse, rows: DataFrame) -> DataFrame:
    """Sales with prices in a type that holds loaded and streamed ones exactly."""
    loaded = warehouse.read(FACT).schema["price"].dataType
    return rows.withColumn("price", F.col("price").cast(WIDE)) if isinstance(loaded, DecimalType) else rows


def fact_increments(warehouse: Warehouse, after: int, upto: int) -> DataFrame:
    """Merged sales of the batches in (after, upto], with their batch; no other batch is read."""
    return common_price(warehouse, warehouse.read_batches(f"{FACT}_increment", FACT_COLUMNS, after=after, upto=upto))


def merged_fact(warehouse: Warehouse, pipeline: str = PIPELINE) -> DataFrame:
    """Loaded fact and the increments that ``pipeline`` merged since."""
    loaded = common_price(warehouse, warehouse.read(FACT).drop("month_key"))
    added = common_price(warehouse, _merged_batches(warehouse, f"{FACT}_increment", FACT_COLUMNS, pipeline))
    return cleaning.union_all(loaded, added)


def compact(warehouse: Warehouse, pipeline: str = PIPELINE) -> int:
    """Write fact, days and customers anew with all merged increments inside; the last batch in them.

    The version of the fact records that batch, so its increments are not added again. Days and
    customers go first: a row that is in both a table and an increment counts once. A job for
    quiet hours: it rewrites the fact.
    """
    upto = last_merged(warehouse, pipeline)[1]
    warehouse.overwrite(DIM_CUSTOMER, merged_dim_customer(warehouse, pipeline))
    warehouse.overwrite(DIM_DATE, merged_dim_date(warehouse, pipeline))
    whole = star.with_month(merged_fact(warehouse, pipeline))
    warehouse.overwrite(FACT, whole, partition_by="month_key", holds_upto=upto)
    return upto


def merged_dim_date(warehouse: Warehouse, pipeline: str = PIPELINE) -> DataFrame:
    loaded = warehouse.read(DIM_DATE)
    added = _merged_batches(warehouse, f"{DIM_DATE}_increment", DATE_COLUMNS, pipeline)
    return loaded.unionByName(added.join(loaded.select("date_key"), "date_key", "left_anti"))


def merged_dim_customer(warehouse: Warehouse, pipeline: str = PIPELINE) -> DataFrame:
    """Loaded customers, and the ids first met in the stream, with unknown attributes.

    An id that a later load brings takes the place of the one met in the stream.
    """
    loaded = warehouse.read(DIM_CUSTOMER)
    added = _merged_batches(warehouse, f"{DIM_CUSTOMER}_increment", CUSTOMER_COLUMNS, pipeline)
    return loaded.unionByName(added.join(loaded.select("customer_id"), "customer_id", "left_anti"), allowMissingColumns=True)


def merge(warehouse: Warehouse, pipeline: str = PIPELINE) -> int | None:
    """Merge all batches that are newer than the control row; None if there is none.

    Returns the last merged batch. The upper bound is fixed before anything is read.
    """
    before, after = last_merged(warehouse, pipeline)
    news = warehouse.read_batches(LEDGER, ENTRY, after=after)
    bound = news.agg(F.max("batch_id").alias("b"), F.max("last_timestamp").alias("t")).first()
    if bound.b is None:
        return None

    rows = warehouse.read_batches(INGESTED, SALE, after=after, upto=bound.b)
    facts = rows.select(
        surrogate_key(F.col("customer_id")).alias("customer_key"),
        F.col("article_id").alias("article_key"),
        date_key(F.col("t_dat")).alias("date_key"),
        "price",
        "sales_channel_id",
        "batch_id",
    )
    warehouse.write_batches(f"{FACT}_increment", facts)

    # what is known is read without this merge's own batches, so a repeat finds the same
    first_seen = rows.groupBy("t_dat").agg(F.min("batch_id").alias("batch_id"))
    days = star.missing_dates(first_seen.select("t_dat"), merged_dim_date(warehouse, pipeline))
    days = days.join(first_seen, days["date"] == first_seen["t_dat"]).select(
        "date", "date_key", "month", "year", "batch_id"
    )
    warehouse.write_batches(f"{DIM_DATE}_increment", days)

    known = merged_dim_customer(warehouse, pipeline).select("customer_id")
    people = (
        rows.groupBy("customer_id")
        .agg(F.min("batch_id").alias("batch_id"))
        .join(known, "customer_id", "left_anti")
        .select("customer_id", surrogate_key(F.col("customer_id")).alias("customer_key"), "batch_id")
    )
    warehouse.write_batches(f"{DIM_CUSTOMER}_increment", people)

    latest = bound.t if bound.t is not None or after < 0 else before
    set_merged(warehouse, pipeline, int(bound.b), latest)
    return int(bound.b)
