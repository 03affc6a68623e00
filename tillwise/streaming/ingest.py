"""Micro-batches of sale messages into the ingested and rejected tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwise.operators.cleaning import split_valid
from tillwise.sources.warehouse import Warehouse
from tillwise.streaming.messages import parse_messages

INGESTED = "stream_transactions_ingested"
REJECTED = "stream_transactions_rejected"
LEDGER = "stream_ledger"
ENRICHED = "stream_transactions_enriched"
SALE = "customer_id STRING, article_id BIGINT, t_dat DATE, price DOUBLE, sales_channel_id INT, kafka_timestamp TIMESTAMP"
REJECT = (
    "t_dat STRING, customer_id STRING, article_id BIGINT, price DOUBLE, sales_channel_id INT, "
    "kafka_timestamp TIMESTAMP, raw_value STRING, rejection_reason ARRAY<STRING>"
)
ENTRY = "n_valid BIGINT, n_rejected BIGINT, last_timestamp TIMESTAMP"


def enrich(sales: DataFrame, customers: DataFrame, articles: DataFrame) -> DataFrame:
    """Stream rows with customer and article attributes from static tables."""
    return sales.join(customers, "customer_id", "left").join(articles, "article_id", "left")


def write_batch(
    warehouse: Warehouse, raw: DataFrame, batch_id: int, dims: tuple[DataFrame, DataFrame] | None = None
) -> None:
    """Store one micro-batch: valid rows, rejected rows, then its ledger entry.

    With ``dims`` (customers, articles) the valid rows are also stored with their attributes.

    Each part replaces the folder of this batch, so a replayed batch leaves no duplicates.
    The ledger entry comes last; without it the merge does not look at the batch.
    """
    parsed = parse_messages(raw).persist()
    try:
        valid, rejected = split_valid(parsed)
        sale_columns = [c.split()[0] for c in SALE.split(", ")]
        warehouse.write_batch(INGESTED, valid.select(sale_columns), batch_id)
        warehouse.write_batch(REJECTED, rejected, batch_id)
        if dims:
            warehouse.write_batch(ENRICHED, enrich(valid.select(sale_columns), *dims), batch_id)
        n_valid = F.lit(valid.count())  # of the rows at hand; nothing is read back
        entry = parsed.agg(F.count("*").alias("n"), F.max("kafka_timestamp").alias("last_timestamp")).select(
            n_valid.alias("n_valid"), (F.col("n") - n_valid).alias("n_rejected"), "last_timestamp"
        )
        warehouse.write_batch(LEDGER, entry, batch_id)
    finally:
        parsed.unpersist()


def start(
    messages: DataFrame,
    warehouse: Warehouse,
    checkpoint: str,
    interval: str | None = "30 seconds",
    console: bool = False,
    dims: tuple[DataFrame, DataFrame] | None = None,
) -> StreamingQuery:
    """Run the ingestion. ``interval=None`` takes what is there and stops.

    One query reads the source once and writes all tables; ``console`` starts a second one,
    ``sale_messages_console``, that prints parsed messages, and reads the source again for that.
    """
    if console:
        printed = parse_messages(messages).writeStream.format("console").option("truncate", False)
        printed.queryName("sale_messages_console").start()
    writer = (
        messages.writeStream.foreachBatch(lambda batch, number: write_batch(warehouse, batch, number, dims))
        .option("checkpointLocation", checkpoint)
        .queryName("sale_messages")
    )
    writer = writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)
    return writer.start()


def run_until_any_stops(spark, seconds: int | None = None) -> bool | None:
    """Wait until one of the running streams ends, or for ``seconds`` at most."""
    return spark.streams.awaitAnyTermination(seconds)
