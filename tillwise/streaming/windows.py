"""Event-time windows over the sale stream, and sales taken once, both with state that a watermark lets go.

A message's own time counts. The watermark trails the latest message time of earlier batches by a stated lateness: a window
is final, and written, once the watermark has passed its end, and what would belong to a final window is dropped. State is
kept in the checkpoint, so a restart goes on with windows and sales that are still open.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwise.operators.cleaning import split_valid
from tillwise.sources.warehouse import Warehouse
from tillwise.streaming.ingest import SALE
from tillwise.streaming.messages import parse_messages

WINDOWS = "stream_windows"
ONCE = "stream_transactions_once"
#: What makes two messages the same sale; the time at which they were sent does not.
SAME_SALE = ["customer_id", "article_id", "t_dat", "price", "sales_channel_id"]


def valid_sales(messages: DataFrame, lateness: str) -> DataFrame:
    """Valid sales of a message stream, with a watermark on the message time."""
    valid, _ = split_valid(parse_messages(messages))
    return valid.select([c.split()[0] for c in SALE.split(", ")]).withWatermark("kafka_timestamp", lateness)


def tumbling(length: str) -> Column:
    return F.window("kafka_timestamp", length)


def sliding(length: str, step: str) -> Column:
    """Windows that overlap: a sale counts in each of ``length`` / ``step``."""
    return F.window("kafka_timestamp", length, step)


def sessions(gap: str | Column) -> Column:
    """Windows that last until no sale of the same keys has come for ``gap``."""
    return F.session_window("kafka_timestamp", gap)


def windowed(sales: DataFrame, window: Column, *keys: str) -> DataFrame:
    """Number and value of the sales per window and ``keys``, when the window is final.

    Values are added as decimals, so that they do not depend on the order of arrival.
    """
    sums = sales.groupBy(window.alias("span"), *keys).agg(
        F.count("*").alias("n_sales"), F.sum(F.col("price").cast("decimal(18,2)")).alias("revenue")
    )
    return sums.select(F.col("span.start").alias("begins"), F.col("span.end").alias("ends"), *keys, "n_sales", "revenue")


def taken_once(sales: DataFrame, same: list[str] = SAME_SALE) -> DataFrame:
    """Sales without those that repeat one of the last ``lateness``, such as a file that is delivered again.

    The key of a sale is forgotten when the watermark has passed its time by the lateness; the same sale sent anew after that is taken.
    """
    return sales.dropDuplicatesWithinWatermark(same)


def start(
    messages: DataFrame,
    shape: Callable[[DataFrame], DataFrame],
    warehouse: Warehouse,
    name: str,
    checkpoint: str,
    lateness: str,
    interval: str | None = "30 seconds",
) -> StreamingQuery:
    """Run ``shape`` (of valid sales with a watermark) and append its rows to a table, a folder for each batch.

    A batch that is repeated after a failure replaces its folder. ``interval=None`` takes what is there, lets the watermark
    catch up, and stops.
    """
    writer = (
        shape(valid_sales(messages, lateness))
        .writeStream.outputMode("append")
        .foreachBatch(lambda batch, number: warehouse.write_batch(name, batch, number))
        .option("checkpointLocation", checkpoint)
        .queryName(name)
    )
    writer = writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)
    return writer.start()
