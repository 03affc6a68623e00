"""Streaming sources of sale messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def kafka_messages(spark: SparkSession, servers: str, topic: str, starting: str = "latest") -> DataFrame:
    """Messages of a topic; a restart continues from the checkpoint, not from ``starting``."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", "false")
        .load()
        .select("key", "value", "timestamp")
    )


def file_messages(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """The same columns from parquet files that arrive in ``folder``."""
    reader = spark.readStream.schema("key STRING, value BINARY, timestamp TIMESTAMP")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def encode_messages(sales: DataFrame, key: str = "customer_id") -> DataFrame:
    """Keyed JSON messages from the five sale columns, ready for a Kafka or file sink."""
    columns = ["t_dat", "customer_id", "article_id", "price", "sales_channel_id"]
    return sales.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*columns)).cast("binary").alias("value"),
    )
