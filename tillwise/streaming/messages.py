"""Decoding of sale messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwise import model


def parse_messages(raw: DataFrame) -> DataFrame:
    """Sale columns, message time and the raw text.

    Text that is no JSON gives NULL columns, which the validity rules reject; the raw text
    stays with the row, so a rejected message can be repaired later.

    The decoded columns come out of a generator of one row: conditions on them are not moved below it, where each
    would decode the text again.
    """
    text = F.col("value").cast("string")
    data = F.from_json(text, model.MESSAGE, {"mode": "PERMISSIVE"})
    return raw.select(F.inline(F.array(data)), F.col("timestamp").alias("kafka_timestamp"), text.alias("raw_value"))
