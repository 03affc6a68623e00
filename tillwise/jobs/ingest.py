"""Ingest sale messages: ``spark-submit ingest.py --warehouse FOLDER --checkpoint FOLDER --servers HOST:PORT --topic NAME``.

``--folder`` reads parquet files of messages in place of a topic; ``--once`` takes what is there and stops.
"""

from __future__ import annotations

import argparse

from tillwise.session import build_session
from tillwise.sources.streams import file_messages, kafka_messages
from tillwise.sources.warehouse import Warehouse
from tillwise.streaming import ingest


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--warehouse", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--servers")
    parser.add_argument("--topic")
    parser.add_argument("--folder")
    parser.add_argument("--once", action="store_true")
    parser.add_argument("--enrich", action="store_true", help="also store sales with customer and article attributes")
    given = parser.parse_args(args)
    if bool(given.folder) == bool(given.servers and given.topic):
        parser.error("give either --folder or --servers and --topic")
    spark = build_session("ingest")
    warehouse = Warehouse(spark, given.warehouse)
    messages = file_messages(spark, given.folder) if given.folder else kafka_messages(spark, given.servers, given.topic)
    dims = None
    if given.enrich:
        dims = (warehouse.read("dim_customer"), warehouse.read("dim_article").drop("article_key"))
    interval = None if given.once else "30 seconds"
    ingest.start(messages, warehouse, given.checkpoint, interval, dims=dims).awaitTermination()


if __name__ == "__main__":
    main()
