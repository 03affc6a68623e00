"""JDBC connector: whole table, pushed-down query, and a scan split over ranges of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, properties: dict[str, str]) -> DataFrame:
    return spark.read.jdbc(url, table, properties=properties)


def read_query(spark: SparkSession, url: str, sql: str, properties: dict[str, str]) -> DataFrame:
    """Run ``sql`` in the database and read its result."""
    return spark.read.jdbc(url, f"({sql}) t", properties=properties)


def bounds_query(table: str, column: str) -> str:
    return f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}"


def read_ranges(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    properties: dict[str, str],
    partitions: int = 8,
    source: str | None = None,
) -> DataFrame:
    """Scan ``table`` (or the query ``source``) in ``partitions`` ranges of ``column``.

    An empty table has no bounds; it is read without ranges.
    """
    relation = f"({source}) t" if source else table
    bounds = read_query(spark, url, bounds_query(table, column), properties).first()
    low, high = bounds[0], bounds[1]
    if low is None:
        return spark.read.jdbc(url, relation, properties=properties)
    return spark.read.jdbc(
        url,
        relation,
        column=column,
        lowerBound=int(low),
        upperBound=int(high),
        numPartitions=partitions,
        properties=properties,
    )


def overwrite(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Replace the rows of ``table``, keeping its definition, grants and indexes."""
    df.write.mode("overwrite").option("truncate", True).jdbc(url, table, properties=properties)


def append(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    df.write.mode("append").jdbc(url, table, properties=properties)
