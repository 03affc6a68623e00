"""File sources and sinks: CSV with explicit schemas, parquet marts, flat exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tillwise import model


def read_csv(spark: SparkSession, path: str, schema: str, keep_bad: bool = False) -> DataFrame:
    """CSV with a header and a fixed schema; a field that does not parse becomes NULL.

    ``keep_bad`` adds ``_bad_record``: the raw line of every row with such a field.
    """
    fields = StructType.fromDDL(schema)
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if keep_bad:
        fields = StructType(fields.fields).add("_bad_record", "string")
        reader = reader.option("columnNameOfCorruptRecord", "_bad_record")
    return reader.schema(fields).csv(path)


def read_csv_inferred(
    spark: SparkSession,
    path: str,
    overrides: dict[str, str],
    dates: tuple[str, ...] = (),
) -> DataFrame:
    """CSV with types that hold for all rows, except for ``overrides`` and parsed ``dates``.

    All rows are read once to find the types, so no field of another column can fail to fit.
    Overridden and date columns are read as text and converted; what does not convert is NULL.
    """
    sampled = spark.read.option("header", True).option("inferSchema", True).csv(path)
    fixed = set(overrides) | set(dates)
    schema = StructType()
    for field in sampled.schema:
        schema.add(field.name, "string" if field.name in fixed else field.dataType)
    frame = spark.read.option("header", True).schema(schema).csv(path)
    converted: dict[str, Column] = {c: F.col(c).try_cast(t) for c, t in overrides.items()}
    converted.update({c: F.try_to_date(F.col(c), "yyyy-MM-dd") for c in dates})
    return frame.withColumns(converted)


def read_sales_files(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "transactions": read_csv(spark, f"{folder}/transactions_train.csv", model.TRANSACTIONS),
        "customers": read_csv(spark, f"{folder}/customers.csv", model.CUSTOMERS),
        "articles": read_csv(spark, f"{folder}/articles.csv", model.ARTICLES),
    }


def read_features(spark: SparkSession, path: str | None = None, table: str | None = None) -> DataFrame:
    """Customer features: an explicit file wins over a named table; no rows is an error."""
    if path:
        frame = (
            spark.read.option("header", True).option("inferSchema", True).csv(path)
            if path.endswith(".csv")
            else spark.read.parquet(path)
        )
    else:
        frame = spark.table(table or "customers_features_train")
    if frame.isEmpty():
        raise ValueError(f"no customer features in {path or table}")
    return frame


def export_csv(df: DataFrame, path: str) -> None:
    """A header and one file per partition; the marts exported this way are small groups."""
    df.write.mode("overwrite").option("header", True).csv(path)


def export_text(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").text(path)
