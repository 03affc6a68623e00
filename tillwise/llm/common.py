"""What the text operators share: reading tables, walking texts in tasks, hashed splits, bounded samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of text that one call of a task's function gets at most, but for a single longer text.
SLICE_BYTES = 2 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(df: DataFrame) -> DataFrame:
    """doc_id and text alone: further columns, whatever their names, take no part; a null text is empty."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def remainder(key: str, by: int) -> Column:
    """crc32 of the key as text, modulo ``by``; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % by


def slices(batch: pa.RecordBatch, column: str, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most ``SLICE_BYTES`` (or ``most``) of ``column`` each, or one row."""
    most = SLICE_BYTES if most is None else most
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of every text; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def over_texts(
    df: DataFrame, make: Callable[[], Callable[[list[bytes]], list]], schema: str, column: str = "text"
) -> DataFrame:
    """Every row without ``column``, with the columns that the task's function makes of the texts.

    ``make`` is called once a task and gives a function from a list of texts (UTF-8 bytes) to a list of
    arrays, one for each column of ``schema``. Rows stay where they are; nothing is shuffled.
    """
    kept = [c for c in df.columns if c != column]
    added = StructType.fromDDL(schema)
    out = StructType([*(df.schema[c] for c in kept), *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, column):
                made = [x if isinstance(x, pa.Array) else pa.array(x) for x in work(raw_texts(part, column))]
                old = [part.column(c) for c in kept]
                yield pa.RecordBatch.from_arrays(old + made, names=out.names)

    return df.mapInArrow(run, out)


def keep_texts(df: DataFrame, make: Callable[[], Callable[[list[bytes]], list[bool]]], column: str = "text") -> DataFrame:
    """The rows whose text the task's function wants to keep, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, column):
                yield part.filter(pa.array(work(raw_texts(part, column)), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def labelled_ids(labels: DataFrame, label: str, split: int = 4, held: int = 2, bound: int | None = None) -> DataFrame:
    """doc_id and label (0 or 1) of the rows that may be learnt from, one row per doc_id (the larger label).

    Rows without id or label, and those held out (crc32 remainder ``held`` of ``split``), are left out.
    With ``bound``, an even sample of about that many rows at most, chosen by a hash of doc_id.
    """
    rows = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (remainder("doc_id", split) != held))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    if bound is not None and (n := rows.count()) > bound:
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * bound / n))
    return rows


def change_texts(df: DataFrame, make: Callable[[], Callable[[list[bytes]], list[str]]]) -> DataFrame:
    """Every row with the text that the task's function makes of its own, and ``n_chars``, if there, to match.

    Null texts stay null and are not given to the function's result.
    """
    counted = "n_chars" in df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, "text"):
                old = part.column("text")
                columns = {name: part.column(name) for name in part.schema.names}
                columns["text"] = pa.array(work(raw_texts(part)), old.type, mask=old.is_null().to_numpy(zero_copy_only=False))
                if counted:
                    length = pc.utf8_length(columns["text"]).cast(columns["n_chars"].type)
                    columns["n_chars"] = pc.coalesce(length, columns["n_chars"])
                yield pa.RecordBatch.from_arrays([*columns.values()], schema=part.schema)

    return df.mapInArrow(run, df.schema)


def largest(df: DataFrame, value: Column, bound: int) -> DataFrame:
    """The rows with the largest values, ``bound`` at most: all that lie in the highest sixteenths of a doubling that fit.

    Only a histogram of these steps reaches the driver, and no task sorts. Where the highest step alone holds too many,
    ``bound`` of its rows by value and then content are taken. Values are positive; ``df`` is read twice.
    """
    step = F.floor(F.log2(F.greatest(value, F.lit(1e-9))) * 16)
    kept, lowest = 0, None
    steps = df.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    for row in sorted(steps, key=lambda r: -r["step"]):
        if kept + row["n"] > bound:
            break
        kept, lowest = kept + row["n"], row["step"]
    if steps and lowest is None:
        return df.orderBy(value.desc(), *df.columns).limit(bound)
    return df.where(step >= F.lit(lowest)) if steps else df


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with more underscores a name that ``df`` has not."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def narrowed(df: DataFrame, small: DataFrame, on: str, how: str = "left_semi", rows: int = 1 << 18) -> DataFrame:
    """``df`` joined with stored rows of unique longs, which are counted, and broadcast if they are at most ``rows``."""
    return df.join(F.broadcast(small) if small.count() <= rows else small, on, how)
