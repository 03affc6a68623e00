"""Warehouse tables as parquet folders under one root."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

#: The one error that means that nothing has been written yet.
MISSING = "PATH_NOT_FOUND"


class Warehouse:
    """Named tables: replaced as a whole, or grown by numbered batches.

    ``overwrite`` writes a new version beside the old one and only then records it, so a
    reader never meets a half-written or missing table, and a failed write changes nothing.
    ``write_batch`` replaces the folder of one batch, so repeating it leaves the same rows. Batches lie in
    blocks of ``BLOCK``, and a read of late batches lists their blocks only, however many there were before.
    """

    BLOCK = 128

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _records(self, name: str) -> DataFrame | None:
        try:
            reader = self.spark.read.schema("version STRING, at TIMESTAMP, holds_upto BIGINT").option("mode", "FAILFAST")
            return reader.json(f"{self.root}/{name}/versions")
        except AnalysisException as error:
            if error.getCondition() != MISSING:
                raise
            return None

    def path(self, name: str) -> str | None:
        records = self._records(name)
        newest = records and records.agg(F.max_by("version", F.struct("at", "version"))).first()[0]
        return f"{self.root}/{name}/{newest}" if newest else None

    def holds_upto(self, name: str) -> int:
        """The last batch that the newest version of the table accounts for; -1 if it knows none."""
        records = self._records(name)
        newest = records and records.agg(F.max_by(F.coalesce("holds_upto", F.lit(-1)), F.struct("at", "version"))).first()[0]
        return -1 if newest is None else newest

    def exists(self, name: str) -> bool:
        return self.path(name) is not None

    def read(self, name: str) -> DataFrame:
        path = self.path(name)
        if path is None:
            raise LookupError(f"no table {name} under {self.root}")
        return self.spark.read.parquet(path)

    def overwrite(self, name: str, df: DataFrame, partition_by: str | None = None, holds_upto: int = -1) -> None:
        """Replace the table. ``holds_upto`` is recorded in the same step: the last batch that the
        new version accounts for, so that readers add later batches only."""
        version = f"v-{uuid.uuid4().hex}"
        if partition_by:
            # One shuffle that AQE sizes: a hot partition value is split over several tasks.
            df.hint("rebalance", partition_by).write.partitionBy(partition_by).parquet(
                f"{self.root}/{name}/{version}"
            )
        else:
            df.write.parquet(f"{self.root}/{name}/{version}")
        record = self.spark.range(1).select(
            F.lit(version).alias("version"),
            F.current_timestamp().alias("at"),
            F.lit(holds_upto).cast("bigint").alias("holds_upto"),
        )
        record.write.mode("append").json(f"{self.root}/{name}/versions")

    def write_batch(self, name: str, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/batches/block={batch_id // self.BLOCK}/batch_id={batch_id}")

    def write_batches(self, name: str, df: DataFrame) -> None:
        """Replace every batch that occurs in ``df`` (column ``batch_id``) and no other."""
        (
            df.withColumn("block", F.floor(F.col("batch_id") / self.BLOCK))
            .hint("rebalance", "batch_id")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("block", "batch_id")
            .parquet(f"{self.root}/{name}/batches")
        )

    def _blocks(self, top: str) -> list[int]:
        """Numbers of the blocks under a folder: one listing, of the blocks alone."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(top)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        names = [x.getPath().getName() for x in files.listStatus(path)]
        return sorted(int(n.removeprefix("block=")) for n in names if n.startswith("block="))

    def read_batches(self, name: str, schema: str, after: int | None = None, upto: int | None = None) -> DataFrame:
        """Rows of the batches in (after, upto]; no batch yet gives an empty frame."""
        top = f"{self.root}/{name}/batches"
        first = 0 if after is None else (after + 1) // self.BLOCK
        blocks = [b for b in self._blocks(top) if b >= first and (upto is None or b <= upto // self.BLOCK)]
        reader = self.spark.read.schema(f"{schema}, block BIGINT, batch_id BIGINT").option("basePath", top)
        if not blocks:
            return self.spark.createDataFrame([], f"{schema}, batch_id BIGINT")
        frame = reader.parquet(*[f"{top}/block={b}" for b in blocks]).drop("block")
        if after is not None:
            frame = frame.where(F.col("batch_id") > after)
        if upto is not None:
            frame = frame.where(F.col("batch_id") <= upto)
        return frame
