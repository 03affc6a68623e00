"""Session settings, and the shared folder in which jobs keep intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(name: str, master: str | None = None, **overrides: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master, where driver and executors share one disk, may fall back to a
    temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tillwise-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/tillwise/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "stage", options: dict | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder, with ``options`` of the writer, and read it back.

    Used where a result feeds several passes: the source is scanned once, every later pass
    sees the same rows, and a lost executor costs a re-read instead of a recomputation.
    """
    path = new_path(df.sparkSession, name)
    df.write.options(**options or {}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_FEW = threading.Lock()
_SEEN: dict[str, int | str] = {"holders": 0}


@contextmanager
def few_at_once(spark: SparkSession, rows: int = 16) -> Iterator[None]:
    """While this holds, tasks in Python get at most ``rows`` rows at a time: for rows that are blocks of many rows.

    A batch of blocks lies in memory several times: with the reader, outside the heap, and in Python. Others who work in the session meanwhile
    get small batches as well; the setting is back when the last one is through.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    with _FEW:
        if not _SEEN["holders"]:
            _SEEN["before"] = spark.conf.get(name)
        _SEEN["holders"] += 1
        spark.conf.set(name, rows)
    try:
        yield
    finally:
        with _FEW:
            _SEEN["holders"] -= 1
            if not _SEEN["holders"]:
                spark.conf.set(name, _SEEN["before"])


def small_side(df: DataFrame, rows: int = 20_000) -> DataFrame:
    """``df``, stored once, with a broadcast hint if it has at most ``rows`` rows.

    For the summary that every row of a large table is joined with: without the hint both sides
    would be shuffled by a key of few values.
    """
    stored = materialise(df, "small")
    return F.broadcast(stored) if stored.count() <= rows else stored
