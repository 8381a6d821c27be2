"""Session settings, the shared work folder and size checks."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session clock: dates, hours and zone-less text are UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as ``spark.checkpoint.dir`` names it.

    Only a session of one local process may go without one and gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"tidewatch-{application_id}-")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/tidewatch/{purpose}-{uuid.uuid4().hex}"


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Fixes values that a recomputation could change (such as partition numbers)
    and survives the loss of any executor.
    """
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str | None]):
    """Set session options for a while; those given as None are left alone."""
    wanted = {k: v for k, v in settings.items() if v is not None}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def fits(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows, without counting beyond them."""
    return df.limit(max_rows + 1).count() <= max_rows


def size_in_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of ``df``; of a settled table, its files by their
    compression factor (``spark.sql.sources.fileCompressionFactor``)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


@dataclass(frozen=True)
class StreamOptions:
    """How a stream runs; the defaults suit a 30-second micro-batch."""

    watermark: str = "2 minutes"
    window: str = "1 minute"
    slide: str = "1 minute"
    trigger: str = "30 seconds"
    available_now: bool = False
    deduplicate: bool = True
    squash_copies: bool = False  # before the stateful shuffle; for large micro-batches
    max_offsets_per_trigger: int = 5000
    max_files_per_trigger: int | None = None
    checkpoints: str | None = None
    database: str | None = None  # where to create missing tables over the output folders
    shuffle_partitions: int | None = None  # of stateful queries; fixed by their first run
    state_store: str = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
