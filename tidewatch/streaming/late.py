"""Rows that came too late for a stream, as a table.

Stateful operators drop rows that are not newer than the watermark and only count them.
This query keeps the same watermark and writes those rows, with the watermark of the time.
It needs no state: the watermark of a batch stands in the query's offset log, which Spark
writes before it runs the batch, and so it is the same when a batch is repeated.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType, TimestampType

from ..settings import StreamOptions
from .progress import query_id
from .run import _checkpoint, _start, _writer

LATE = "late_rows"


def start_late_rows(
    events: DataFrame,
    base: str,
    options: StreamOptions = StreamOptions(),
    name: str = LATE,
    ts: str = "event_ts",
) -> StreamingQuery:
    """Stream late rows into ``base/late_rows``, one folder per batch.

    A row is late if its time is not after the newest time of all earlier batches less
    the watermark's delay.  Rows without a time are never late.
    """
    spark, checkpoint = events.sparkSession, _checkpoint(name, options, base)

    def write(batch: DataFrame, batch_id: int) -> None:
        log = [r.value for r in spark.read.text(f"{checkpoint}/offsets/{batch_id}").collect()]
        watermark = json.loads(log[1])["batchWatermarkMs"]
        # also run with the first batch's watermark of 0: running it is what moves the watermark
        at = F.timestamp_millis(F.lit(watermark))
        late = batch.where(F.col(ts) <= at).withColumn("watermark", at)
        place = f"query_id={query_id(spark, checkpoint)}/batch_id={batch_id}"
        late.write.mode("overwrite").parquet(f"{base}/{LATE}/{place}")

    marked = events.withWatermark(ts, options.watermark)
    return _start(_writer(marked, name, options, base).foreachBatch(write), marked, options)


def read_late_rows(spark: SparkSession, base: str, events: StructType) -> DataFrame:
    """Late rows with the columns of the events they were, and ``watermark``."""
    schema = StructType([*events, StructField("watermark", TimestampType())])
    return spark.read.schema(schema).parquet(f"{base}/{LATE}").select(*schema.fieldNames())
