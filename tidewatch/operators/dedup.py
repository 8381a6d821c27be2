"""One row per event id."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..settings import StreamOptions

# What tells two deliveries of one event apart, earliest first.
_ARRIVAL = ("event_ts", "kafka_timestamp", "kafka_partition", "kafka_offset")


def deduplicate_batch(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Keep the first delivery of each event.

    Spark drops all but one row per key before the shuffle (a window group
    limit), so an id that was replayed without end costs one row per input
    partition, not a task full of copies.
    """
    order = [c for c in _ARRIVAL if c in events.columns]
    # Records without a place on the bus (NULL) are told apart by their content.
    order += [c for c in events.columns if c != key and c not in order]
    first = Window.partitionBy(key).orderBy(*order)
    ranked = events.withColumn("_rank", F.row_number().over(first))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def deduplicate_any(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Keep some delivery of each event; the choice is not repeatable."""
    return events.dropDuplicates([key])


def deduplicate_stream(
    events: DataFrame, options: StreamOptions = StreamOptions(), key: str = "event_id"
) -> DataFrame:
    """Set the watermark and keep one delivery within it.

    Ids are remembered as long as the watermark delay, which bounds the state;
    a replay that comes later counts as a new event.
    """
    if not options.deduplicate:
        return events.withWatermark("event_ts", options.watermark)
    if options.squash_copies:
        events = squash_copies(events, key)
    watermarked = events.withWatermark("event_ts", options.watermark)
    return watermarked.dropDuplicatesWithinWatermark([key])


def squash_copies(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Drop repeated (key, event_ts) within each Arrow batch of rows, without a shuffle.

    A stream cannot combine rows before its stateful shuffle, so all copies of
    one id would go to one task; this leaves one per batch of some thousand
    rows.  Copies in different batches remain for the deduplication proper, and
    so do copies with another event time: one of them may be late, the other not.
    """

    def first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, times = (
                batch.column(c).dictionary_encode().indices.fill_null(-1).to_numpy().astype(np.int64)
                for c in (key, "event_ts")
            )
            _, first = np.unique((ids + 1) * (batch.num_rows + 1) + times + 1, return_index=True)
            yield batch if len(first) == len(ids) else batch.take(pa.array(np.sort(first)))

    return events.mapInArrow(first_of_each, events.schema)


def deduplicate(events: DataFrame, options: StreamOptions = StreamOptions()) -> DataFrame:
    """The stream or the batch way, whichever ``events`` needs."""
    if events.isStreaming:
        return deduplicate_stream(events, options)
    return deduplicate_batch(events) if options.deduplicate else events
