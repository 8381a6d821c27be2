"""The streaming job in stages that share their work.

Independent queries each read and parse the source again, and both the
raw-events and the aggregate query remember every event id.  Here records are
parsed and judged once into a table of their own; raw events and dead letters
are streamed from there, and the window aggregates from the deduplicated raw
events.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import (
    AGGREGATES,
    DEAD_LETTERS,
    DEFAULT_PIPELINE_NAME,
    RAW_EVENTS,
    WIRE_FIELDS,
    RuleBounds,
)
from ..functions.enrich import enrich_events, raw_event_columns
from ..functions.parse import parse_events
from ..operators.dedup import deduplicate_stream
from ..operators.routing import REASON, dead_letter_values, dead_letters, tag_events
from ..operators.windows import aggregate_windows
from ..settings import StreamOptions
from ..sinks.compaction import compact, retire, vacuum
from ..sources.compacted import exists
from .progress import watch
from .run import _checkpoint, ensure_outputs, finish, start_partitioned, start_table, start_values

TAGGED = "events_tagged"
TAGGED_READERS = ("staged_raw", "staged_letters", "staged_bus")


def run_staged(
    records: DataFrame,
    base: str,
    options: StreamOptions = StreamOptions(),
    bounds: RuleBounds = RuleBounds(),
    pipeline_name: str = DEFAULT_PIPELINE_NAME,
) -> None:
    """Bring all tables below ``base`` up to date with the stream of records.

    Every call takes in what arrived since the last one and returns; call it
    on a schedule.  Checkpoints are kept beside the tables.  Files of judged
    records go once all three streams that read them have committed them.
    """
    spark = records.sparkSession
    options = replace(
        options,
        available_now=True,
        squash_copies=True,
        checkpoints=options.checkpoints or f"{base}/_checkpoints",
    )
    watch(spark)
    ensure_outputs(spark, base, options)
    judged = tag_events(parse_events(records), bounds).withColumn(
        "is_valid", F.col(REASON).isNull()
    )
    path = f"{base}/{TAGGED}"
    judge = {"judge": start_partitioned(judged, "judge", path, "is_valid", options)}
    finish(judge, base, options, progress=False)

    tagged = spark.readStream.schema(judged.schema).parquet(path)
    kept = [f for f in WIRE_FIELDS if f != "timestamp"]
    valid = tagged.filter("is_valid").select(*kept, "event_ts")
    letters = dead_letters(tagged.filter("NOT is_valid"), pipeline_name)
    raw = raw_event_columns(enrich_events(deduplicate_stream(valid, options)))
    finish(
        {
            "raw": start_table(raw, "staged_raw", RAW_EVENTS, base, options),
            "letters": start_table(letters, "staged_letters", DEAD_LETTERS, base, options),
            "bus": start_values(dead_letter_values(letters), "staged_bus", options,
                                path=f"{base}/dead_letter_values"),
        },
        base, options, progress=False,
    )

    retire(spark, path, [_checkpoint(r, options, base) for r in TAGGED_READERS])

    events = (
        spark.readStream.schema(RAW_EVENTS.schema)
        .parquet(f"{base}/{RAW_EVENTS.name}")
        .withColumnRenamed("event_timestamp", "event_ts")
        .drop("event_date", "processing_time")
        .withWatermark("event_ts", options.watermark)
    )
    windows = aggregate_windows(events, options.window, options.slide)
    # the last call also records the batches of all stages, and those a failed run left
    finish({"windows": start_table(windows, "staged_windows", AGGREGATES, base, options)}, base, options)


def compact_staged(
    spark: SparkSession,
    base: str,
    before: str,
    options: StreamOptions = StreamOptions(),
    file_rows: int = 5_000_000,
) -> dict[str, list[str]]:
    """Compact the dates before ``before`` of all tables and drop the files replaced.

    To be called between runs of `run_staged`.  Raw events are kept as streamed
    until the window aggregates have read them.  The dates compacted, by table.
    """
    options = replace(options, checkpoints=options.checkpoints or f"{base}/_checkpoints")
    done = {}
    for layout in (RAW_EVENTS, AGGREGATES, DEAD_LETTERS):
        if not exists(spark, f"{base}/{layout.name}"):
            continue
        done[layout.name] = compact(spark, base, layout, before, file_rows)
        readers = ["staged_windows"] if layout is RAW_EVENTS else []
        vacuum(spark, base, layout, [_checkpoint(r, options, base) for r in readers])
    return done
