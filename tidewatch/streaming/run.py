"""Running the job as streaming queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..contracts import (
    AGGREGATES,
    DEAD_LETTERS,
    DEFAULT_PIPELINE_NAME,
    RAW_EVENTS,
    RuleBounds,
    TableLayout,
)
from ..operators.routing import dead_letter_values
from ..plans.batch import event_tables
from ..settings import StreamOptions, session_settings
from ..sinks.tables import batch_writer, ensure_table
from .progress import (
    METRICS,
    checkpoints_below,
    clear_stop,
    record_endings,
    record_progress,
    stop_requested,
    watch,
)

OUTPUTS: dict[str, TableLayout] = {
    "raw_events": RAW_EVENTS,
    "aggregates": AGGREGATES,
    "dead_letters": DEAD_LETTERS,
}


def _checkpoint(name: str, options: StreamOptions, base: str) -> str:
    """Beside the tables unless said otherwise: a restart goes on where the last run ended."""
    return f"{options.checkpoints or f'{base}/_checkpoints'}/{name}"


def _writer(df: DataFrame, name: str, options: StreamOptions, base: str) -> DataStreamWriter:
    writer = (
        df.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", _checkpoint(name, options, base))
    )
    if options.available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=options.trigger)


def _start(writer: DataStreamWriter, df: DataFrame, options: StreamOptions) -> StreamingQuery:
    """Start under the stream's settings; a query keeps those it was started with."""
    partitions = options.shuffle_partitions
    settings = {
        "spark.sql.streaming.stateStore.providerClass": options.state_store,
        "spark.sql.shuffle.partitions": str(partitions) if partitions else None,
    }
    with session_settings(df.sparkSession, settings):
        return writer.start()


def start_table(
    df: DataFrame,
    name: str,
    layout: TableLayout,
    base: str,
    options: StreamOptions = StreamOptions(),
    sink: str = "parquet",
    **sink_options,
) -> StreamingQuery:
    """Stream a frame into a table.

    ``parquet`` is Spark's own file sink, whose log makes every batch count
    once; any other name is a per-batch writer of ``sinks``.
    """
    if sink == "parquet":
        return start_partitioned(df, name, f"{base}/{layout.name}", layout.partition_by, options)
    if sink == "table":
        sink_options = {"checkpoint": _checkpoint(name, options, base)} | sink_options
    write = batch_writer(sink, base, layout, **sink_options)
    return _start(_writer(df, name, options, base).foreachBatch(write), df, options)


def start_partitioned(
    df: DataFrame, name: str, path: str, partition_by: str, options: StreamOptions
) -> StreamingQuery:
    """Stream a frame into partitioned Parquet files, every batch counted once."""
    base = path.rpartition("/")[0]
    writer = _writer(df, name, options, base).format("parquet").option("path", path)
    return _start(writer.partitionBy(partition_by), df, options)


def start_values(
    df: DataFrame,
    name: str,
    options: StreamOptions = StreamOptions(),
    fmt: str = "text",
    **sink_options: str,
) -> StreamingQuery:
    """Stream a frame of bus values to Kafka (``fmt="kafka"``) or to text files.

    A sink that is no folder needs ``options.checkpoints``.
    """
    base = sink_options.get("path", "").rpartition("/")[0]
    if not (options.checkpoints or base):
        raise ValueError("set checkpoints: without them a restart sends everything again")
    writer = _writer(df, name, options, base).format(fmt).options(**sink_options)
    return _start(writer, df, options)


def start_stream(
    records: DataFrame,
    base: str,
    options: StreamOptions = StreamOptions(),
    bounds: RuleBounds = RuleBounds(),
    pipeline_name: str = DEFAULT_PIPELINE_NAME,
    sink: str = "parquet",
    letters_fmt: str = "text",
    outputs: tuple[str, ...] = (*OUTPUTS, "dead_letter_bus"),
    **letter_options: str,
) -> dict[str, StreamingQuery]:
    """Start one query per output over the same stream of bus records.

    Outputs: ``raw_events``, ``aggregates`` and ``dead_letters`` go to tables
    below ``base``, ``dead_letter_bus`` goes out as JSON values.  Checkpoints are
    kept beside the tables unless ``options`` name another place.  The session's
    listener is registered, and what the last run left unrecorded is recorded now.
    """
    spark = records.sparkSession
    options = replace(options, checkpoints=options.checkpoints or f"{base}/_checkpoints")
    watch(spark)
    ensure_outputs(spark, base, options)
    clear_stop(spark, base)
    keep_progress(spark, base, options)
    tables = event_tables(
        records, bounds=bounds, options=options, pipeline_name=pipeline_name
    )
    frames = {
        "raw_events": lambda: tables.raw_events,
        "aggregates": lambda: tables.aggregates,
        "dead_letters": lambda: tables.letters,
    }
    unknown = set(outputs) - set(frames) - {"dead_letter_bus"}
    if unknown:
        raise ValueError(f"unknown outputs: {', '.join(sorted(unknown))}")
    queries = {
        name: start_table(frames[name](), name, OUTPUTS[name], base, options, sink)
        for name in outputs
        if name in frames
    }
    if "dead_letter_bus" in outputs:
        if letters_fmt != "kafka":
            letter_options = {"path": f"{base}/dead_letter_values"} | letter_options
        queries["dead_letter_bus"] = start_values(
            dead_letter_values(tables.letters), "dead_letter_bus", options, letters_fmt,
            **letter_options,
        )
    return queries


def ensure_outputs(spark: SparkSession, base: str, options: StreamOptions) -> None:
    """Create the tables over ``base`` that ``options.database`` lacks."""
    if options.database:
        for layout in OUTPUTS.values():
            ensure_table(spark, layout, base, f"{options.database}.{layout.name}")


def keep_progress(spark: SparkSession, base: str, options: StreamOptions = StreamOptions()) -> int:
    """Bring the metrics table below ``base`` up to date with all its queries' batches."""
    folder = options.checkpoints or f"{base}/_checkpoints"
    return record_progress(spark, f"{base}/{METRICS}", checkpoints_below(spark, folder), watch(spark))


def finish(
    queries: dict[str, StreamingQuery],
    base: str | None = None,
    options: StreamOptions = StreamOptions(),
    progress: bool = True,
) -> None:
    """Wait for bounded queries to drain their source; a failure is raised.

    With ``base``, all of them end first, and those that failed leave an alert there;
    with ``progress`` their batches are recorded, too.
    """
    failed = None
    for query in queries.values():
        try:
            query.awaitTermination()
        except Exception as failure:
            if base is None:
                raise
            failed = failed or failure
    if base is not None:
        spark = SparkSession.active()
        record_endings(spark, base, queries)
        if progress:
            keep_progress(spark, base, options)
    if failed:
        raise failed


def wait_and_stop(
    spark: SparkSession,
    queries: dict[str, StreamingQuery],
    base: str | None = None,
    options: StreamOptions = StreamOptions(),
    every: int = 60,
) -> None:
    """Wait until any query ends or a stop is asked for, then stop the others, each on its own.

    With ``base``, the batches so far are recorded there every so many seconds, a stop
    can be asked for (`progress.request_stop`), and queries that failed leave an alert.
    """
    try:
        while not spark.streams.awaitAnyTermination(every):
            if base is not None:
                keep_progress(spark, base, options)
                if stop_requested(spark, base):
                    break
    finally:
        stop(queries)
        if base is not None:
            keep_progress(spark, base, options)
            record_endings(spark, base, queries)


def stop(queries: dict[str, StreamingQuery]) -> list[str]:
    """Stop all queries; one that fails to stop does not keep the rest running."""
    failed = []
    for name, query in queries.items():
        try:
            query.stop()
        except Exception:
            failed.append(name)
    return failed
