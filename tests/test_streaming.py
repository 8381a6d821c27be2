import datetime as dt
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewatch.contracts import AGGREGATES, DEAD_LETTERS, RAW_EVENTS, INSTRUMENTS
from tidewatch.plans.batch import event_tables
from tidewatch.settings import StreamOptions, new_folder, shared_folder
from tidewatch.sinks.tables import (
    append_table,
    batch_writer,
    ensure_table,
    read_commits,
    write_report,
    write_tables,
)
from tidewatch.sources.records import (
    as_records,
    instruments,
    kafka_options,
    read_letter_lines,
    read_records,
    read_table,
    spread_out,
    stream_records,
)
from tidewatch.streaming.listener import ProgressListener
from tidewatch.streaming.run import finish, start_stream, stop

ONCE = StreamOptions(available_now=True, max_files_per_trigger=1)


def run(spark, folder, base, options=ONCE, **kwargs):
    queries = start_stream(stream_records(spark, folder, "text", options), str(base), options, **kwargs)
    finish(queries)
    return {q.id for q in queries.values()}


def test_stream_equals_batch(spark, feed, tmp_path):
    """Several files, replays, invalid rows; a last event closes the windows."""
    for part in range(4):
        folder = feed(*[
            (f"{part}-{i % 20}", part * 40 + i % 20, {"price": -1.0} if i == 3 else {})
            for i in range(25)
        ])
    folder = feed(("end", 3600, {"symbol": "END"}))
    base = tmp_path / "out"
    run(spark, folder, base, StreamOptions(
        available_now=True, max_files_per_trigger=1, checkpoints=str(tmp_path / "c")))
    batch = event_tables(read_records(spark, folder, "text"))

    def rows(df, *skip):
        return sorted(str(r) for r in df.drop(*skip).collect())

    assert rows(read_table(spark, str(base), "events_raw"), "processing_time") == rows(
        batch.raw_events, "processing_time")
    assert rows(read_table(spark, str(base), "events_aggregates_1m"), "processing_time") == rows(
        batch.aggregates.filter("symbol <> 'END'"), "processing_time")
    letters = ("processing_timestamp", "event_date")
    assert rows(read_table(spark, str(base), "dead_letter_events"), *letters) == rows(
        batch.letters, *letters)
    assert read_letter_lines(spark, f"{base}/dead_letter_values").count() == 4


def test_rerun_on_the_same_checkpoint_adds_nothing(spark, feed, tmp_path):
    folder = feed(("1", 0, {}), ("2", 5, {}))
    options = StreamOptions(available_now=True, checkpoints=str(tmp_path / "c"))
    for _ in range(2):
        run(spark, folder, tmp_path / "out", options, outputs=("raw_events",))
    assert read_table(spark, str(tmp_path / "out"), "events_raw").count() == 2
    feed(("2", 5, {}), ("3", 6, {}))
    run(spark, folder, tmp_path / "out", options, outputs=("raw_events",))
    ids = [r.event_id for r in read_table(spark, str(tmp_path / "out"), "events_raw").collect()]
    assert sorted(ids) == ["1", "2", "3"]


def test_late_rows_are_dropped_and_counted(spark, feed, tmp_path):
    listener = ProgressListener()
    spark.streams.addListener(listener)
    folder = feed(("1", 5, {}), ("2", 25, {}))
    feed(("3", 600, {}))
    feed(("4", 620, {}))
    feed(("late", 10, {}), ("5", 3600, {}))
    ended = run(spark, folder, tmp_path / "out", outputs=("aggregates",))
    assert listener.wait_for_endings(ended)
    spark.streams.removeListener(listener)
    windows = read_table(spark, str(tmp_path / "out"), "events_aggregates_1m")
    counts = {r.window_start.minute: r.event_count for r in windows.collect()}
    assert counts == {0: 2, 10: 2}
    metrics = listener.metrics(spark).where(F.col("query_id").isin(*ended))
    assert metrics.agg(F.sum("rows_dropped_late")).first()[0] == 1
    assert metrics.filter("num_input_rows > 0").count() == 4
    path = new_folder(spark, "metrics")
    assert listener.flush(spark, path) >= metrics.count()
    assert listener.flush(spark, path) == 0
    assert {r.query for r in spark.read.parquet(path).collect()} >= {"aggregates"}


def test_late_rows_are_kept_with_their_watermark(spark, feed, tmp_path):
    from tidewatch.functions.parse import parse_events
    from tidewatch.streaming.late import read_late_rows, start_late_rows

    folder = feed(("1", 5, {}), ("2", 600, {}))
    feed(("late", 10, {}), ("edge", 480, {}), ("in-time", 481, {}), ("3", 900, {}))
    feed(("later", 700, {}))
    base = str(tmp_path / "out")
    for _ in range(2):
        events = parse_events(stream_records(spark, folder, "text", ONCE)).select("event_id", "event_ts")
        finish({"late": start_late_rows(events, base, ONCE)})
    rows = read_late_rows(spark, base, events.schema).collect()
    noon = dt.datetime(2026, 6, 25)
    assert sorted((r.event_id, (r.watermark - noon).total_seconds()) for r in rows) == [
        ("edge", 480), ("late", 480), ("later", 780),
    ]


def test_failed_query_is_reported(spark, feed, tmp_path):
    from tidewatch.plans.alerts import termination_alerts

    listener = ProgressListener()
    spark.streams.addListener(listener)
    folder = feed(("1", 5, {}))
    broken = stream_records(spark, folder, "text").withColumn(
        "value", F.raise_error(F.lit("disk on fire")).cast("binary")
    )
    queries = start_stream(broken, str(tmp_path / "o"), ONCE, outputs=("dead_letters",))
    with pytest.raises(Exception, match="disk on fire"):
        finish(queries)
    assert listener.wait_for_endings({q.id for q in queries.values()})
    spark.streams.removeListener(listener)
    alerts = termination_alerts(listener.terminations(spark)).collect()
    assert any("disk on fire" in a.message for a in alerts)
    assert stop(queries) == []


def test_batch_writer_may_repeat_a_batch(spark, bus, event, tmp_path):
    raw = event_tables(bus(event(), event(event_id="2"))).raw_events
    write = batch_writer("table", str(tmp_path), RAW_EVENTS)
    for batch_id in (0, 1, 1):
        write(raw, batch_id)
    write(raw.limit(0), 2)
    assert spark.read.parquet(f"{tmp_path}/events_raw").count() == 4
    logged = read_commits(spark, str(tmp_path), RAW_EVENTS).orderBy("batch_id").collect()
    assert [(r.query_id, r.batch_id, r.rows) for r in logged] == [("none", 0, 2), ("none", 1, 2), ("none", 2, 0)]
    assert not (tmp_path / "events_raw" / "query_id=none" / "batch_id=2").exists()


def test_batch_writer_clusters_and_creates_its_table(spark, bus, event, tmp_path):
    rows = [event(event_id=str(i), symbol=f"S{i * 7 % 20:02d}") for i in range(40)]
    raw = event_tables(bus(*rows)).raw_events
    write = batch_writer("table", str(tmp_path), RAW_EVENTS, table="events_by_batch", file_rows=10)
    write(raw, 0)
    assert spark.catalog.tableExists("events_by_batch")
    files = sorted((tmp_path / "events_raw").rglob("*.parquet"))
    assert len(files) == 4
    spans = []
    for f in files:
        symbols = [r.symbol for r in spark.read.parquet(str(f)).collect()]
        assert symbols == sorted(symbols)
        spans.append((symbols[0], symbols[-1]))
    spans.sort()
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    spark.sql("DROP TABLE events_by_batch")


def test_batch_writer_cuts_no_date_that_fits_a_file(spark, bus, event, tmp_path):
    rows = [
        event(event_id=f"{day}-{i}", symbol=f"S{i:02d}", timestamp=f"2026-06-{day}T01:00:00Z")
        for day, n in ((20, 9), (21, 7), (22, 10), (23, 25), (24, 8)) for i in range(n)
    ]
    raw = event_tables(bus(*rows)).raw_events
    batch_writer("table", str(tmp_path), RAW_EVENTS, file_rows=10)(raw, 0)
    files = Counter(f.parent.name for f in (tmp_path / "events_raw").rglob("*.parquet"))
    assert files.pop("event_date=2026-06-23") > 1
    assert set(files.values()) == {1} and len(files) == 4


def test_per_batch_sinks_in_a_stream(spark, feed, tmp_path, capsys):
    folder = feed(("1", 0, {}), ("2", 5, {}))
    run(spark, folder, tmp_path / "out", outputs=("raw_events",), sink="table")
    assert spark.read.parquet(f"{tmp_path}/out/events_raw").count() == 2
    batch_writer("console", "", RAW_EVENTS, rows=1)(spark.range(3), 0)
    batch_writer("console", "", RAW_EVENTS)(spark.range(0), 1)
    shown = capsys.readouterr().out
    assert "batch 0" in shown and "batch 1" not in shown


def test_unknown_sink_and_output(spark, feed, tmp_path):
    with pytest.raises(ValueError, match="unknown sink"):
        batch_writer("teletype", "", RAW_EVENTS)
    stream = stream_records(spark, feed(("1", 0, {})), "text")
    with pytest.raises(ValueError, match="unknown outputs"):
        start_stream(stream, str(tmp_path), ONCE, outputs=("nothing",))


def test_tables_by_name(spark, bus, event, tmp_path):
    tables = event_tables(bus(event(), event(event_id="2", timestamp="2026-06-24T01:00:00Z"), "{"))
    base = str(tmp_path)
    write_tables({"events_raw": tables.raw_events, "dead_letter_events": tables.letters}, base)
    append_table(tables.aggregates, base, AGGREGATES)
    for layout in (RAW_EVENTS, AGGREGATES, DEAD_LETTERS):
        for _ in range(2):
            ensure_table(spark, layout, base)
        spark.sql(f"MSCK REPAIR TABLE {layout.name}")
    assert spark.table("events_raw").count() == 2
    assert spark.table("events_raw").filter("event_date = '2026-06-24'").count() == 1
    assert spark.table("dead_letter_events").count() == 1
    plan = read_table(spark, base, "events_raw").filter("event_date = '2026-06-24' AND symbol = 'A'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in text
    assert "PushedFilters: [IsNotNull(symbol), EqualTo(symbol,A)]" in text
    for name in ("events_raw", "events_aggregates_1m", "dead_letter_events"):
        spark.sql(f"DROP TABLE {name}")


def test_report_files(spark, tmp_path):
    for _ in range(2):
        write_report(spark.range(1).withColumnRenamed("id", "score"), str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).count() == 2


def test_kafka_options():
    options = kafka_options("broker:9092", "events", group_id="g")
    assert options == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "events",
        "startingOffsets": "latest", "maxOffsetsPerTrigger": "5000", "failOnDataLoss": "false",
        "kafka.group.id": "g",
    }
    for bad in ({"servers": ""}, {"starting_offsets": "now"}, {"max_offsets_per_trigger": 0}):
        with pytest.raises(ValueError):
            kafka_options(**({"servers": "b", "topic": "t"} | bad))


def test_kafka_needs_its_connector(spark):
    """All but the connector is there: the load gets as far as looking it up."""
    from tidewatch.sources.records import read_kafka

    with pytest.raises(Exception, match="kafka"):
        read_kafka(spark, "broker:9092", "events", ONCE, starting_offsets="earliest")


def test_stream_settings_are_put_back(spark, feed, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    options = StreamOptions(available_now=True, shuffle_partitions=2)
    run(spark, feed(("1", 0, {})), tmp_path / "out", options, outputs=("raw_events",))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_sources(spark, bus, event):
    assert instruments(spark).count() == len(INSTRUMENTS)
    wrapped = as_records(spark.createDataFrame([("{}", "k")], "j string, s string"), "j", "s")
    row = wrapped.first()
    assert (bytes(row.key), bytes(row.value), row.topic, row.offset) == (b"k", b"{}", "events", None)
    assert spread_out(spark.range(10).coalesce(1)).rdd.getNumPartitions() == 4
    assert spread_out(spark.range(10, numPartitions=9)).rdd.getNumPartitions() == 9
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_no_python_in_the_plans(spark, bus, event):
    tables = event_tables(bus(event()))
    for df in (tables.raw_events, tables.aggregates, tables.letters):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan


def test_staged_run_is_incremental_and_equals_batch(spark, feed, tmp_path):
    from tidewatch.streaming.staged import run_staged

    base = str(tmp_path / "out")
    folder = feed(*[(f"{i % 15}", i % 15, {"price": -1.0} if i == 3 else {}) for i in range(20)])
    run_staged(stream_records(spark, folder, "text"), base)
    assert read_table(spark, base, "events_raw").count() == 15
    feed(("5", 5, {}), ("new", 70, {}))
    feed(("end", 3600, {"symbol": "END"}))
    for _ in range(2):
        run_staged(stream_records(spark, folder, "text"), base)
    batch = event_tables(read_records(spark, folder, "text"))
    ids = sorted(r.event_id for r in read_table(spark, base, "events_raw").collect())
    assert ids == sorted(r.event_id for r in batch.raw_events.collect())

    def rows(df):
        return sorted(str(r) for r in df.drop("processing_time").collect())

    assert rows(read_table(spark, base, "events_aggregates_1m")) == rows(
        batch.aggregates.filter("symbol <> 'END'"))
    assert read_table(spark, base, "dead_letter_events").count() == 1
    assert read_letter_lines(spark, f"{base}/dead_letter_values").count() == 1


@pytest.mark.parametrize("keep", [1, 100_000])
def test_cooldown_in_a_stream(spark, tmp_path, keep):
    from tidewatch.contracts import ALERT_SCHEMA
    from tidewatch.streaming.cooldown import cooled_down_stream
    from tidewatch.streaming.run import start_values

    base = dt.datetime(2026, 1, 1)
    folder = str(tmp_path / "alerts")
    for seconds in ([60, 0, 30], [90, 121], [150, 181]):
        rows = [(base + dt.timedelta(seconds=s), "a", "warning", "m") for s in seconds]
        spark.createDataFrame(rows, ALERT_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(ALERT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    out = cooled_down_stream(stream, keep_rows=keep)
    query = start_values(out, "cool", ONCE, "parquet", path=str(tmp_path / "out"))
    finish({"cool": query})
    sent = spark.read.parquet(str(tmp_path / "out")).orderBy("at").collect()
    assert [(r["at"] - base).total_seconds() for r in sent] == [0, 60, 121, 181]


def test_a_million_alerts_of_one_title_in_one_batch(spark, tmp_path):
    """They wait in the state, chunk by chunk; what goes out is the batch's rule."""
    from pyspark.sql import functions as F

    from tidewatch.contracts import ALERT_SCHEMA
    from tidewatch.streaming.cooldown import cooled_down_stream
    from tidewatch.streaming.run import start_values

    folder = str(tmp_path / "alerts")
    n, start = 1_000_000, 1_767_225_600
    spark.range(n).select(
        F.timestamp_micros(F.lit(start * 1_000_000) + F.col("id") * 7919 % n * 3600).alias("at"),
        F.lit("a").alias("title"), F.lit("warning").alias("severity"), F.lit("m").alias("message"),
    ).write.parquet(folder)
    stream = spark.readStream.schema(ALERT_SCHEMA).parquet(folder)
    out = cooled_down_stream(stream, keep_rows=20_000)
    finish({"cool": start_values(out, "many", ONCE, "parquet", path=str(tmp_path / "out"))})
    sent = spark.read.parquet(str(tmp_path / "out")).select(F.unix_micros("at")).collect()
    expect, last = [], None
    for t in range(n):
        if last is None or (t - last) * 3600 >= 60_000_000:
            expect.append(start * 1_000_000 + t * 3600)
            last = t
    assert sorted(r[0] for r in sent) == expect


def test_put_away_alerts_are_walked_in_small_memory():
    """The processor itself, without a session: no more rows at once than it may keep."""
    import numpy as np
    import pandas as pd

    from tidewatch.streaming import cooldown

    class Value:
        held = None

        def exists(self):
            return self.held is not None

        def get(self):
            return self.held

        def update(self, value):
            self.held = value

    class Map(dict):
        def updateValue(self, key, value):
            self[key] = value

        def getValue(self, key):
            return self[key]

    rng = np.random.default_rng(3)
    at = rng.permutation(1_000_000) * 3_600
    chunks = [pd.DataFrame({"at_micros": a, "severity": "warning", "message": "m"}) for a in np.split(at, 100)]
    walker = cooldown._Cooldown(60_000_000, keep=20_000)
    walker._last, walker._waiting = Value(), Map()
    largest = []
    concat = pd.concat

    def watched(frames, **options):
        out = concat(frames, **options)
        largest.append(len(out))
        return out

    cooldown.pd.concat = watched
    try:
        sent = [int(r["at_micros"].iloc[0]) for r in walker.handleInputRows(("a",), iter(chunks), None)]
    finally:
        cooldown.pd.concat = concat
    expect, last = [], None
    for t in sorted(at.tolist()):
        if last is None or t - last >= 60_000_000:
            expect.append(t)
            last = t
    assert sent == expect
    assert max(largest) <= 30_000 and not walker._waiting


def test_failure_between_write_and_commit_loses_and_repeats_nothing(spark, feed, tmp_path):
    """The writer dies after its second batch is on disk; the restart repeats that batch."""
    for i in range(3):
        folder = feed((f"a{i}", i, {}), (f"b{i}", i, {}))
    options = StreamOptions(available_now=True, max_files_per_trigger=1)
    raw = event_tables(stream_records(spark, folder, "text", options), options=options).raw_events
    write = batch_writer("table", str(tmp_path / "out"), RAW_EVENTS)

    def start(dies_at):
        def sink(batch, batch_id):
            write(batch, batch_id)
            if batch_id == dies_at:
                raise RuntimeError("power cut")

        return (
            raw.writeStream.foreachBatch(sink).trigger(availableNow=True)
            .option("checkpointLocation", str(tmp_path / "c")).start()
        )

    with pytest.raises(Exception, match="power cut"):
        start(1).awaitTermination()
    start(None).awaitTermination()
    ids = [r.event_id for r in spark.read.parquet(str(tmp_path / "out" / "events_raw")).collect()]
    assert sorted(ids) == ["a0", "a1", "a2", "b0", "b1", "b2"]


def test_failure_with_the_native_sink(spark, feed, tmp_path):
    """A poisoned record stops the query mid-way; once it reads again, nothing is doubled."""
    for i in range(3):
        folder = feed((f"a{i}", i, {}))
    options = StreamOptions(available_now=True, max_files_per_trigger=1,
                            checkpoints=str(tmp_path / "c"))
    records = stream_records(spark, folder, "text", options)
    poisoned = records.withColumn(
        "value",
        F.when(F.col("value").cast("string").contains('"a1"'),
               F.raise_error(F.lit("poison")).cast("binary")).otherwise(F.col("value")),
    )
    base = str(tmp_path / "out")
    with pytest.raises(Exception, match="poison"):
        finish(start_stream(poisoned, base, options, outputs=("raw_events",)))
    finish(start_stream(records, base, options, outputs=("raw_events",)))
    ids = [r.event_id for r in read_table(spark, base, "events_raw").collect()]
    assert sorted(ids) == ["a0", "a1", "a2"]


@pytest.mark.parametrize("sink", ["parquet", "table"])
def test_restart_with_default_options_loses_nothing(spark, feed, tmp_path, sink):
    folder = feed(*[(f"a{i}", i, {}) for i in range(5)])
    options = StreamOptions(available_now=True)
    run(spark, folder, tmp_path / "out", options, outputs=("raw_events",), sink=sink)
    feed(*[(f"b{i}", i, {}) for i in range(7)])
    run(spark, folder, tmp_path / "out", options, outputs=("raw_events",), sink=sink)
    assert read_table(spark, str(tmp_path / "out"), "events_raw").count() == 12


def test_new_checkpoint_keeps_what_batches_wrote(spark, feed, tmp_path):
    folder = feed(*[(f"a{i}", i, {}) for i in range(5)])
    for n in "cd":
        options = StreamOptions(available_now=True, checkpoints=str(tmp_path / n))
        run(spark, folder, tmp_path / "out", options, outputs=("raw_events",), sink="table")
        folder = feed(*[(f"b{i}", i, {}) for i in range(7)])
        for landed in sorted((tmp_path / "feed").iterdir())[:1]:
            landed.unlink() if n == "c" else None
    assert read_table(spark, str(tmp_path / "out"), "events_raw").count() == 12


def test_append_into_a_streamed_table_is_refused(spark, feed, bus, event, tmp_path):
    run(spark, feed(("1", 0, {})), tmp_path / "out", outputs=("raw_events",))
    raw = event_tables(bus(event(event_id="9"))).raw_events
    with pytest.raises(ValueError, match="belongs to a stream"):
        append_table(raw, str(tmp_path / "out"), RAW_EVENTS)


@pytest.mark.parametrize("squash", [True, False])
def test_late_copy_does_not_hide_the_one_on_time(spark, feed, tmp_path, squash):
    folder = feed(("w1", 3480, {}), ("w2", 3500, {}))
    feed(("w3", 3600, {}))
    feed(("X", 600, {}), ("X", 3630, {}))
    options = StreamOptions(available_now=True, max_files_per_trigger=1, squash_copies=squash)
    run(spark, folder, tmp_path / "out", options, outputs=("raw_events",))
    ids = [r.event_id for r in read_table(spark, str(tmp_path / "out"), "events_raw").collect()]
    assert sorted(ids) == ["X", "w1", "w2", "w3"]


def test_wait_and_stop(spark, feed, tmp_path):
    """When one query dies, the others are stopped and the failure is raised."""
    from tidewatch.streaming.run import wait_and_stop

    records = stream_records(spark, feed(("1", 0, {})), "text")
    options = StreamOptions(trigger="1 second")
    queries = start_stream(records, str(tmp_path / "a"), options, outputs=("raw_events",))
    broken = records.withColumn("value", F.raise_error(F.lit("gone")).cast("binary"))
    queries |= start_stream(broken, str(tmp_path / "b"), options, outputs=("dead_letters",))
    spark.streams.resetTerminated()
    with pytest.raises(Exception, match="gone"):
        wait_and_stop(spark, queries)
    assert not any(q.isActive for q in queries.values())
