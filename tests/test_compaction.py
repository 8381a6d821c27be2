import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.contracts import AGGREGATES, DEAD_LETTERS, RAW_EVENTS
from tidewatch.plans.batch import event_tables
from tidewatch.settings import StreamOptions
from tidewatch.sinks import compaction
from tidewatch.sinks.compaction import compact, consumed, retire, vacuum
from tidewatch.sources.compacted import read_manifest
from tidewatch.sources.records import read_table, stream_records
from tidewatch.streaming.run import finish, start_stream
from tidewatch.streaming.staged import TAGGED, compact_staged, run_staged

DAY = 86_400


def ids(df):
    return sorted(r.event_id for r in df.select("event_id").collect())


def files(folder):
    return sorted(p for p in folder.rglob("*.parquet"))


@pytest.fixture
def streamed(spark, feed, tmp_path):
    """Raw events of three days, in six batches."""
    for i in range(6):
        folder = feed(*((f"{i}-{k}", i // 2 * DAY + i * 60 + k, {}) for k in range(5)))
    options = StreamOptions(available_now=True, max_files_per_trigger=1)
    base = str(tmp_path / "out")

    def more():
        stream = stream_records(spark, folder, "text", options)
        finish(start_stream(stream, base, options, outputs=("raw_events",)))

    more()
    return base, more


def test_closed_dates_are_compacted(spark, streamed, tmp_path):
    base, _ = streamed
    before = ids(read_table(spark, base, "events_raw"))
    assert len(before) == 30
    assert compact(spark, base, RAW_EVENTS, "2026-06-27") == ["2026-06-25", "2026-06-26"]
    assert ids(read_table(spark, base, "events_raw")) == before
    dates = read_manifest(spark, base, RAW_EVENTS)
    (generation,) = {d["folder"] for d in dates.values()}
    written = tmp_path / "out" / "_compaction" / "events_raw" / generation
    for date in ("2026-06-25", "2026-06-26"):
        assert len(files(written / f"event_date={date}")) == 1
    assert compact(spark, base, RAW_EVENTS, "2026-06-27") == []
    count = len(files(tmp_path / "out" / "events_raw"))
    gone = vacuum(spark, base, RAW_EVENTS, [])
    assert gone > 0 and len(files(tmp_path / "out" / "events_raw")) == count - gone
    assert ids(read_table(spark, base, "events_raw")) == before
    day = read_table(spark, base, "events_raw").where("event_date = '2026-06-25'")
    assert day.count() == 10


def test_many_rows_of_a_date_are_bounded_files(spark, bus, event, tmp_path):
    raw = event_tables(bus(*(event(event_id=str(i)) for i in range(200)))).raw_events
    for part in raw.randomSplit([1.0] * 10, 1):
        part.write.mode("append").partitionBy("event_date").parquet(f"{tmp_path}/events_raw")
    compact(spark, str(tmp_path), RAW_EVENTS, "2027-01-01", file_rows=50)
    assert 1 < len(files(tmp_path / "_compaction")) - 1 <= 200 / 50 + 1  # one file lists names
    vacuum(spark, str(tmp_path), RAW_EVENTS, [])
    assert len(files(tmp_path / "events_raw")) == 0
    raw.limit(3).write.mode("append").partitionBy("event_date").parquet(f"{tmp_path}/events_raw")
    assert read_table(spark, str(tmp_path), "events_raw").count() == 203
    compact(spark, str(tmp_path), RAW_EVENTS, "2027-01-01")
    vacuum(spark, str(tmp_path), RAW_EVENTS, [])
    assert read_table(spark, str(tmp_path), "events_raw").count() == 203


def test_rows_of_a_compacted_date_that_come_later_count(spark, streamed, bus, event, tmp_path):
    base, more = streamed
    compact(spark, base, RAW_EVENTS, "2026-06-28")
    vacuum(spark, base, RAW_EVENTS, [])
    # a batch with rows of a compacted date, as a stream without deduplication writes it
    late = event_tables(bus(event(event_id="late"))).raw_events
    (tmp_path / "late").mkdir()
    late.write.parquet(f"{tmp_path}/late/rows")
    stream = spark.readStream.schema(late.schema).parquet(f"{tmp_path}/late/rows")
    query = stream.writeStream.format("parquet").partitionBy("event_date").trigger(availableNow=True)
    # the sink's log goes on from the batches it has
    query.option("checkpointLocation", f"{tmp_path}/late/checkpoint").option("path", f"{base}/x").start().awaitTermination()
    (file,) = files(tmp_path / "out" / "x")
    target = tmp_path / "out" / "events_raw" / file.parent.name
    target.mkdir(exist_ok=True)
    file.rename(target / file.name)
    log = tmp_path / "out" / "events_raw" / "_spark_metadata"
    entry = (tmp_path / "out" / "x" / "_spark_metadata" / "0").read_text().replace("/x/", "/events_raw/")
    (log / str(max(int(p.name) for p in log.iterdir() if p.name.isdigit()) + 1)).write_text(entry)
    assert len(ids(read_table(spark, base, "events_raw"))) == 31
    assert len(compact(spark, base, RAW_EVENTS, "2026-06-28")) == 1
    vacuum(spark, base, RAW_EVENTS, [])
    assert len(ids(read_table(spark, base, "events_raw"))) == 31


def test_failure_between_write_and_swap_changes_nothing(spark, streamed, tmp_path, monkeypatch):
    base, _ = streamed
    before = ids(read_table(spark, base, "events_raw"))

    def power_cut(*args):
        raise RuntimeError("power cut")

    with monkeypatch.context() as m:
        m.setattr(compaction, "swap_manifest", power_cut)
        with pytest.raises(RuntimeError, match="power cut"):
            compact(spark, base, RAW_EVENTS, "2026-06-28")
    assert read_manifest(spark, base, RAW_EVENTS) == {}
    assert ids(read_table(spark, base, "events_raw")) == before
    assert len(compact(spark, base, RAW_EVENTS, "2026-06-28")) == 3
    vacuum(spark, base, RAW_EVENTS, [])
    left = [p.name for p in (tmp_path / "out" / "_compaction" / "events_raw").glob("generation-*")]
    assert len(left) == 2  # the generation in use and its list of names
    assert ids(read_table(spark, base, "events_raw")) == before


def test_staged_job_with_compaction_equals_batch(spark, feed, bus, tmp_path):
    """Runs, compaction and retention in turn; every stage goes on where it was."""
    base = str(tmp_path / "out")
    options = StreamOptions(max_files_per_trigger=1)
    for day in range(3):
        rows = [(f"{day}-{k}", day * DAY + k, {"price": -1.0} if k == 3 else {}) for k in range(8)]
        folder = feed(*rows, rows[0])
        run_staged(stream_records(spark, folder, "text", options), base, options)
        compact_staged(spark, base, (dt.date(2026, 6, 25) + dt.timedelta(day)).isoformat())
    feed(("end", 9 * DAY, {"symbol": "END"}))
    run_staged(stream_records(spark, folder, "text", options), base, options)
    done = compact_staged(spark, base, "2026-07-01")
    assert done["events_raw"] == ["2026-06-27"] and len(done["events_aggregates_1m"]) >= 1
    assert files(tmp_path / "out" / TAGGED) == []
    raw = read_table(spark, base, "events_raw").where("symbol <> 'END'")
    assert ids(raw) == sorted(f"{d}-{k}" for d in range(3) for k in range(8) if k != 3)
    windows = read_table(spark, base, "events_aggregates_1m")
    assert windows.agg(F.sum("event_count")).first()[0] == 21
    assert read_table(spark, base, "dead_letter_events").count() == 3
    assert {AGGREGATES.name, DEAD_LETTERS.name} <= set(done)


def test_retention_waits_for_the_slowest_reader(spark, tmp_path):
    for k in range(3):
        spark.range(k, k + 1).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def read(name, batches):
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        query = stream.writeStream.option("checkpointLocation", f"{tmp_path}/{name}")

        def stop_after(_, batch_id):
            if batch_id == batches:
                raise RuntimeError("stopped")

        query = query.foreachBatch(stop_after).trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        except Exception as stopped:
            assert "stopped" in str(stopped)

    read("fast", 99)
    read("slow", 2)  # fails in its third batch: two are committed
    readers = [f"{tmp_path}/fast", f"{tmp_path}/slow"]
    assert [consumed(spark, r).count() for r in readers] == [3, 2]
    assert retire(spark, f"{tmp_path}/in", [*readers, f"{tmp_path}/not-begun"]) == 0
    assert retire(spark, f"{tmp_path}/in", readers) == 2
    assert len(files(tmp_path / "in")) == 1
    read("slow", 99)
    assert retire(spark, f"{tmp_path}/in", readers) == 1


def test_tables_are_there_before_the_first_batch(spark, feed, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS landing")
    base, options = str(tmp_path / "out"), StreamOptions(database="landing", available_now=True)
    run_staged(stream_records(spark, feed(("1", 0, {})), "text"), base, options)
    for layout in (RAW_EVENTS, AGGREGATES, DEAD_LETTERS):
        assert spark.catalog.tableExists(f"landing.{layout.name}")
    spark.sql("MSCK REPAIR TABLE landing.events_raw")
    assert ids(spark.table("landing.events_raw")) == ["1"]
    spark.sql("DROP DATABASE landing CASCADE")
