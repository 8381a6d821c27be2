import threading
import time

import pytest
from pyspark.sql import functions as F

from tidewatch.contracts import AlertThresholds
from tidewatch.plans.alerts import lag_alerts
from tidewatch.settings import StreamOptions
from tidewatch.sources.compacted import exists
from tidewatch.sources.records import stream_records
from tidewatch.streaming import progress
from tidewatch.streaming.progress import (
    logged_batches,
    read_alerts,
    read_progress,
    request_stop,
    stop_requested,
    watch,
)
from tidewatch.streaming.run import finish, keep_progress, start_stream, wait_and_stop
from tidewatch.streaming.staged import run_staged

ONCE = StreamOptions(available_now=True, max_files_per_trigger=1)


def drain(spark):
    """The listener's events arrive with a delay; then it forgets them, as with its driver."""
    time.sleep(2)
    watch(spark)._batches.clear()


def batches(df):
    return sorted((r["query"], r.batch_id) for r in df.collect())


def test_a_driver_lost_between_two_flushes_loses_no_batch(spark, feed, tmp_path):
    base = str(tmp_path / "out")
    outputs = ("raw_events", "dead_letters")

    def run(base=base):
        stream = stream_records(spark, folder, "text", ONCE)
        queries = start_stream(stream, base, ONCE, outputs=outputs)
        for query in queries.values():
            query.awaitTermination()

    folder = feed(("1", 0, {}), ("2", 5, {}))
    run()
    time.sleep(2)
    keep_progress(spark, base)
    seen = read_progress(spark, base).where("num_input_rows = 2")
    assert batches(seen) == [("dead_letters", 0), ("raw_events", 0)]
    for k in range(3):
        feed((f"a{k}", 10 + k, {}))
    run()
    drain(spark)  # killed: nothing was flushed
    feed(("z", 60, {}))
    run()  # starting again records what the logs know
    time.sleep(2)
    keep_progress(spark, base)
    metrics = read_progress(spark, base)
    got = batches(metrics)
    for query in outputs:
        logs = batches(logged_batches(spark, {query: f"{base}/_checkpoints/{query}"}))
        assert [b for b in got if b[0] == query] == logs
        assert {("dead_letters", k) for k in range(5)} <= set(got)
    assert metrics.where("at IS NULL OR batch_ms IS NULL OR query_id IS NULL").count() == 0
    assert keep_progress(spark, base) == 0 and batches(read_progress(spark, base)) == got
    slow = lag_alerts(metrics, AlertThresholds(max_batch_seconds=-1.0))
    assert slow.count() == len(got)


def test_failure_while_recording_repeats_nothing(spark, feed, tmp_path, monkeypatch):
    base = str(tmp_path / "out")
    stream = stream_records(spark, feed(("1", 0, {})), "text", ONCE)
    finish(start_stream(stream, base, ONCE, outputs=("dead_letters",)))
    time.sleep(2)
    with monkeypatch.context() as m:
        m.setattr(progress, "exists", lambda *_: (_ for _ in ()).throw(RuntimeError("power cut")))
        with pytest.raises(RuntimeError, match="power cut"):
            progress.record_progress(spark, f"{base}/m", {"q": f"{base}/_checkpoints/dead_letters"})
    first = keep_progress(spark, base)
    assert first >= 1 and keep_progress(spark, base) == 0


def test_kafka_offsets_count_rows(spark, tmp_path):
    for kind in ("offsets", "commits"):
        (tmp_path / kind).mkdir()
    for n, (a, b) in enumerate([(5, 5), (12, 6), (12, 6)]):
        head = 'v1\n{"batchWatermarkMs":0,"batchTimestampMs":1767225600000}\n'
        (tmp_path / "offsets" / str(n)).write_text(head + f'{{"events":{{"0":{a},"1":{b}}}}}')
        (tmp_path / "commits" / str(n)).write_text('v1\n{"nextBatchWatermarkMs":0}')
    (tmp_path / "offsets" / "3").write_text(head + '{"events":{"0":99,"1":9}}')
    (tmp_path / "metadata").write_text('{"id":"abc"}')
    rows = logged_batches(spark, {"q": str(tmp_path)}).orderBy("batch_id").collect()
    assert [(r.batch_id, r.num_input_rows, r.query_id) for r in rows] == [(0, None, "abc"), (1, 8, "abc"), (2, 0, "abc")]


def test_staged_job_records_all_stages(spark, feed, tmp_path):
    base = str(tmp_path / "out")
    run_staged(stream_records(spark, feed(("1", 0, {}), ("2", 1, {"price": -1.0})), "text"), base)
    names = {r["query"] for r in read_progress(spark, base).collect()}
    assert names == {"judge", "staged_raw", "staged_letters", "staged_bus", "staged_windows"}


def test_one_of_two_queries_fails(spark, feed, tmp_path):
    base = str(tmp_path / "out")
    records = stream_records(spark, feed(("1", 0, {})), "text", ONCE)
    queries = start_stream(records, base, ONCE, outputs=("dead_letters",))
    broken = records.withColumn("value", F.raise_error(F.lit("disk on fire")).cast("binary"))
    queries |= start_stream(broken, base, ONCE, outputs=("raw_events",))
    with pytest.raises(Exception, match="disk on fire"):
        finish(queries, base, ONCE)
    (alert,) = read_alerts(spark, base).collect()
    assert (alert.title, alert.severity) == ("Streaming query terminated", "critical")
    assert "raw_events" in alert.message and "disk on fire" in alert.message
    assert batches(read_progress(spark, base)) == [("dead_letters", 0)]


def test_a_stop_is_asked_for_by_a_marker(spark, feed, tmp_path):
    base = str(tmp_path / "out")
    options = StreamOptions(trigger="1 second")
    queries = start_stream(stream_records(spark, feed(("1", 0, {})), "text"), base, options, outputs=("raw_events",))
    spark.streams.resetTerminated()
    threading.Timer(4, lambda: request_stop(spark, base)).start()
    wait_and_stop(spark, queries, base, options, every=1)
    assert not any(q.isActive for q in queries.values()) and stop_requested(spark, base)
    assert read_alerts(spark, base).count() == 0
    assert ("raw_events", 0) in batches(read_progress(spark, base))
    stream = stream_records(spark, feed(("2", 9, {})), "text", ONCE)
    finish(start_stream(stream, base, ONCE, outputs=("raw_events",)), base, ONCE)
    assert not exists(spark, f"{base}/_stop")
