"""Progress and endings of streaming queries as tables that survive the driver.

A listener sees a batch's figures once, in the driver's memory.  What a batch was and
when it was committed also stands in its query's checkpoint.  `record_progress` appends
the listener's rows to the metrics table, and for every committed batch that neither
brought a row nor has one there, a row rebuilt from the offset and commit logs.  So a
driver that died between two calls, or a listener that had to forget, loses no batch.

Spark keeps the logs of the last ``spark.sql.streaming.minBatchesToRetain`` batches
(100): call it at least as often as that.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..contracts import ALERT_SCHEMA, METRICS_SCHEMA
from ..plans.alerts import termination_alerts
from ..sources.compacted import exists, path_of
from .listener import ENDINGS, ProgressListener

METRICS, ALERTS, STOP = "_metrics", "_alerts", "_stop"

_LISTENERS: dict[tuple, ProgressListener] = {}


def watch(spark: SparkSession) -> ProgressListener:
    """The session's listener, registered by the first call."""
    key = (spark.sparkContext.applicationId, spark._jsparkSession.hashCode())
    if key not in _LISTENERS:
        _LISTENERS[key] = ProgressListener()
        spark.streams.addListener(_LISTENERS[key])
    return _LISTENERS[key]


def query_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id a query keeps over restarts, from its checkpoint."""
    path = f"{checkpoint}/metadata"
    return json.loads(spark.read.text(path).first()[0])["id"] if exists(spark, path) else None


def checkpoints_below(spark: SparkSession, folder: str) -> dict[str, str]:
    """``{query name: checkpoint}`` of a folder with a checkpoint per query."""
    if not exists(spark, folder):
        return {}
    place, system = path_of(spark, folder)
    names = [s.getPath().getName() for s in system.listStatus(place) if s.isDirectory()]
    return {n: f"{folder}/{n}" for n in sorted(names) if exists(spark, f"{folder}/{n}/metadata")}


def logged_batches(spark: SparkSession, checkpoints: dict[str, str]) -> DataFrame:
    """A metrics row for every committed batch whose logs are still there.

    ``checkpoints`` name the checkpoint of each query; the folders have different names.
    ``at`` is when the batch was planned and ``batch_ms`` how long it then took to its
    commit.  Rows read are known for Kafka, whose offsets count them; figures that no
    log has are NULL.
    """
    known = {
        path.rpartition("/")[2]: (name, query_id(spark, path))
        for name, path in checkpoints.items()
        if exists(spark, f"{path}/commits") and exists(spark, f"{path}/metadata")
    }
    if not known:
        return spark.createDataFrame([], METRICS_SCHEMA)
    logs = [f"{p}/{kind}" for p in checkpoints.values() for kind in ("offsets", "commits")
            if p.rpartition("/")[2] in known]
    place = F.regexp_extract("path", "([^/]+)/(offsets|commits)/([0-9]+)$", 0)
    files = spark.read.text(logs, wholetext=True).select(
        F.split("value", "\n").alias("lines"),
        F.col("_metadata.file_modification_time").alias("written"),
        F.col("_metadata.file_path").alias("path"),
    )
    files = files.withColumn("place", F.split(place, "/")).where("size(place) = 3").select(
        F.col("place")[0].alias("folder"),
        F.col("place")[2].cast("long").alias("batch_id"),
        (F.col("place")[1] == "offsets").alias("planned"),
        "lines",
        "written",
    )
    planned_ms = F.get_json_object(F.col("lines")[1], "$.batchTimestampMs").cast("long")
    batches = files.groupBy("folder", "batch_id").agg(
        F.max(F.when(F.col("planned"), planned_ms)).alias("planned_ms"),
        F.max(F.when(F.col("planned"), _bus_offsets(F.col("lines")))).alias("offsets"),
        F.max(F.when(~F.col("planned"), F.col("written"))).alias("committed"),
    )
    # a batch or a hundred of each query
    before = F.lag("offsets").over(Window.partitionBy("folder").orderBy("batch_id"))
    names = spark.createDataFrame([(f, *k) for f, k in known.items()], "folder string, query string, query_id string")
    rows = batches.withColumn("read", F.col("offsets") - before).join(F.broadcast(names), "folder")
    took = F.unix_millis("committed") - F.col("planned_ms")
    figures = {
        "query": F.col("query"),
        "batch_id": F.col("batch_id"),
        "at": F.timestamp_millis("planned_ms"),
        "num_input_rows": F.col("read"),
        "batch_ms": F.greatest(took, F.lit(0)).cast("double"),
        "query_id": F.col("query_id"),
    }
    return rows.where("committed IS NOT NULL AND planned_ms IS NOT NULL").select(
        *(figures.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in METRICS_SCHEMA)
    )


def _bus_offsets(lines):
    """The sum of all next offsets of Kafka sources; NULL for any other source."""
    parsed = F.transform(
        F.slice(lines, 3, F.greatest(F.size(lines) - 2, F.lit(0))),
        lambda line: F.from_json(line, "map<string, map<string, bigint>>"),
    )
    counted = F.transform(
        parsed,
        lambda topics: F.aggregate(
            F.flatten(F.transform(F.map_values(topics), lambda t: F.map_values(t))),
            F.lit(0).cast("long"),
            lambda a, n: a + n,
        ),
    )
    total = F.aggregate(counted, F.lit(0).cast("long"), lambda a, n: a + n)
    return F.when(F.size(counted) > 0, total)


def record_progress(
    spark: SparkSession, path: str, checkpoints: dict[str, str], listener: ProgressListener | None = None
) -> int:
    """Append what the table of metrics at ``path`` lacks; the number of rows appended.

    ``checkpoints`` name the queries that belong to the table.  Batches are told apart
    by (query id, batch id), so repeating the call, also after a failure, adds nothing.
    """
    ids = {query_id(spark, c): q for q, c in checkpoints.items()}
    ids.pop(None, None)
    if not ids:
        return 0
    seen = listener.take(set(ids)) if listener else []
    live = spark.createDataFrame(seen, METRICS_SCHEMA).dropDuplicates(["query_id", "batch_id"])
    rebuilt = logged_batches(spark, {q: checkpoints[q] for q in ids.values()})
    key = ["query_id", "batch_id"]
    new = live.unionByName(rebuilt.join(live.select(*key), key, "left_anti").select(*live.columns))
    if exists(spark, path):
        there = spark.read.schema(METRICS_SCHEMA).parquet(path).where(F.col("query_id").isin(*ids))
        new = new.join(there.select(*key), key, "left_anti").select(*live.columns)
    rows = new.collect()  # of the batches since the last call: bounded by the logs Spark retains
    if rows:
        spark.createDataFrame(rows, METRICS_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return len(rows)


def read_progress(spark: SparkSession, base: str) -> DataFrame:
    """The metrics table below ``base``, one row per (query id, batch id)."""
    metrics = spark.read.schema(METRICS_SCHEMA).parquet(f"{base}/{METRICS}")
    return metrics.dropDuplicates(["query_id", "batch_id"])


def record_endings(spark: SparkSession, base: str, queries: dict[str, StreamingQuery]) -> DataFrame:
    """Write an alert for every query that ended with an exception; the alerts written.

    The message names the query by its name; the exceptions are those the queries
    themselves report, so nothing waits for a listener's events.
    """
    now = datetime.now(timezone.utc)
    ended = [(n, now, str(q.exception())) for n, q in queries.items() if not q.isActive and q.exception()]
    alerts = termination_alerts(spark.createDataFrame(ended, ENDINGS))
    if ended:
        alerts.coalesce(1).write.mode("append").parquet(f"{base}/{ALERTS}")
    return alerts


def read_alerts(spark: SparkSession, base: str) -> DataFrame:
    """The alert rows that jobs below ``base`` have written."""
    if not exists(spark, f"{base}/{ALERTS}"):
        return spark.createDataFrame([], ALERT_SCHEMA)
    return spark.read.schema(ALERT_SCHEMA).parquet(f"{base}/{ALERTS}")


def request_stop(spark: SparkSession, base: str) -> None:
    """Ask the job that writes below ``base`` to stop after the batches it is in."""
    place, system = path_of(spark, f"{base}/{STOP}")
    system.create(place).close()


def stop_requested(spark: SparkSession, base: str) -> bool:
    return exists(spark, f"{base}/{STOP}")


def clear_stop(spark: SparkSession, base: str) -> None:
    place, system = path_of(spark, f"{base}/{STOP}")
    system.delete(place, False)
