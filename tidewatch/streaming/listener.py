"""Streaming progress as rows."""

from __future__ import annotations

from collections import deque
from datetime import datetime
from time import monotonic, sleep

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from ..contracts import METRICS_SCHEMA

ENDINGS = "query_id string, at timestamp, exception string"


class ProgressListener(StreamingQueryListener):
    """Collects one small row per micro-batch until they are flushed.

    Register it with ``spark.streams.addListener`` before starting queries, or get
    the session's own from `progress.watch`.  If nobody flushes, the newest ``keep``
    rows are held and older ones forgotten; `progress.record_progress` rebuilds those.
    """

    def __init__(self, keep: int = 100_000) -> None:
        self._batches: deque[tuple] = deque(maxlen=keep)
        self._endings: deque[tuple] = deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's name
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802 - Spark's name
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802 - Spark's name
        p = event.progress
        operators = p.stateOperators or []
        self._batches.append(
            (
                p.name or "unnamed",
                str(p.runId),
                int(p.batchId),
                datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")),
                int(p.numInputRows or 0),
                float(p.inputRowsPerSecond or 0.0),
                float(p.processedRowsPerSecond or 0.0),
                float((p.durationMs or {}).get("triggerExecution", 0)),
                sum(int(o.numRowsDroppedByWatermark) for o in operators),
                sum(int(o.numRowsTotal) for o in operators),
                str(p.id),
            )
        )

    def onQueryTerminated(self, event) -> None:  # noqa: N802 - Spark's name
        self._endings.append((str(event.id), datetime.now().astimezone(), event.exception))

    def wait_for_endings(self, query_ids: set[str], seconds: float = 60.0) -> bool:
        """Wait until these queries reported their end; events arrive with a delay, also
        those of queries that ended before the listener was registered."""
        limit = monotonic() + seconds
        while not (done := query_ids <= {e[0] for e in self._endings}) and monotonic() < limit:
            sleep(0.05)
        return done

    def take(self, query_ids: set[str]) -> list[tuple]:
        """The rows of these queries, which are then forgotten; others stay."""
        rows = [self._batches.popleft() for _ in range(len(self._batches))]
        self._batches.extend(r for r in rows if r[-1] not in query_ids)
        return [r for r in rows if r[-1] in query_ids]

    def metrics(self, spark: SparkSession) -> DataFrame:
        """The batches seen since the last flush."""
        return spark.createDataFrame(list(self._batches), METRICS_SCHEMA)

    def terminations(self, spark: SparkSession) -> DataFrame:
        """The queries that ended, with their exception if any."""
        return spark.createDataFrame(list(self._endings), ENDINGS)

    def flush(self, spark: SparkSession, path: str) -> int:
        """Append the collected batches to a metrics table and forget them."""
        rows = [self._batches.popleft() for _ in range(len(self._batches))]
        if rows:
            spark.createDataFrame(rows, METRICS_SCHEMA).coalesce(1).write.mode("append").parquet(
                path
            )
        return len(rows)
