"""Holding back repeated alerts in a stream."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..contracts import ALERT_SCHEMA
from ..plans.alerts import known_severity

_OUT = "at_micros long, title string, severity string, message string"


#: Rows of a title's micro-batch that are walked in memory; more wait in the state.
KEEP_ROWS = 100_000


class _Cooldown(StatefulProcessor):
    """Per title, the time an alert was last sent; during a batch, alerts that wait.

    Chunks of a micro-batch come in any order, but alerts are taken in order of time.
    Up to ``keep`` rows are sorted in memory.  Beyond that they are put away in map
    state, by spans of one cool-down and as chunks of Arrow bytes.  At most one alert of
    a span can go out, the first from the time on when the title is free.  So spans are
    walked in order and read chunk by chunk, keeping one row: memory is ``keep`` rows and
    a chunk, however many alerts a title has in the batch.
    """

    def __init__(self, cooldown: int, keep: int = KEEP_ROWS) -> None:
        self._cooldown = cooldown
        self._keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getValueState("last_sent", "micros long")
        self._waiting = handle.getMapState("waiting", "span long, chunk int", "rows binary")

    def handleInputRows(  # noqa: N802 - Spark's name
        self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any  # noqa: N803
    ) -> Iterator[pd.DataFrame]:
        free = self._last.get()[0] + self._cooldown if self._last.exists() else None
        held, n, chunks = [], 0, {}
        for alerts in rows:
            if free is not None:
                alerts = alerts[alerts["at_micros"] >= free]
            if not len(alerts):
                continue
            held.append(alerts)
            n += len(alerts)
            if n > self._keep:
                self._put_away(pd.concat(held, ignore_index=True), chunks)
                held, n = [], 0
        if chunks and held:
            self._put_away(pd.concat(held, ignore_index=True), chunks)
            held = []
        sent = self._from_state(chunks, free) if chunks else self._from_memory(held, free)
        for alerts in sent:
            self._last.update((int(alerts["at_micros"].iloc[-1]),))
            yield alerts

    def _from_memory(self, held: list[pd.DataFrame], free: int | None) -> Iterator[pd.DataFrame]:
        if not held:
            return
        alerts = pd.concat(held, ignore_index=True)
        alerts = alerts.sort_values(_ORDER, ignore_index=True)
        at = alerts["at_micros"].to_numpy()
        i = 0 if free is None else int(np.searchsorted(at, free))
        sent = []
        while i < len(at):
            sent.append(i)
            i = int(np.searchsorted(at, at[i] + self._cooldown))
        if sent:
            yield alerts.iloc[sent]

    def _put_away(self, alerts: pd.DataFrame, chunks: dict[int, int]) -> None:
        """Store rows by span; of one instant only the alert that could go out."""
        alerts = alerts.sort_values(_ORDER).drop_duplicates("at_micros")
        for span, part in alerts.groupby(alerts["at_micros"] // self._cooldown):
            chunk = chunks.get(span, 0)
            chunks[span] = chunk + 1
            self._waiting.updateValue((int(span), chunk), (_to_bytes(part),))

    def _from_state(self, chunks: dict[int, int], free: int | None) -> Iterator[pd.DataFrame]:
        for span in sorted(chunks):
            best = None
            if free is None or free < (span + 1) * self._cooldown:
                for chunk in range(chunks[span]):
                    rows = _from_bytes(self._waiting.getValue((int(span), chunk))[0])
                    if free is not None:
                        rows = rows[rows["at_micros"] >= free]
                    # each chunk is sorted; one row of it can be the span's
                    if len(rows):
                        first = rows.iloc[:1]
                        both = first if best is None else pd.concat([best, first])
                        best = both.sort_values(_ORDER).iloc[:1]
            if best is not None:
                free = int(best["at_micros"].iloc[0]) + self._cooldown
                yield best
        self._waiting.clear()

    def close(self) -> None:
        pass


_ORDER = ["at_micros", "severity", "message"]


def _to_bytes(rows: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(rows, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _from_bytes(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_all().to_pandas()


def cooled_down_stream(
    alerts: DataFrame, cooldown_seconds: float = 60.0, keep_rows: int = KEEP_ROWS
) -> DataFrame:
    """The alerts of a stream that go out: one per title, then none until the cool-down passed.

    Alerts are taken in order of time within a micro-batch; one older than the
    last sent is held back.  ``keep_rows`` alerts of a title are held in memory at
    once.  Needs the RocksDB state store.
    """
    severity = known_severity(F.col("severity")).alias("severity")
    keyed = alerts.select(F.unix_micros("at").alias("at_micros"), "title", severity, "message")
    sent = keyed.groupBy("title").transformWithStateInPandas(
        statefulProcessor=_Cooldown(int(cooldown_seconds * 1_000_000), keep_rows),
        outputStructType=_OUT,
        outputMode="Append",
        timeMode="None",
    )
    at = F.timestamp_micros("at_micros").alias("at")
    return sent.select(at, *[f for f in ALERT_SCHEMA.fieldNames() if f != "at"])
