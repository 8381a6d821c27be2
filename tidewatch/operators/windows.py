"""Event-time window aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import AGGREGATE_SCHEMA
from ..functions.scores import rounded_mean

# Seconds per interval unit.
_UNIT_SECONDS = {
    "microsecond": 1e-6,
    "millisecond": 1e-3,
    "second": 1,
    "minute": 60,
    "hour": 3600,
    "day": 86400,
    "week": 604800,
}


def interval_seconds(text: str) -> float:
    """Length of an interval such as ``"1 minute"`` or ``"1 hour 30 minutes"``."""
    words = text.split()
    if not words or len(words) % 2:
        raise ValueError(f"not an interval: {text!r}")
    total = 0.0
    for number, unit in zip(words[::2], words[1::2]):
        name = unit.lower().removesuffix("s")
        if name not in _UNIT_SECONDS:
            raise ValueError(f"not an interval: {text!r}")
        total += float(number) * _UNIT_SECONDS[name]
    return total


def aggregate_windows(
    events: DataFrame,
    duration: str = "1 minute",
    slide: str | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Price, volume and change statistics per (window, symbol, exchange).

    Tumbling windows by default, sliding ones when ``slide`` is shorter than
    ``duration``.  Rows are combined before the shuffle, so a hot symbol sends
    one row per window and input partition.
    """
    slide = slide or duration
    if interval_seconds(slide) > interval_seconds(duration):
        raise ValueError(f"slide {slide!r} is longer than the window {duration!r}")
    grouped = events.groupBy(F.window("event_ts", duration, slide), "symbol", "exchange").agg(
        rounded_mean("price", 4).alias("avg_price"),
        F.round(F.max("price"), 4).alias("max_price"),
        F.round(F.min("price"), 4).alias("min_price"),
        F.sum("volume").alias("total_volume"),
        F.count(F.lit(1)).alias("event_count"),
        rounded_mean("change_percent", 4).alias("avg_change_percent"),
    )
    columns = {
        "window_start": F.col("window.start"),
        "window_end": F.col("window.end"),
        "event_date": F.to_date(F.col("window.start")),
        "processing_time": F.current_timestamp() if as_of is None else as_of,
    }
    return grouped.select(
        *[columns.get(f.name, F.col(f.name)).alias(f.name) for f in AGGREGATE_SCHEMA]
    )
