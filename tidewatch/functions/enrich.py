"""Derived event columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import NO_BAND, PRICE_BANDS, RAW_EVENT_SCHEMA, TOP_BAND


def price_band(price: Column) -> Column:
    """The price's band; NULL and negative prices have none, NaN ranks highest."""
    band = F.when(price >= PRICE_BANDS[-1][1], TOP_BAND)
    for low, high, label in PRICE_BANDS:
        band = band.when((price >= low) & (price < high), label)
    return band.otherwise(NO_BAND)


def enrich_events(events: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Add calendar parts of the event time, the price band and the processing time."""
    ts = F.col("event_ts")
    return events.withColumns(
        {
            "event_date": F.to_date(ts),
            "event_hour": F.hour(ts),
            "event_day": F.dayofmonth(ts),
            "event_month": F.month(ts),
            "event_year": F.year(ts),
            "price_bucket": price_band(F.col("price")),
            "processing_time": F.current_timestamp() if as_of is None else as_of,
        }
    )


def raw_event_columns(enriched: DataFrame) -> DataFrame:
    """Exactly the columns of the raw-events table, in its order and types."""
    source = {"event_timestamp": "event_ts"}
    return enriched.select(
        *[
            F.col(source.get(f.name, f.name)).cast(f.dataType).alias(f.name)
            for f in RAW_EVENT_SCHEMA
        ]
    )
