"""The data contracts: event schemas, table layouts and the values they fix.

Fixed values, which producers and readers rely on: the names and types of all
columns, the bounds of the rules, the price bands, the instruments, and the
limits of the alerts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The JSON object on the wire.  All fields may be NULL: judging is the rules' work.
WIRE_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("company", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("change", T.DoubleType()),
        T.StructField("change_percent", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("exchange", T.StringType()),
    ]
)
WIRE_FIELDS = WIRE_SCHEMA.fieldNames()

# A bus record, whether it arrives from Kafka or from files.
KAFKA_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

RAW_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("company", T.StringType()),
        T.StructField("price", T.DoubleType(), False),
        T.StructField("volume", T.LongType()),
        T.StructField("change", T.DoubleType()),
        T.StructField("change_percent", T.DoubleType()),
        T.StructField("event_timestamp", T.TimestampType(), False),
        T.StructField("exchange", T.StringType()),
        T.StructField("event_date", T.DateType(), False),
        T.StructField("event_hour", T.LongType()),
        T.StructField("event_day", T.LongType()),
        T.StructField("event_month", T.LongType()),
        T.StructField("event_year", T.LongType()),
        T.StructField("price_bucket", T.StringType()),
        T.StructField("processing_time", T.TimestampType(), False),
    ]
)

AGGREGATE_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampType(), False),
        T.StructField("window_end", T.TimestampType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("exchange", T.StringType()),
        T.StructField("avg_price", T.DoubleType()),
        T.StructField("max_price", T.DoubleType()),
        T.StructField("min_price", T.DoubleType()),
        T.StructField("total_volume", T.LongType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("avg_change_percent", T.DoubleType()),
        T.StructField("event_date", T.DateType(), False),
        T.StructField("processing_time", T.TimestampType(), False),
    ]
)

DEAD_LETTER_SCHEMA = T.StructType(
    [
        T.StructField("original_message", T.StringType()),
        T.StructField("error_reason", T.StringType(), False),
        T.StructField("processing_timestamp", T.TimestampType(), False),
        T.StructField("pipeline_name", T.StringType(), False),
        T.StructField("event_date", T.DateType(), False),
    ]
)

INSTRUMENT_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType(), False),
        T.StructField("company", T.StringType()),
        T.StructField("exchange", T.StringType()),
    ]
)

# Progress of one micro-batch, as the listener records it.
METRICS_SCHEMA = T.StructType(
    [
        T.StructField("query", T.StringType(), False),
        T.StructField("run_id", T.StringType()),
        T.StructField("batch_id", T.LongType(), False),
        T.StructField("at", T.TimestampType(), False),
        T.StructField("num_input_rows", T.LongType()),
        T.StructField("input_rows_per_second", T.DoubleType()),
        T.StructField("processed_rows_per_second", T.DoubleType()),
        T.StructField("batch_ms", T.DoubleType()),
        T.StructField("rows_dropped_late", T.LongType()),
        T.StructField("state_rows", T.LongType()),
        T.StructField("query_id", T.StringType()),
    ]
)

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("at", T.TimestampType()),
        T.StructField("title", T.StringType(), False),
        T.StructField("severity", T.StringType(), False),
        T.StructField("message", T.StringType()),
    ]
)


@dataclass(frozen=True)
class TableLayout:
    """Where a table lives, how rows are clustered, what keeps a hot value splittable."""

    name: str
    schema: T.StructType
    cluster_by: tuple[str, ...]
    spread_by: tuple[str, ...] = ()
    partition_by: str = "event_date"


RAW_EVENTS = TableLayout("events_raw", RAW_EVENT_SCHEMA, ("symbol", "exchange"), ("event_id",))
AGGREGATES = TableLayout(
    "events_aggregates_1m", AGGREGATE_SCHEMA, ("symbol", "exchange"), ("window_start",)
)
DEAD_LETTERS = TableLayout("dead_letter_events", DEAD_LETTER_SCHEMA, ("pipeline_name",))
TABLES = {t.name: t for t in (RAW_EVENTS, AGGREGATES, DEAD_LETTERS)}

# The price bands, low bound included, high bound excluded.
PRICE_BANDS = (
    (0.0, 50.0, "0-50"),
    (50.0, 100.0, "50-100"),
    (100.0, 250.0, "100-250"),
    (250.0, 500.0, "250-500"),
    (500.0, 1000.0, "500-1000"),
)
TOP_BAND = "1000+"
NO_BAND = "unknown"

# The instrument reference data (symbol, company, exchange).
INSTRUMENTS = (
    ("AAPL", "Apple Inc.", "NASDAQ"),
    ("MSFT", "Microsoft Corporation", "NASDAQ"),
    ("GOOGL", "Alphabet Inc.", "NASDAQ"),
    ("AMZN", "Amazon.com Inc.", "NASDAQ"),
    ("TSLA", "Tesla Inc.", "NASDAQ"),
    ("NVDA", "NVIDIA Corporation", "NASDAQ"),
    ("META", "Meta Platforms Inc.", "NASDAQ"),
    ("JPM", "JPMorgan Chase & Co.", "NYSE"),
    ("V", "Visa Inc.", "NYSE"),
    ("WMT", "Walmart Inc.", "NYSE"),
)


@dataclass(frozen=True)
class RuleBounds:
    """The limits the validation rules check against."""

    required: tuple[str, ...] = ("event_id", "symbol", "price", "volume", "timestamp")
    price_min: float = 0.0
    price_max: float = 1_000_000.0
    volume_min: int = 0
    change_percent_min: float = -100.0
    change_percent_max: float = 1_000.0
    max_skew_seconds: int = 300
    freshness_seconds: int = 86_400
    exchanges: tuple[str, ...] = ("NASDAQ", "NYSE", "AMEX", "BSE", "NSE")


@dataclass(frozen=True)
class AlertThresholds:
    """When a metric turns into an alert."""

    dlq_rate_pct: float = 10.0
    min_events_per_minute: int = 5
    max_batch_seconds: float = 120.0
    cooldown_seconds: float = 60.0


DEFAULT_PIPELINE_NAME = "event-analytics"
