"""The driver's `events` table as a feed of bus records.

Every row of `events` becomes one bus record whose value is event JSON.  Some
rows carry a fault, chosen by event id so that an independent SQL statement
can tell which, and some rows are delivered twice.  No row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.sources.records import spread_out

TOPIC = "events"
AS_OF = "2024-01-29 12:00:00"

# The nine wire fields of an `events` row; faults that are a matter of value.
_FIELDS = {
    "event_id": "CAST(event_id AS STRING)",
    "symbol": "CASE WHEN event_id % 100 <> 80 THEN event_type END",
    "company": "concat(initcap(event_type), ' Inc.')",
    "price": "CASE WHEN event_id % 100 = 0 THEN -abs(value) WHEN event_id % 100 = 90 "
    "THEN 2000000.0D + value ELSE value END",
    "volume": "CASE WHEN event_id % 100 = 70 THEN -k - 1 ELSE k END",
    "change": "round(value - 50, 4)",
    "change_percent": "CASE WHEN event_id % 100 = 30 THEN 5000.0D "
    "ELSE round((value - 50) / 50 * 100, 4) END",
    "timestamp": "CASE WHEN event_id % 100 = 40 THEN 'not-a-real-timestamp' "
    """ELSE date_format(CAST(ts AS TIMESTAMP), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") END""",
    "exchange": "CASE WHEN event_id % 100 = 10 THEN 'MARS' WHEN event_id % 7 = 0 THEN NULL "
    "WHEN event_id % 3 = 0 THEN 'NYSE' ELSE 'NASDAQ' END",
}


def _encoded(**changed: str | None) -> str:
    given = {f: changed.get(f, f"`{f}`") for f in _FIELDS}
    pairs = ", ".join(f"'{f}', {text}" for f, text in given.items() if text is not None)
    return f"to_json(named_struct({pairs}), map('ignoreNullFields', 'false'))"


# The fields as JSON text; faults that are a matter of form.
_VALUE = f"""CASE n % 100 WHEN 50 THEN '{{not valid json' WHEN 20 THEN {_encoded(volume=None)}
    WHEN 60 THEN {_encoded(price="'NaN-dollars'")} ELSE {_encoded()} END"""


def bus_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as bus records (the columns of KAFKA_SCHEMA)."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id", "ts", "event_type", "value",
        "CAST(get_json_object(props, '$.k') AS BIGINT) AS k",
    )
    wire = spread_out(events).selectExpr(
        "event_id AS n", "CAST(ts AS TIMESTAMP) AS at",
        *[f"{text} AS `{name}`" for name, text in _FIELDS.items()],
    )
    return wire.selectExpr(
        "n", "at", "symbol", f"{_VALUE} AS value",
        "explode(CASE WHEN n % 25 = 1 THEN array(0, 1) ELSE array(0) END) AS copy",
    ).selectExpr(
        "CAST(symbol AS BINARY) AS key", "CAST(value AS BINARY) AS value", f"'{TOPIC}' AS topic",
        "CAST(n % 3 AS INT) AS partition", "n * 2 + copy AS offset", "at AS timestamp",
    )
