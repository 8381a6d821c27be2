"""From bus record to typed event columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import KAFKA_SCHEMA, WIRE_FIELDS, WIRE_SCHEMA

# A timestamp must carry a whole calendar date; on its own the timestamp parser
# would also take "2026" (a year) or "12:00" (today at noon).
_FULL_DATE = r"^\s*\d{4}-\d{2}-\d{2}"


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text as a timestamp; NULL when it is not one."""
    return F.when(text.rlike(_FULL_DATE), F.try_to_timestamp(text))


def add_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns whose expressions run exactly once per row.

    A plain projection is no barrier: a later filter on the column is pushed
    below it with the whole expression copied into every reference, so one
    JSON parse per row becomes a dozen.  A generator output cannot be
    substituted that way, and it stays inside whole-stage codegen.
    """
    packed = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(packed)))


def decode_records(records: DataFrame) -> DataFrame:
    """Bus record to text, keeping the raw payload and its position on the bus."""
    position = [c for c in KAFKA_SCHEMA.fieldNames() if c not in ("key", "value")]
    return records.select(
        F.col("value").cast("string").alias("raw_value"),
        F.col("key").cast("string").alias("kafka_key"),
        *[F.col(c).alias(f"kafka_{c}") for c in position],
    )


def parse_events(records: DataFrame) -> DataFrame:
    """Decode, parse with the fixed schema, flatten, and type the event time.

    Malformed JSON leaves every event column NULL and the raw text in place.
    """
    parsed = decode_records(records).select(
        "*", F.inline(F.array(F.from_json("raw_value", WIRE_SCHEMA)))
    )
    return add_once(parsed, event_ts=iso_timestamp(F.col("timestamp")))


def event_json() -> Column:
    """The canonical event object as JSON text, fields in contract order."""
    return F.to_json(
        F.struct(*[F.col(name) for name in WIRE_FIELDS]), {"ignoreNullFields": "false"}
    )
