"""Telling valid events from dead letters, and shaping the latter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import DEFAULT_PIPELINE_NAME, WIRE_FIELDS, RuleBounds
from ..functions.parse import add_once
from ..functions.rules import first_failure

REASON = "_error_reason"


def tag_events(
    parsed: DataFrame, bounds: RuleBounds = RuleBounds(), timestamp_first: bool = False
) -> DataFrame:
    """Add the nullable reason column; NULL means valid."""
    return parsed.withColumn(REASON, first_failure(bounds, timestamp_first))


def split_events(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The valid rows (without the reason) and the invalid rows (with it)."""
    valid = tagged.filter(F.col(REASON).isNull()).drop(REASON)
    return valid, tagged.filter(F.col(REASON).isNotNull())


def dead_letters(
    invalid: DataFrame,
    pipeline_name: str = DEFAULT_PIPELINE_NAME,
    as_of: Column | None = None,
    origin: str | None = None,
    reason: str = REASON,
    event_date: Column | None = None,
) -> DataFrame:
    """The dead-letter envelope of each invalid row.

    ``origin`` prefixes the reason with who rejected the record.  The date is
    the processing date; pass ``event_date`` to file letters under another one.
    """
    now = F.current_timestamp() if as_of is None else as_of
    said = F.col(reason)
    return invalid.select(
        F.col("raw_value").alias("original_message"),
        (F.concat(F.lit(f"{origin}: "), said) if origin else said).alias("error_reason"),
        now.alias("processing_timestamp"),
        F.lit(pipeline_name).alias("pipeline_name"),
        (F.to_date(now) if event_date is None else event_date).alias("event_date"),
    )


def dead_letter_values(letters: DataFrame) -> DataFrame:
    """Dead letters as bus values: one JSON text per row, without the table's date."""
    fields = ("original_message", "error_reason", "processing_timestamp", "pipeline_name")
    return letters.select(F.to_json(F.struct(*fields)).alias("value"))


def keyed_values(events: DataFrame) -> DataFrame:
    """Valid events as bus records: keyed by symbol so that each symbol stays in order."""
    return events.select(
        F.col("symbol").cast("binary").alias("key"),
        F.to_json(F.struct(*WIRE_FIELDS), {"ignoreNullFields": "false"}).alias("value"),
    )


def original_text(df: DataFrame, raw: str = "raw_value") -> Column:
    """The raw payload, or the whole row as JSON where no payload was kept."""
    return F.coalesce(F.col(raw), F.to_json(F.struct(*[c for c in df.columns if c != raw])))


def read_letters(lines: DataFrame, value: str = "value") -> DataFrame:
    """Dead-letter JSON lines back to records to judge again.

    Lines that are no envelope, and envelopes whose original is no JSON, are
    skipped; what stays has the original as ``raw_value`` and its old reason.
    """
    envelope = "original_message string, error_reason string, pipeline_name string"
    opened = lines.select(F.inline(F.array(F.from_json(F.col(value).cast("string"), envelope))))
    parsed = add_once(
        opened.filter(F.col("original_message").isNotNull()),
        _readable=F.try_parse_json("original_message").isNotNull(),
    )
    return parsed.filter("_readable").select(
        F.col("original_message").alias("raw_value"), "error_reason", "pipeline_name"
    )
