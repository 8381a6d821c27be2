"""Alert rules: frames of metrics in, alert rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import ALERT_SCHEMA, AlertThresholds
from ..functions.scores import rate_pct
from ..settings import settle

# Severities, and the titles below, by which repeated alerts are held back.
SEVERITIES = ("info", "warning", "critical")


def known_severity(severity: Column) -> Column:
    """Unknown severities count as warnings."""
    return F.when(severity.isin(*SEVERITIES), severity).otherwise("warning")


def _alerts(df: DataFrame, at: Column, title: str, severity: str, message: Column) -> DataFrame:
    return df.select(
        at.cast("timestamp").alias("at"),
        F.lit(title).alias("title"),
        F.lit(severity).alias("severity"),
        message.alias("message"),
    )


def lag_alerts(metrics: DataFrame, limits: AlertThresholds = AlertThresholds()) -> DataFrame:
    """A warning for every micro-batch that took longer than allowed."""
    slow = metrics.filter(F.col("batch_ms") / 1000 > limits.max_batch_seconds)
    message = F.format_string(
        f"Query '%s' batch took %.1fs (threshold {limits.max_batch_seconds}s)",
        F.col("query"), F.col("batch_ms") / 1000,
    )
    return _alerts(slow, F.col("at"), "High processing lag", "warning", message)


def dlq_rate_alerts(
    rates: DataFrame, limits: AlertThresholds = AlertThresholds(), at: str = "event_date"
) -> DataFrame:
    """A critical alert per period whose dead-letter share reaches the limit.

    ``rates`` has ``valid_count`` and ``dlq_count``; periods without records
    are skipped.
    """
    processed = F.col("valid_count") + F.col("dlq_count")
    rate = rate_pct(F.col("dlq_count"), processed)
    high = rates.filter((processed > 0) & (rate >= limits.dlq_rate_pct))
    message = F.format_string(
        "%d/%d records dead-lettered (%.1f%%) - exceeds threshold",
        F.col("dlq_count"), processed, rate,
    )
    return _alerts(high, F.col(at), "High DLQ rate", "critical", message)


def quiet_minutes(
    events: DataFrame, limits: AlertThresholds = AlertThresholds(), ts: str = "event_ts",
    since: str | None = None, until: str | None = None,
) -> DataFrame:
    """Minutes, from the first to the last with events, that saw too few of them.

    Minutes without any event count as 0; the days between are dealt out before
    their minutes are laid out, so no task holds the whole line.  ``since`` and
    ``until`` (timestamps as text) narrow the line, say where a stray event
    would stretch it over years.
    """
    minute = F.date_trunc("minute", F.col(ts).cast("timestamp"))
    bounds = F.col(ts).isNotNull()
    if since is not None:
        bounds &= F.col(ts) >= F.lit(since).cast("timestamp")
    if until is not None:
        bounds &= F.col(ts) <= F.lit(until).cast("timestamp")
    counts = (
        events.filter(bounds)
        .groupBy(minute.alias("minute"))
        .agg(F.count(F.lit(1)).alias("event_count"))
    )
    counts = settle(counts, "minutes")  # a row per minute, read for the line and for its counts
    ends = counts.agg(F.min("minute").alias("first"), F.max("minute").alias("last"))
    days = ends.filter(F.col("first").isNotNull()).select(
        "first", "last",
        F.explode(F.sequence(F.to_date("first"), F.to_date("last"))).alias("day"),
    ).repartition("day")
    line = days.select(
        "first", "last",
        F.explode(
            F.sequence(
                F.col("day").cast("timestamp"),
                F.col("day").cast("timestamp") + F.expr("interval 1439 minutes"),
                F.expr("interval 1 minute"),
            )
        ).alias("minute"),
    ).filter(F.col("minute").between(F.col("first"), F.col("last")))
    return (
        line.join(counts, "minute", "left")
        .select("minute", F.coalesce("event_count", F.lit(0)).alias("event_count"))
        .filter(F.col("event_count") < limits.min_events_per_minute)
    )


def stall_alerts(
    events: DataFrame, limits: AlertThresholds = AlertThresholds(), ts: str = "event_ts",
    since: str | None = None, until: str | None = None,
) -> DataFrame:
    """A warning for every quiet minute."""
    message = F.format_string(
        f"%d events in a minute (threshold {limits.min_events_per_minute})", F.col("event_count")
    )
    quiet = quiet_minutes(events, limits, ts, since, until)
    return _alerts(quiet, F.col("minute"), "Throughput stall", "warning", message)


def termination_alerts(terminations: DataFrame) -> DataFrame:
    """A critical alert for every query that ended with an exception."""
    failed = terminations.filter(F.col("exception").isNotNull())
    message = F.concat(F.lit("Query "), F.col("query_id"), F.lit(" failed: "), F.col("exception"))
    return _alerts(failed, F.col("at"), "Streaming query terminated", "critical", message)


def outcome_counts(tagged: DataFrame, reason: str = "_error_reason") -> DataFrame:
    """Records by outcome: delivered, or dead-lettered."""
    outcome = F.when(F.col(reason).isNull(), "delivered").otherwise("dlq")
    return tagged.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("records"))


__all__ = [
    "ALERT_SCHEMA",
    "dlq_rate_alerts",
    "known_severity",
    "lag_alerts",
    "outcome_counts",
    "quiet_minutes",
    "stall_alerts",
    "termination_alerts",
]
